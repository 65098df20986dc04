"""Queries on tokens, conversations, packing, evaluation and training arithmetic, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import conversations as C
from ..operators import tokens as K
from ..sources import archives as A
from ..streaming.ingest import work_folder
from .sql import read
from .text_queries import _sql_strip

MOST, VOCABULARY = 2048, 32_768


def _convs(spark: SparkSession, d: str) -> DataFrame:
    return C.conversations(read(spark, d, "chat_messages"))


def _valid(spark: SparkSession, d: str) -> DataFrame:
    convs = _convs(spark, d).withColumn("messages", C.without_system(F.col("messages")))
    return convs.filter(C.fault(F.col("messages")).isNull())


_ROLE = "CASE lower(trim(role)) WHEN 'human' THEN 'user' WHEN 'bot' THEN 'assistant' ELSE lower(trim(role)) END"
_SQL_CONVS = f"""
w AS (SELECT DISTINCT conv_id, turn, {_ROLE} AS role, content FROM chat_messages),
c0 AS (SELECT conv_id, list({{'role': role, 'content': content}} ORDER BY turn) AS ms FROM w GROUP BY conv_id),
c AS (SELECT conv_id, CASE WHEN ms[1].role = 'system' THEN list_concat([{{'role': ms[2].role, 'content': ms[1].content || chr(10) || chr(10) || ms[2].content}}], ms[3:]) ELSE ms END AS ms FROM c0),
f AS (SELECT conv_id, ms, CASE WHEN len(ms) < 2 THEN 'too_few'
  WHEN len(list_filter(generate_series(1, len(ms)), lambda i: ms[i].role IS DISTINCT FROM CASE WHEN i % 2 = 1 THEN 'user' ELSE 'assistant' END)) > 0 THEN 'roles'
  WHEN len(list_filter(ms, lambda m: m.content IS NULL)) > 0 THEN 'no_content' END AS fault FROM c),
v AS (SELECT conv_id, ms FROM f WHERE fault IS NULL)"""
_BYTES = "list_transform(generate_series(1, strlen({0})), lambda i: ('0x' || substr(hex({0}), 2 * i - 1, 2))::INT)"


def _marked(m: str) -> str:
    body = _BYTES.format(f"{m}.content")
    return f"list_concat(list_concat([CASE WHEN {m}.role = 'user' THEN 257 ELSE 259 END], {body}), [CASE WHEN {m}.role = 'user' THEN 258 ELSE 260 END])"


_SQL_IDS = f"""r AS (SELECT conv_id, ms, list_concat([256], flatten(list_transform(ms, lambda m: {_marked('m')}))) AS ids,
  list_concat([0], flatten(list_transform(ms, lambda m: list_concat([0], list_transform(generate_series(1, strlen(m.content) + 1), lambda i: CASE WHEN m.role = 'user' THEN 0 ELSE 1 END))))) AS mask FROM v)"""


def _faults(spark: SparkSession, d: str) -> DataFrame:
    convs = _convs(spark, d).withColumn("messages", C.without_system(F.col("messages")))
    return convs.select("conv_id", F.size("messages").alias("n"), C.fault(F.col("messages")).alias("fault"))


def _generated(spark: SparkSession, d: str) -> DataFrame:
    convs = _convs(spark, d).withColumn("messages", C.without_system(F.col("messages")))
    return convs.select("conv_id", C.generated_fault(F.col("messages")).alias("fault"))


def _request(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as requests, with settings by their number; every seventh gives none."""
    n = F.col("conv_id")
    given = lambda c: F.when(n % 7 != 0, c)
    settings = given((n % 23) / 10.0), given(n % 211), given(n % 4301)
    return _convs(spark, d).select("conv_id", C.request_fault(F.col("messages"), *settings, most_chars=2000, most_total=5000).alias("fault"))


_SQL_REQUEST = f"""WITH {_SQL_CONVS}, q AS (SELECT conv_id, ms, list_transform(ms, lambda m: coalesce(length(m.content), 0)) AS n FROM c0),
  e AS (SELECT *, list_position(n, 0) AS e, list_position(list_transform(n, lambda x: x > 2000), true) AS l FROM q)
  SELECT conv_id, CASE WHEN len(ms) = 0 THEN 'no_messages' WHEN len(ms) > 500 THEN 'too_many_messages'
  WHEN e IS NOT NULL AND coalesce(e < l, true) AND e > 0 THEN 'empty_message' WHEN l > 0 THEN 'message_too_long' WHEN list_sum(n) > 5000 THEN 'conversation_too_long'
  WHEN len(list_filter(ms, lambda m: coalesce(m.role, '') NOT IN ('user', 'assistant'))) > 0 THEN 'bad_role'
  WHEN conv_id % 7 <> 0 AND conv_id % 23 > 20 THEN 'temperature' WHEN conv_id % 7 <> 0 AND conv_id % 211 > 200 THEN 'top_k'
  WHEN conv_id % 7 <> 0 AND (conv_id % 4301 = 0 OR conv_id % 4301 > 4096) THEN 'max_tokens' END AS fault FROM e"""


def _parted(spark: SparkSession, d: str) -> DataFrame:
    """Answers as parts: their first word, a call that counts their signs, what it gives, and the rest."""
    part = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.alias("text"))
    first = lambda c: F.substring_index(c, " ", 1)

    def parts(m: Column) -> Column:
        said, size = m["content"], F.length(m["content"]).cast("string")
        rest = F.substring(said, F.length(first(said)) + 1, F.length(said))
        answer = F.array(part("text", first(said)), part("python", F.concat(F.lit("len("), size, F.lit(")"))), part("python_output", size), part("text", rest))
        return F.struct(m["role"].alias("role"), F.when(m["role"] == "user", F.array(part("text", said))).otherwise(answer).alias("parts"))

    rows = _valid(spark, d).select("conv_id", K.render_parts(F.transform("messages", parts), MOST).alias("r"))
    learned = F.aggregate("r.mask", F.lit(0), lambda a, m: a + m)
    return rows.select("conv_id", F.size("r.ids").alias("n_ids"), learned.alias("n_learned"), _joined(F.col("r.ids")).alias("ids_md5"), _joined(F.col("r.mask")).alias("mask_md5"))


def _requested(spark: SparkSession, d: str) -> DataFrame:
    rows = _convs(spark, d).filter(~F.exists("messages", lambda m: m["content"].isNull()))
    ids = K.render_request(F.col("messages"))
    return rows.select("conv_id", F.size(ids).alias("n_ids"), _joined(ids).alias("ids_md5"))


def _flat(*parts: str) -> str:
    return f"flatten([{', '.join(parts)}])"


_SIZE = "length(m.content)::VARCHAR"
_HEAD, _REST = "split_part(m.content, ' ', 1)", "substr(m.content, length(split_part(m.content, ' ', 1)) + 1)"
_ONES = "list_transform(generate_series(1, {0}), lambda i: {1})"
_SQL_PARTS = f"""r AS (SELECT conv_id, list_concat([256], flatten(list_transform(ms, lambda m: CASE WHEN m.role = 'user' THEN {_flat('[257]', _BYTES.format('m.content'), '[258]')}
    ELSE {_flat('[259]', _BYTES.format(_HEAD), '[261]', _BYTES.format(f"('len(' || {_SIZE} || ')')"), '[262, 263]', _BYTES.format(_SIZE), '[264]', _BYTES.format(f'({_REST})'), '[260]')} END))) AS ids,
  list_concat([0], flatten(list_transform(ms, lambda m: CASE WHEN m.role = 'user' THEN {_ONES.format('strlen(m.content) + 2', '0')}
    ELSE {_flat('[0]', _ONES.format(f'strlen({_HEAD}) + strlen({_SIZE}) + 7', '1'), _ONES.format(f'strlen({_SIZE}) + 2', '0'), _ONES.format(f'strlen({_REST}) + 1', '1'))} END))) AS mask FROM v)"""
_SQL_ASKED = f"""r AS (SELECT conv_id, {_flat('[256]', "flatten(list_transform(list_filter(ms, lambda m: m.role IN ('user', 'assistant')), lambda m: " + _marked('m') + "))", '[259]')} AS ids
  FROM c0 WHERE len(list_filter(ms, lambda m: m.content IS NULL)) = 0)"""


def _joined(ids: Column) -> Column:
    return F.md5(F.array_join(ids.cast("array<string>"), ","))


def _rendered(spark: SparkSession, d: str) -> DataFrame:
    rows = _valid(spark, d).select("conv_id", K.render(F.col("messages"), MOST).alias("r"))
    learned = F.aggregate("r.mask", F.lit(0), lambda a, m: a + m)
    return rows.select("conv_id", F.size("r.ids").alias("n_ids"), learned.alias("n_learned"), _joined(F.col("r.ids")).alias("ids_md5"), _joined(F.col("r.mask")).alias("mask_md5"))


def _lengths(spark: SparkSession, d: str) -> DataFrame:
    """Length of each rendered conversation, from the sizes of its messages alone."""
    sizes = F.aggregate("messages", F.lit(1), lambda a, m: a + F.octet_length(m["content"]) + 2)
    return _valid(spark, d).select("conv_id", sizes.alias("n_ids"))


def _completion(spark: SparkSession, d: str) -> DataFrame:
    """The conversation without its last answer, then the mark that asks for one."""
    rows = _valid(spark, d)
    rows = rows.filter(F.element_at("messages", -1)["role"] == "assistant")
    asked = F.slice("messages", F.lit(1), F.size("messages") - 1)
    ids = F.array_append(K.render(asked, 1 << 20)["ids"], F.lit(K.special_id("<|assistant_start|>")))
    return rows.select("conv_id", F.size(ids).alias("n_ids"), _joined(ids).alias("ids_md5"))


def _targets(spark: SparkSession, d: str) -> DataFrame:
    rows = _valid(spark, d).select("conv_id", K.render(F.col("messages"), MOST).alias("r"))
    inputs, targets = K.shift_targets(F.col("r.ids"), F.col("r.mask"))
    ignored = F.size(F.filter(targets, lambda t: t == -1))
    return rows.select("conv_id", _joined(inputs).alias("inputs_md5"), _joined(targets).alias("targets_md5"), ignored.alias("n_ignored"))


def _padded(spark: SparkSession, d: str) -> DataFrame:
    """Conversations in batches of 8 ids, each padded on the right to the longest of its batch."""
    from pyspark.sql import Window as W

    rows = _valid(spark, d).select("conv_id", K.render(F.col("messages"), MOST)["ids"].alias("ids"))
    rows = rows.withColumn("longest", F.max(F.size("ids")).over(W.partitionBy(F.floor(F.col("conv_id") / 8))))
    full = F.concat("ids", F.array_repeat(F.lit(K.special_id("<|bos|>")), F.col("longest") - F.size("ids")))
    return rows.select("conv_id", F.size(full).alias("width"), _joined(full).alias("ids_md5"))


def _sequences(spark: SparkSession, d: str) -> DataFrame:
    rows = _valid(spark, d).select("conv_id", K.render(F.col("messages"), 1 << 20)["ids"].alias("ids"))
    return rows.select(F.lpad(F.col("conv_id").cast("string"), 12, "0").alias("order_key"), "ids")


def _pack(crop: bool) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = K.pack(_sequences(spark, d), 4, 2049, 1000 if crop else 100, crop)
        return rows.select("rank", "row", F.size("ids").alias("width"), "content", "cropped", _joined(F.col("ids")).alias("ids_md5"))

    return run


def _packing_stats(spark: SparkSession, d: str) -> DataFrame:
    rows = K.pack(_sequences(spark, d), 4, 2049, 1000, True)
    return rows.groupBy("rank").agg(
        F.count("*").alias("n_rows"), F.sum("content").alias("n_tokens"), F.sum("cropped").alias("n_cropped"),
        (F.sum("content") / F.sum(F.size("ids"))).alias("used"),
    )


def _pretokens(spark: SparkSession, d: str) -> DataFrame:
    return K.pretoken_counts(read(spark, d, "documents"))


def _bpe(spark: SparkSession, d: str) -> DataFrame:
    rows = K.train_bpe(read(spark, d, "documents"), "text", VOCABULARY)
    return rows.select("token_id", F.hex("token").alias("token_hex"), "n")


def _token_bytes(spark: SparkSession, d: str) -> DataFrame:
    vocabulary = K.train_bpe(read(spark, d, "chat_messages"), "content", VOCABULARY)
    return K.token_bytes(vocabulary)


def _byte_round_trip(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "chat_messages").select("content").filter("content is not null")
    ids = K.byte_ids(F.col("content"))
    back = F.decode(F.unhex(F.array_join(F.transform(ids, lambda i: F.lpad(F.hex(i), 2, "0")), "")), "UTF-8")
    return rows.agg(F.count("*").alias("n"), F.count_if(back == F.col("content")).alias("n_equal"), F.sum(F.size(ids)).alias("n_ids"))


def _losses(spark: SparkSession, d: str) -> DataFrame:
    """A loss for each byte of each message, by arithmetic; every eleventh target is ignored (-1)."""
    rows = read(spark, d, "chat_messages").select("conv_id", "turn", "dataset", F.posexplode(K.byte_ids(F.col("content"))).alias("at", "byte"))
    target = F.when(F.col("at") % 11 == 10, -1).otherwise(F.col("byte"))
    return rows.withColumns({"nats": ((F.col("byte") * 7 + F.col("at") * 3) % 100) / 37.0, "target": target})


def _byte_sizes(spark: SparkSession) -> DataFrame:
    """Bytes of the tokens of a byte vocabulary, of which what is no sign counts none."""
    return spark.range(256).select(F.col("id").cast("int").alias("target"), F.when(F.col("id") < 32, 0).otherwise(1).alias("n_bytes"))


def _bits(spark: SparkSession, d: str) -> DataFrame:
    rows = K.bits_per_byte(_losses(spark, d), _byte_sizes(spark), ["dataset", "turn"])
    return rows.select("dataset", "turn", F.round("bpb", 6).alias("bpb"), "n_bytes")


_SQL_LOSSES = f"""l AS (SELECT dataset, turn, CASE WHEN (i - 1) % 11 = 10 THEN -1 ELSE b[i] END AS target, ((b[i] * 7 + (i - 1) * 3) % 100) / 37.0 AS nats FROM (
  SELECT dataset, turn, b, unnest(generate_series(1, len(b))) AS i FROM (SELECT dataset, turn, {_BYTES.format('content')} AS b FROM chat_messages WHERE content IS NOT NULL)))"""


def _token_bytes_join(spark: SparkSession, d: str) -> DataFrame:
    return _losses(spark, d).join(F.broadcast(_byte_sizes(spark)), "target").groupBy("n_bytes").agg(F.count("*").alias("n"))


def _prefixes(suffix: bool) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        pairs = _valid(spark, d).select("conv_id", F.get("messages", F.lit(0))["content"].alias("a"), F.get("messages", F.lit(1))["content"].alias("b"))
        n = C.common_length(K.byte_ids(F.col("a")), K.byte_ids(F.col("b")), suffix)
        return pairs.select("conv_id", n.alias("n"))

    return run


def _sql_prefix(suffix: bool) -> str:
    a, b = _BYTES.format("ms[1].content"), _BYTES.format("ms[2].content")
    if suffix:
        a, b = f"list_reverse({a})", f"list_reverse({b})"
    return f"""WITH {_SQL_CONVS}, p AS (SELECT conv_id, {a} AS a, {b} AS b FROM v)
      SELECT conv_id, coalesce(list_min(list_filter(generate_series(1, least(len(a), len(b))), lambda i: a[i] <> b[i])) - 1, least(len(a), len(b)))::INT AS n FROM p"""


def _items(spark: SparkSession, d: str) -> DataFrame:
    """Books as items: the title asks, the choices are author (the right one) and reason of the year; solved ones go
    before, as pairs of title and author and the other way round."""
    from .corpus_queries import _fewshot

    books = read(spark, d, "manifest").filter("ebook_id is not null and title is not null").distinct()
    author, year = F.coalesce(F.min("author"), F.lit("unknown")), F.coalesce(F.min("year_reason"), F.lit("undated"))
    books = books.groupBy("ebook_id").agg(F.min("title").alias("title"), author.alias("author"), year.alias("year_reason"))
    solved = _fewshot(spark, d).join(books.select(F.col("ebook_id").alias("shot_id"), "title", "author"), "shot_id")
    listed = F.sort_array(F.collect_list(F.struct("shot", "title", "author")))
    pair = lambda a, b: F.transform(listed, lambda s: F.struct(s[a].alias("before"), s[b].alias("after")))
    shots = solved.groupBy("ebook_id").agg(pair("title", "author").alias("asked"), pair("author", "title").alias("told"))
    return books.join(shots, "ebook_id")


def _prompts(kind: str, items: DataFrame) -> Column:
    options = F.array("author", "year_reason")
    if kind == "choices":
        return C.choice_prompts(F.col("title"), options, F.col("asked"))
    if kind == "contexts":
        return C.context_prompts(options, F.col("title"), F.col("told"))
    return C.continued_prompts(F.col("title"), F.col("author"), F.col("asked"))


def _prompts_of(kind: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        items = _items(spark, d)
        return items.select("ebook_id", F.posexplode(_prompts(kind, items)).alias("choice", "prompt"))

    return run


def _spans(spark: SparkSession, d: str) -> DataFrame:
    """What is scored of each prompt, in bytes after the mark at the head."""
    items = _items(spark, d)
    bos = F.array(F.lit(K.special_id("<|bos|>")))
    out = None
    for kind in ("choices", "contexts", "continued"):
        ids = F.transform("prompts", lambda p: F.concat(bos, K.byte_ids(p)))
        rows = items.select("ebook_id", _prompts(kind, items).alias("prompts")).select("ebook_id", F.posexplode(C.spans(kind, ids)).alias("option", "s"))
        rows = rows.select("ebook_id", F.lit(kind).alias("kind"), "option", F.col("s.start").alias("span_from"), F.col("s.end").alias("span_to"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _sql_items() -> str:
    from .corpus_queries import _SQL_FEWSHOT

    return rf"""WITH b AS (SELECT ebook_id, min(title) AS title, coalesce(min(author), 'unknown') AS author, coalesce(min(year_reason), 'undated') AS year_reason FROM manifest WHERE ebook_id IS NOT NULL AND title IS NOT NULL GROUP BY ebook_id),
 s AS (SELECT f.ebook_id, string_agg(b.title || ' ' || b.author || chr(10) || chr(10), '' ORDER BY f.shot) AS asked, string_agg(b.author || ' ' || b.title || chr(10) || chr(10), '' ORDER BY f.shot) AS told,
   string_agg(trim(b.title) || ' ' || b.author || chr(10) || chr(10), '' ORDER BY f.shot) AS cut FROM ({_SQL_FEWSHOT}) f JOIN b ON b.ebook_id = f.shot_id GROUP BY f.ebook_id),
 i AS (SELECT * FROM b JOIN s USING (ebook_id)),
 choices AS (SELECT ebook_id, unnest([0, 1]) AS choice, unnest([asked || title || ' ' || author, asked || title || ' ' || year_reason]) AS prompt FROM i),
 contexts AS (SELECT ebook_id, unnest([0, 1]) AS choice, unnest([told || author || ' ' || title, told || year_reason || ' ' || title]) AS prompt FROM i),
 continued AS (SELECT ebook_id, unnest([0, 1]) AS choice, unnest([trim(cut || trim(title)), cut || trim(title) || ' ' || author]) AS prompt FROM i)"""


def _sql_spans() -> str:
    a, b = _BYTES.format("a.prompt"), _BYTES.format("b.prompt")
    alike = "coalesce(list_min(list_filter(generate_series(1, least(len(x), len(y))), lambda j: x[j] <> y[j])) - 1, least(len(x), len(y)))"
    both = lambda kind, r: f"(SELECT ebook_id, {r.format(a)} AS x, {r.format(b)} AS y FROM {kind} a JOIN {kind} b USING (ebook_id) WHERE a.choice = 0 AND b.choice = 1)"
    opts = "(VALUES (0), (1)) o(option)"
    return f"""{_sql_items()} SELECT ebook_id, 'choices' AS kind, option, (1 + {alike})::INT AS span_from, (1 + CASE option WHEN 0 THEN len(x) ELSE len(y) END)::INT AS span_to FROM {both('choices', '{0}')}, {opts}
      UNION ALL SELECT ebook_id, 'contexts', option, (1 + CASE option WHEN 0 THEN len(x) ELSE len(y) END - {alike})::INT, (1 + CASE option WHEN 0 THEN len(x) ELSE len(y) END)::INT FROM {both('contexts', 'list_reverse({0})')}, {opts}
      UNION ALL SELECT ebook_id, 'continued', 0, (1 + len(x))::INT, (1 + len(y))::INT FROM {both('continued', '{0}')}"""


def _options(spark: SparkSession, d: str) -> DataFrame:
    """Losses of the tokens of four options for each item, by arithmetic, and where the option's own tokens stand."""
    rows = read(spark, d, "shards").select("rec_id", (F.coalesce(F.length("text"), F.lit(0)) * 31).alias("x"))
    each = rows.withColumn("option", F.explode(F.sequence(F.lit(0), F.lit(3)))).withColumns({"start": F.lit(3), "end": F.col("option") + 6})
    losses = F.transform(F.sequence(F.lit(0), F.col("end") - 1), lambda i: ((F.col("x") + F.col("option") * 17 + i * 5) % 23) / 10.0)
    return each.select("rec_id", "option", "start", "end", losses.alias("losses"))


def _argmin(spark: SparkSession, d: str) -> DataFrame:
    rows = C.mean_loss(_options(spark, d))
    best = F.min_by("option", F.struct(F.round("loss", 9), "option"))
    return rows.groupBy("rec_id").agg(best.alias("choice"))


_SQL_OPTIONS = """SELECT rec_id, o.option::INT AS option, avg(((coalesce(length(text), 0) * 31 + o.option * 17 + i * 5) % 23) / 10.0) AS loss
  FROM shards, (VALUES (0), (1), (2), (3)) o(option), (SELECT unnest(range(2, 8)) AS i) t WHERE i < o.option + 5 GROUP BY ALL"""
_SQL_ARGMIN = f"SELECT rec_id, arg_min(option, round(loss, 9) + option / 1e7)::INT AS choice FROM ({_SQL_OPTIONS}) GROUP BY rec_id"


def _accuracy(spark: SparkSession, d: str) -> DataFrame:
    right = (F.col("choice") == F.col("rec_id") % 4).cast("double")
    tasks = read(spark, d, "shards").select("rec_id", "source")
    return _argmin(spark, d).join(tasks, "rec_id").groupBy("source").agg(F.round(F.avg(right), 9).alias("accuracy"), F.count("*").alias("n"))


_SQL_ACCURACY = f"SELECT source, round(avg(CASE WHEN choice = rec_id % 4 THEN 1.0 ELSE 0.0 END), 9)::DOUBLE AS accuracy, count(*) AS n FROM ({_SQL_ARGMIN}) JOIN shards USING (rec_id) GROUP BY source"


def _core(spark: SparkSession, d: str) -> DataFrame:
    """Accuracy above a baseline of 25 %, and its mean over tasks."""
    centred = (F.col("accuracy") - 0.25) / 0.75
    return _accuracy(spark, d).agg(F.round(F.avg(centred), 8).alias("core"), F.count("*").alias("n_tasks"))


def _exact(spark: SparkSession, d: str) -> DataFrame:
    """Whether all predicted bytes of an answer are the right ones; the prediction misses every 97th sum."""
    rows = read(spark, d, "chat_messages").select("conv_id", "turn", F.posexplode(K.byte_ids(F.col("content"))).alias("at", "b"))
    return rows.groupBy("conv_id", "turn").agg(F.bool_and((F.col("b") + F.col("at")) % 97 != 0).alias("exact"))


_SQL_EXACT = f"""SELECT conv_id, turn, bool_and((b[i] + i - 1) % 97 <> 0) AS exact FROM (SELECT conv_id, turn, b, unnest(generate_series(1, len(b))) AS i FROM (
  SELECT conv_id, turn, {_BYTES.format('content')} AS b FROM chat_messages WHERE content IS NOT NULL)) GROUP BY conv_id, turn"""


def _truncate_left(spark: SparkSession, d: str) -> DataFrame:
    """The last 64 bytes of a message, and where its last 10 begin then."""
    rows = read(spark, d, "chat_messages").filter("content is not null").select("conv_id", "turn", K.byte_ids(F.col("content")).alias("ids")).distinct()
    size = F.size("ids")
    kept = F.when(size > 64, F.slice("ids", -64, 64)).otherwise(F.col("ids"))
    start = F.greatest(size - 10 - F.greatest(size - 64, F.lit(0)), F.lit(0))
    return rows.select("conv_id", "turn", F.size(kept).alias("n"), start.alias("start"), _joined(kept).alias("ids_md5"))


_SQL_LEFT = f"""SELECT DISTINCT conv_id, turn, len(k)::INT AS n, greatest(len(ids) - 10 - greatest(len(ids) - 64, 0), 0)::INT AS start, md5(array_to_string(k, ',')) AS ids_md5
  FROM (SELECT conv_id, turn, ids, CASE WHEN len(ids) > 64 THEN ids[len(ids) - 63:] ELSE ids END AS k FROM (SELECT conv_id, turn, {_BYTES.format('content')} AS ids FROM chat_messages WHERE content IS NOT NULL))"""


def _stop(spark: SparkSession, d: str) -> DataFrame:
    """Bytes before the first full stop."""
    rows = read(spark, d, "chat_messages").filter("content is not null").select("conv_id", "turn", K.byte_ids(F.col("content")).alias("ids")).distinct()
    at = F.array_position("ids", 46)
    kept = F.when(at > 0, F.slice("ids", F.lit(1), at.cast("int") - 1)).otherwise(F.col("ids"))
    return rows.select("conv_id", "turn", F.size(kept).alias("n"), (at > 0).alias("stopped"))


def _softmax(spark: SparkSession, d: str) -> DataFrame:
    """Probabilities of the five largest of the embedding's values at temperature 0.8, and the largest's place."""
    rows = read(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    top = F.slice(F.sort_array("x", asc=False), 1, 5)
    weights = F.transform(top, lambda v: F.exp((v - F.array_max("x")) / 0.8))
    total = F.aggregate(weights, F.lit(0.0), lambda a, v: a + v)
    place = F.array_position("x", F.array_max("x")) - 1
    return rows.select("vec_id", place.cast("int").alias("argmax"), F.round(weights[0] / total, 6).alias("p_first"), F.round(weights[4] / total, 6).alias("p_fifth"))


_SQL_SOFTMAX = """SELECT vec_id, (list_position(x, list_max(x)) - 1)::INT AS argmax, round(w[1] / list_sum(w), 6) AS p_first, round(w[5] / list_sum(w), 6) AS p_fifth
  FROM (SELECT vec_id, x, list_transform(list_reverse_sort(x)[1:5], lambda v: exp((v - list_max(x)) / 0.8)) AS w FROM (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings))"""


def _calculator(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "orders").select("o_orderkey", F.concat(F.col("o_custkey"), F.lit(" * (2 + "), F.col("o_orderkey"), F.lit(")")).alias("e"))
    return rows.select("o_orderkey", K.calculator(F.col("e")).cast("bigint").alias("value"))


def _conv_load(spark: SparkSession, d: str) -> DataFrame:
    """Conversations added to a file of JSON lines in two goes, and read again: how many of each size begin how."""
    folder = f"{work_folder(spark)}/lines"
    convs = _convs(spark, d)
    for part in (0, 1):
        A.append_conversations(convs.filter(F.col("conv_id") % 2 == part), folder)
    back = A.read_conversations(spark, folder)
    return back.groupBy(F.size("messages").alias("n"), F.get("messages", F.lit(0))["role"].alias("first_role")).agg(F.count("*").alias("n_convs"))


def _cut_conversation(spark: SparkSession, d: str) -> DataFrame:
    """The conversation up to its second message, as it stands after an edit."""
    kept = F.slice("messages", 1, 2)
    said = F.md5(F.array_join(F.transform(kept, lambda m: F.concat_ws(":", m["role"], m["content"])), "|"))
    return _convs(spark, d).select("conv_id", F.size(kept).alias("n"), F.size("messages").alias("whole"), said.alias("said_md5"))


def _prompt_plan(spark: SparkSession, d: str) -> DataFrame:
    """Who asks, in what manner and about what, chosen for each number by a seeded hash."""
    kinds = {"person": ("scholar", "farmer", "child", "sailor"), "manner": ("plain", "curious", "formal"), "topic": ("trade", "history", "weather", "travel", "books")}
    rows = read(spark, d, "shards").select("rec_id")
    for name, values in kinds.items():
        key = F.md5(F.concat_ws(":", F.lit(f"7:{name}"), F.col("rec_id").cast("string")))
        pick = (F.conv(F.substring(key, 1, 7), 16, 10).cast("int") % len(values)).cast("int")
        rows = rows.withColumn(name, F.get(F.array(*[F.lit(v) for v in values]), pick))
    asked = F.format_string("Write as a %s who is %s; the talk is of %s, in %d turns.", "person", "manner", "topic", 2 + F.col("rec_id") % 3)
    return rows.withColumn("prompt", asked)


def _sql_pick(name: str, values: str, n: int) -> str:
    return f"(string_split('{values}', '|'))[1 + ('0x' || substr(md5('7:{name}:' || rec_id), 1, 7))::INT % {n}] AS {name}"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "conv_load": _conv_load, "conv_validate": _faults, "generated_validate": _generated, "request_validate": _request,
    "render_parts": _parted, "render_request": _requested, "option_spans": _spans, "conv_truncate": _cut_conversation,
    "render_conversation": _rendered, "conversation_lengths": _lengths, "render_completion": _completion,
    "shift_targets": _targets, "pad_right": _padded, "pack_bestfit_crop": _pack(True), "pack_bestfit_pad": _pack(False),
    "packing_stats": _packing_stats, "pretokenize_counts": _pretokens, "bpe_train": _bpe, "token_bytes": _token_bytes,
    "byte_round_trip": _byte_round_trip, "bits_per_byte": _bits, "token_bytes_join": _token_bytes_join,
    "common_prefix_len": _prefixes(False), "common_suffix_len": _prefixes(True), "prompts_mc": _prompts_of("choices"),
    "prompts_schema": _prompts_of("contexts"), "prompts_lm": _prompts_of("continued"), "mc_argmin": _argmin, "task_accuracy": _accuracy,
    "core_metric": _core, "lm_exact": _exact, "left_truncate": _truncate_left, "truncate_at_stop": _stop,
    "topk_softmax": _softmax, "calculator": _calculator, "prompt_plan": _prompt_plan,
}

ORACLES: dict[str, str] = {
    "conv_load": f"WITH {_SQL_CONVS} SELECT len(ms)::INT AS n, ms[1].role AS first_role, count(*) AS n_convs FROM c0 GROUP BY ALL",
    "conv_validate": f"WITH {_SQL_CONVS} SELECT conv_id, len(ms)::INT AS n, fault FROM f",
    "request_validate": _SQL_REQUEST,
    "conv_truncate": f"WITH {_SQL_CONVS} SELECT conv_id, least(2, len(ms))::INT AS n, len(ms)::INT AS whole, md5(concat_ws('|', concat_ws(':', ms[1].role, ms[1].content), CASE WHEN len(ms) > 1 THEN concat_ws(':', ms[2].role, ms[2].content) END)) AS said_md5 FROM c0",
    "render_conversation": f"WITH {_SQL_CONVS}, {_SQL_IDS}, k AS (SELECT conv_id, ids[1:{MOST}] AS ids, mask[1:{MOST}] AS mask FROM r) SELECT conv_id, len(ids)::INT AS n_ids, list_sum(mask)::INT AS n_learned, md5(array_to_string(ids, ',')) AS ids_md5, md5(array_to_string(mask, ',')) AS mask_md5 FROM k",
    "conversation_lengths": f"WITH {_SQL_CONVS}, {_SQL_IDS} SELECT conv_id, len(ids)::INT AS n_ids FROM r",
    "render_completion": f"WITH {_SQL_CONVS}, q AS (SELECT conv_id, ms[1:len(ms) - 1] AS ms FROM v WHERE ms[len(ms)].role = 'assistant'), {_SQL_IDS.replace('FROM v', 'FROM q')} SELECT conv_id, (len(ids) + 1)::INT AS n_ids, md5(array_to_string(list_append(ids, 259), ',')) AS ids_md5 FROM r",
    "shift_targets": f"""WITH {_SQL_CONVS}, {_SQL_IDS}, k AS (SELECT conv_id, ids[1:{MOST}] AS ids, mask[1:{MOST}] AS mask FROM r),
      t AS (SELECT conv_id, ids[1:len(ids) - 1] AS a, list_transform(generate_series(2, len(ids)), lambda i: CASE WHEN mask[i] = 1 THEN ids[i] ELSE -1 END) AS b FROM k)
      SELECT conv_id, md5(array_to_string(a, ',')) AS inputs_md5, md5(array_to_string(b, ',')) AS targets_md5, len(list_filter(b, lambda x: x = -1))::INT AS n_ignored FROM t""",
    "pad_right": f"""WITH {_SQL_CONVS}, {_SQL_IDS}, k AS (SELECT conv_id, ids[1:{MOST}] AS ids FROM r), w AS (SELECT conv_id, ids, max(len(ids)) OVER (PARTITION BY conv_id // 8) AS longest FROM k)
      SELECT conv_id, longest::INT AS width, md5(array_to_string(list_concat(ids, list_transform(range(longest - len(ids)), lambda i: 256)), ',')) AS ids_md5 FROM w""".replace(", w AS (SELECT conv_id, ids", ", ww AS (SELECT conv_id, ids").replace("FROM w\n", "FROM ww\n").replace("ids_md5 FROM w", "ids_md5 FROM ww"),
    "byte_round_trip": "SELECT count(*) AS n, count(*) AS n_equal, sum(strlen(content))::BIGINT AS n_ids FROM chat_messages WHERE content IS NOT NULL",
    "bits_per_byte": f"""WITH {_SQL_LOSSES}, g AS (SELECT dataset, turn, sum(nats) FILTER (target >= 32) AS nats, count(*) FILTER (target >= 32) AS n FROM l GROUP BY dataset, turn)
        SELECT dataset, turn, round(CASE WHEN n = 0 THEN 'inf'::DOUBLE ELSE nats / (ln(2.0) * n) END, 6) AS bpb, n AS n_bytes FROM g""",
    "token_bytes_join": f"WITH {_SQL_LOSSES} SELECT CASE WHEN target >= 32 THEN 1 ELSE 0 END AS n_bytes, count(*) AS n FROM l WHERE target >= 0 GROUP BY 1",
    "common_prefix_len": _sql_prefix(False), "common_suffix_len": _sql_prefix(True),
    "prompts_mc": f"{_sql_items()} SELECT ebook_id, choice, prompt FROM choices", "prompts_schema": f"{_sql_items()} SELECT ebook_id, choice, prompt FROM contexts",
    "prompts_lm": f"{_sql_items()} SELECT ebook_id, choice, prompt FROM continued", "option_spans": _sql_spans(),
    "generated_validate": f"WITH {_SQL_CONVS} SELECT conv_id, coalesce(fault, CASE WHEN len(list_filter(ms, lambda m: {_sql_strip('m.content')} = '')) > 0 THEN 'blank' END) AS fault FROM f",
    "render_parts": f"WITH {_SQL_CONVS}, {_SQL_PARTS}, k AS (SELECT conv_id, ids[1:{MOST}] AS ids, mask[1:{MOST}] AS mask FROM r) SELECT conv_id, len(ids)::INT AS n_ids, list_sum(mask)::INT AS n_learned, md5(array_to_string(ids, ',')) AS ids_md5, md5(array_to_string(mask, ',')) AS mask_md5 FROM k",
    "render_request": f"WITH {_SQL_CONVS}, {_SQL_ASKED} SELECT conv_id, len(ids)::INT AS n_ids, md5(array_to_string(ids, ',')) AS ids_md5 FROM r",
    "mc_argmin": _SQL_ARGMIN, "task_accuracy": _SQL_ACCURACY,
    "core_metric": f"SELECT round(avg((accuracy - 0.25) / 0.75), 8) AS core, count(*) AS n_tasks FROM ({_SQL_ACCURACY})",
    "lm_exact": _SQL_EXACT, "left_truncate": _SQL_LEFT,
    "truncate_at_stop": "SELECT DISTINCT conv_id, turn, CASE WHEN contains(content, '.') THEN strlen(left(content, instr(content, '.') - 1)) ELSE strlen(content) END::INT AS n, contains(content, '.') AS stopped FROM chat_messages WHERE content IS NOT NULL",
    "topk_softmax": _SQL_SOFTMAX,
    "calculator": "SELECT o_orderkey, o_custkey * (2 + o_orderkey) AS value FROM orders",
    "prompt_plan": f"SELECT *, 'Write as a ' || person || ' who is ' || manner || '; the talk is of ' || topic || ', in ' || (2 + rec_id % 3) || ' turns.' AS prompt FROM (SELECT rec_id, {_sql_pick('person', 'scholar|farmer|child|sailor', 4)}, {_sql_pick('manner', 'plain|curious|formal', 3)}, {_sql_pick('topic', 'trade|history|weather|travel|books', 5)} FROM shards)",
}
