"""Queries on scans, joins, aggregates, order, shards and streams, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..operators import filters as P
from ..operators import ordering as O
from ..sources import archives as A
from ..streaming import ingest as S
from .sql import read

SEED = 42
BLOCK, SHARD_CHARS = 32, 40_000
#: Copies of each source's documents; sources not named have one.
COPIES = {"britannica": 5, "pamphlets": 2}

_KEY = "md5(concat_ws(':', '{seed}', {cols}))"


def _key(*cols: str, seed: int = SEED) -> str:
    return _KEY.format(seed=seed, cols=", ".join(f"CAST({c} AS VARCHAR)" for c in cols))


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", "source", "text")


def _upweight(spark: SparkSession, d: str) -> DataFrame:
    copies = F.lit(1)
    for source, n in COPIES.items():
        copies = F.when(F.col("source") == source, n).otherwise(copies)
    rows = read(spark, d, "documents").select("doc_id", "source", F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
    return rows


_SQL_UPWEIGHT = (
    "SELECT doc_id, source, unnest(range(1, 2 + CASE source WHEN 'britannica' THEN 4 WHEN 'pamphlets' THEN 1 ELSE 0 END))::INT AS copy FROM documents"
)


def _doc_batches(spark: SparkSession, d: str) -> DataFrame:
    """Row groups over two epochs, as rank 1 of 4 reads them on from the second row group of its first epoch."""
    rows = _grouped(spark, d).withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(2))))
    shard = F.regexp_extract("shard_name", r"(\d+)", 1).cast("int")
    rows = rows.select("rec_id", "epoch", shard.alias("shard"), "row_group")
    at = F.struct("epoch", "shard", "row_group")
    return rows.filter((F.col("row_group") % READERS == 1) & (at >= F.struct(F.lit(1), F.lit(0), F.lit(2))))


def _corpus_summary(spark: SparkSession, d: str) -> DataFrame:
    """Per source: sizes, the upper median length, from the table of lengths and their counts, and how many documents
    hold terms of a later time."""
    hit = (F.size(P.anachronisms(F.col("text"))) > 0).cast("bigint")
    rows = read(spark, d, "documents").filter("text is not null").select("source", F.length("text").cast("bigint").alias("len"), hit.alias("hit"))
    sizes = rows.groupBy("source", "len").agg(F.count("*").alias("c"), F.sum("hit").alias("hits"))
    upto = F.sum("c").over(W.Window.partitionBy("source").orderBy("len"))
    whole = F.sum("c").over(W.Window.partitionBy("source"))
    marked = sizes.withColumns({"upto": upto, "whole": whole})
    at = F.floor(F.col("whole") / 2) + 1
    median = F.max(F.when((F.col("upto") >= at) & (F.col("upto") - F.col("c") < at), F.col("len")))
    total = F.sum(F.col("c") * F.col("len"))
    return marked.groupBy("source").agg(
        F.sum("c").alias("n_docs"), total.alias("n_chars"), F.floor(total / 3.5).alias("n_est"),
        F.min("len").alias("min_len"), median.alias("median_len"), F.max("len").alias("max_len"),
        F.sum("hits").alias("n_hit"),
    )


_SQL_SUMMARY = r"""
WITH s AS (SELECT source, length(text) AS len, row_number() OVER (PARTITION BY source ORDER BY length(text)) AS i,
  count(*) OVER (PARTITION BY source) AS n FROM documents WHERE text IS NOT NULL),
h AS (SELECT source, count(*) FILTER (regexp_matches(text, '(?i)\b(%s)\b')) AS h FROM documents WHERE text IS NOT NULL GROUP BY source)
SELECT source, count(*) AS n_docs, sum(len)::BIGINT AS n_chars, floor(sum(len) / 3.5)::BIGINT AS n_est, min(len) AS min_len,
  max(CASE WHEN i = n // 2 + 1 THEN len END) AS median_len, max(len) AS max_len, any_value(h) AS n_hit FROM s JOIN h USING (source) GROUP BY source""" % "|".join(P.ANACHRONISMS)


def _seeded_shuffle(spark: SparkSession, d: str) -> DataFrame:
    return O.placed(_docs(spark, d), SEED, ["doc_id"]).select("doc_id", "place")


def _split(spark: SparkSession, d: str) -> DataFrame:
    copies = _upweight(spark, d)
    return O.split_held_out(copies, SEED, ["doc_id", "copy"]).select("doc_id", "copy", "split")


_SQL_SPLIT = f"""
WITH c AS ({_SQL_UPWEIGHT}), r AS (SELECT *, row_number() OVER (ORDER BY {_key('doc_id', 'copy')}) AS i, count(*) OVER () AS n FROM c)
SELECT doc_id, copy, CASE WHEN i <= greatest(1, floor(n * 0.01)) THEN 'val' ELSE 'train' END AS split FROM r"""


def _shards(spark: SparkSession, d: str) -> DataFrame:
    rows = O.assign_shards(_docs(spark, d), SEED, ["doc_id"], F.length("text"), BLOCK, SHARD_CHARS)
    return rows.select("doc_id", F.col("place").cast("bigint").alias("place"), "shard")


_SQL_SHARDS = f"""
WITH RECURSIVE p AS (SELECT doc_id, coalesce(length(text), 0) AS c, row_number() OVER (ORDER BY {_key('doc_id')}) AS place FROM documents),
b AS (SELECT (place - 1) // {BLOCK} AS block, sum(c) AS c FROM p GROUP BY 1),
f AS (SELECT block, 0 AS shard, c AS held FROM b WHERE block = 0 UNION ALL
  SELECT b.block, CASE WHEN f.held >= {SHARD_CHARS} THEN f.shard + 1 ELSE f.shard END, CASE WHEN f.held >= {SHARD_CHARS} THEN b.c ELSE f.held + b.c END
  FROM f JOIN b ON b.block = f.block + 1)
SELECT doc_id, place, shard::INT AS shard FROM p JOIN f ON f.block = (p.place - 1) // {BLOCK}"""


def _shard_stats(spark: SparkSession, d: str) -> DataFrame:
    rows = O.assign_shards(_docs(spark, d), SEED, ["doc_id"], F.length("text"), BLOCK, SHARD_CHARS)
    chars = F.sum(F.coalesce(F.length("text"), F.lit(0)))
    return rows.groupBy("shard").agg(F.count("*").alias("n_docs"), chars.alias("n_chars"), F.floor(chars / 3.5).alias("n_est"))


def _char_budget(spark: SparkSession, d: str) -> DataFrame:
    size = F.least(F.length("text"), F.lit(10_000))
    rows = O.placed(_docs(spark, d).withColumn("size", F.coalesce(size, F.lit(0))), SEED, ["doc_id"], F.col("size"))
    return rows.filter(F.col("running") - F.col("size") <= 200_000).select("doc_id", "running")


_SQL_BUDGET = f"""SELECT doc_id, running::BIGINT AS running FROM (SELECT doc_id, size, sum(size) OVER (ORDER BY {_key('doc_id')} ROWS UNBOUNDED PRECEDING) AS running
  FROM (SELECT doc_id, coalesce(least(length(text), 10000), 0) AS size FROM documents)) WHERE running - size <= 200000"""


def _mixture(spark: SparkSession, d: str) -> DataFrame:
    """Conversations of each set in one seeded order; two sets are taken twice."""
    convs = read(spark, d, "chat_messages").filter("dataset is not null").select("conv_id", "dataset").distinct()
    times = F.when(F.col("dataset") == "general", 1).otherwise(2)
    rows = convs.withColumn("copy", F.explode(F.sequence(F.lit(1), times)))
    return O.placed(rows, SEED, ["dataset", "conv_id", "copy"]).select("dataset", "conv_id", "copy", "place")


_SQL_MIXTURE = f"""
WITH c AS (SELECT DISTINCT conv_id, dataset FROM chat_messages WHERE dataset IS NOT NULL),
m AS (SELECT dataset, conv_id, unnest(range(1, CASE WHEN dataset = 'general' THEN 2 ELSE 3 END))::INT AS copy FROM c)
SELECT dataset, conv_id, copy, row_number() OVER (ORDER BY {_key('dataset', 'conv_id', 'copy')}) AS place FROM m"""


def _hold_out(spark: SparkSession, d: str) -> DataFrame:
    convs = read(spark, d, "chat_messages").filter("dataset = 'general'").select("conv_id").distinct()
    return O.placed(convs, SEED, ["conv_id"]).select("conv_id", (F.col("place") <= 50).alias("held_out"))


def _ema(spark: SparkSession, d: str) -> DataFrame:
    """Smoothed value of each user's events in order, with the correction for the start; 0.9 is kept each step."""
    users = W.Window.partitionBy("user_id")
    rows = read(spark, d, "events").withColumns(
        {"n": F.count("*").over(users), "i": F.row_number().over(users.orderBy("ts", "event_id"))}
    )
    kept = F.sum(F.col("value") * 0.1 * F.pow(F.lit(0.9), F.col("n") - F.col("i")))
    n = F.max("n")
    return rows.groupBy("user_id").agg(n.alias("n"), F.round(kept / (1 - F.pow(F.lit(0.9), n)), 6).alias("ema"))


_SQL_EMA = """
WITH r AS (SELECT user_id, value, count(*) OVER (PARTITION BY user_id) AS n,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events)
SELECT user_id, max(n) AS n, round(sum(value * 0.1 * pow(0.9, n - i)) / (1 - pow(0.9, max(n))), 6) AS ema FROM r GROUP BY user_id"""


def _incremental(spark: SparkSession, d: str) -> DataFrame:
    """Items that are not logged as done; the log is the items fetched before a day, repeated lines and all."""
    items = read(spark, d, "internetarchive")
    log = items.filter(F.col("fetched_at") < F.lit("2024-03-01").cast("timestamp_ntz")).select("identifier")
    return items.select("identifier").distinct().join(log, "identifier", "left_anti")


_SQL_INCREMENTAL = """SELECT DISTINCT identifier FROM internetarchive WHERE identifier NOT IN
  (SELECT identifier FROM internetarchive WHERE fetched_at < TIMESTAMP '2024-03-01' AND identifier IS NOT NULL) AND identifier IS NOT NULL"""


def _first_file(spark: SparkSession, d: str) -> DataFrame:
    texts = F.filter("files", lambda f: f["name"].endswith("_djvu.txt"))
    rows = read(spark, d, "internetarchive").select("identifier", F.get(texts, F.lit(0)).alias("f")).distinct()
    return rows.select("identifier", F.col("f.name").alias("name"), F.coalesce(F.col("f.size").try_cast("bigint"), F.lit(0)).alias("size"))


_SQL_FIRST = """SELECT DISTINCT identifier, f.name AS name, coalesce(TRY_CAST(f.size AS BIGINT), 0) AS size
  FROM (SELECT identifier, list_filter(files, lambda f: suffix(f.name, '_djvu.txt'))[1] AS f FROM internetarchive)"""


def _size_window(spark: SparkSession, d: str) -> DataFrame:
    size = F.col("size")
    outcome = F.when(F.col("name").isNull(), "no_file").when(size < 1000, "too_small").when(size > 50_000_000, "too_large").otherwise("kept")
    return _first_file(spark, d).groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


def _stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Pages taken in from the stream of files, counted by batch name; run again, nothing is read twice."""
    work = S.work_folder(spark)
    keep = lambda df: df.filter("text is not null").select("page_id", "batch_name", F.length("text").alias("n"))
    for _ in range(2):
        S.ingest(S.file_stream(spark, d, "newspapers"), f"{work}/pages", f"{work}/state", keep)
    pages = spark.read.option("recursiveFileLookup", "true").schema("page_id bigint, batch_name string, n int").parquet(f"{work}/pages")
    return pages.groupBy("batch_name").agg(F.count("*").alias("n_pages"), F.sum("n").alias("n_chars"))


def _stream_windows(spark: SparkSession, d: str) -> DataFrame:
    work = S.work_folder(spark)
    S.daily_counts(S.file_stream(spark, d, "events"), f"{work}/days", f"{work}/state", "60 days")
    return S.newest_counts(spark, f"{work}/days").select("day", "event_type", "n", F.round("total", 4).alias("total"))


def _conv_lines(spark: SparkSession, d: str) -> DataFrame:
    """Fenced JSON taken out of messages that carry it, and parsed; a fence inside the JSON ends it, so that nothing
    can be parsed."""
    rows = read(spark, d, "chat_messages").select("conv_id", "turn", "content").filter("content is not null").distinct()
    made = F.concat(F.lit("Here it is.\n```json\n"), F.to_json(F.array(F.struct(F.lit("user").alias("role"), "content"))), F.lit("\n```\nDone."))
    parsed = F.from_json(A.fenced_json(made), A.MESSAGES)
    return rows.select("conv_id", "turn", parsed[0]["content"].alias("content"))


def _report_extract(spark: SparkSession, d: str) -> DataFrame:
    """Values of a report's lines ``- key: value``; of several lines with a key the last counts."""
    rows = read(spark, d, "shards").groupBy("split").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("c"))
    lines = rows.select("split", F.posexplode(F.array(
        F.lit("# Data"), F.concat(F.lit("- rows: "), F.col("n")), F.lit("no value here"), F.concat(F.lit("- chars: "), F.col("c")),
        F.concat(F.lit("- rows: "), F.col("n") + 1),
    )).alias("at", "line"))
    key = F.when(F.col("line").contains("rows"), "rows").when(F.col("line").contains("chars"), "chars")
    value = F.trim(F.get(F.split("line", ":"), F.lit(1)))
    found = lines.withColumns({"key": key, "value": value}).filter("key is not null and value is not null")
    return found.groupBy("split", "key").agg(F.max_by("value", "at").alias("value"))


def _report_pivot(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each source by split, ``-`` where there are none, between the sums of all and of the rest's characters;
    CORE stands first, ChatCORE last, the others by name."""
    shards = read(spark, d, "shards")
    rows = shards.select(F.explode(F.array("source", F.lit("CORE"))).alias("metric"), "split", F.lit(1).cast("bigint").alias("v"))
    chat = shards.select(F.lit("ChatCORE").alias("metric"), "split", F.length("text").cast("bigint").alias("v")).filter("split <> 'train'")
    counts = rows.unionByName(chat).groupBy("metric").pivot("split", ["train", "val", "test"]).agg(F.sum("v").cast("string"))
    order = F.struct(F.col("metric") != "CORE", F.col("metric") == "ChatCORE", "metric")
    return counts.na.fill("-").withColumn("place", F.row_number().over(W.Window.orderBy(order)))  # one row a metric


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    """Names of metrics of two stages, each once, in the order of reports."""
    one = read(spark, d, "events").select(F.col("event_type").alias("metric"))
    two = read(spark, d, "shards").select(F.when(F.col("split") == "train", "CORE").when(F.col("split") == "val", "ChatCORE").otherwise(F.col("source")).alias("metric"))
    names = one.union(two).filter("metric is not null").distinct()
    order = F.struct(F.col("metric") != "CORE", F.col("metric") == "ChatCORE", "metric")
    return names.withColumn("place", F.row_number().over(W.Window.orderBy(order)))


def _fewshot(spark: SparkSession, d: str, shots: int = 2) -> DataFrame:
    """For each book so many others, never itself and no one twice: those that follow a place of the seeded order which
    each book draws for itself; the order goes round."""
    books = read(spark, d, "manifest").filter("ebook_id is not null").select("ebook_id").distinct()
    rows = O.placed(books, SEED, ["ebook_id"]).filter("total > 1")
    drawn = F.conv(F.substring(O.order_key(9, "ebook_id"), 1, 7), 16, 10).cast("bigint")
    wanted = rows.select("ebook_id", "place", "total", drawn.alias("drawn"), F.explode(F.sequence(F.lit(1), F.lit(shots))).alias("shot"))
    at = (F.col("place") + (F.col("drawn") + F.col("shot")) % (F.col("total") - 1)) % F.col("total") + 1
    others = rows.select(F.col("ebook_id").alias("shot_id"), F.col("place").alias("at"))
    return wanted.filter("shot < total").withColumn("at", at).join(others, "at").select("ebook_id", "shot", "shot_id")


_SQL_FEWSHOT = f"""
WITH p AS (SELECT ebook_id, row_number() OVER (ORDER BY {_key('ebook_id')}) AS i, count(*) OVER () AS n, ('0x' || substr({_key('ebook_id', seed=9)}, 1, 7))::BIGINT AS h
  FROM (SELECT DISTINCT ebook_id FROM manifest WHERE ebook_id IS NOT NULL))
SELECT a.ebook_id, s.shot::INT AS shot, b.ebook_id AS shot_id FROM p a, (VALUES (1), (2)) s(shot) JOIN p b ON b.i = (a.i + (a.h + s.shot) % (a.n - 1)) % a.n + 1"""

#: Rows of a row group, and readers.
GROUP, READERS = 8, 4


def _grouped(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "shards").withColumn("row_group", F.floor(F.col("row_idx") / GROUP).cast("int"))


def _slice(spark: SparkSession, d: str, start: int = 10, stop: int = 40, step: int = 3) -> DataFrame:
    """Every third row of a shard from a place on."""
    off = F.col("row_idx") - start
    return read(spark, d, "shards").filter((off >= 0) & (F.col("row_idx") < stop) & (off % step == 0)).select("rec_id", "row_idx")


def _sequence(spark: SparkSession, d: str) -> DataFrame:
    """Two tasks one after the other, with the place of each row in the whole."""
    parts = [read(spark, d, "shards").filter(F.col("split") == s).select(F.lit(i).alias("task"), "rec_id", "shard_name", "row_idx") for i, s in enumerate(("val", "test"))]
    order = F.concat_ws("/", F.col("task"), F.col("shard_name"), F.lpad("row_idx", 9, "0")).alias("order")
    return parts[0].unionByName(parts[1]).select("task", "rec_id", order)


def _smallest(spark: SparkSession, d: str) -> DataFrame:
    pages = read(spark, d, "newspapers").filter(F.length("text") > 0).select("page_id", F.length("text").cast("bigint").alias("n"))
    return pages.distinct().orderBy("n", "page_id").limit(20)


def _manifest_file(spark: SparkSession, d: str) -> DataFrame:
    """The manifest written as a CSV file and read again."""
    path = f"{S.work_folder(spark)}/manifest"
    A.write_catalog(read(spark, d, "manifest").select("ebook_id", "title", "author", "author_death", "year_reason", "language", "url"), path)
    return A.read_catalog(spark, path).distinct()


def _index(spark: SparkSession, d: str) -> DataFrame:
    """A JSON index of batches written as one file and read again, those of too few bytes left out."""
    path = f"{S.work_folder(spark)}/index"
    batches = read(spark, d, "newspapers").groupBy(F.col("batch_name").alias("name")).agg(F.sum(F.octet_length("text")).alias("size"))
    one = F.struct("name", F.concat(F.lit("batches/"), F.col("name"), F.lit(".tar.bz2")).alias("url"), "size")
    whole = batches.filter("name is not null").agg(F.to_json(F.struct(F.collect_list(one).alias("ocr"))).alias("value"))  # one row a batch
    whole.coalesce(1).write.text(path)
    return A.read_index(spark, path).filter(F.col("size") >= 10_000)


def _catalog_range(spark: SparkSession, d: str, most: int = 50_000) -> DataFrame:
    """Items of a span of years with a text among their files, at most so many, by name."""
    has_text = F.exists("files", lambda f: f["name"].endswith(".txt"))
    rows = read(spark, d, "internetarchive").filter(F.col("pub_year").between("1800", "1913") & has_text)
    return rows.select("identifier", "pub_year").distinct().orderBy("identifier", "pub_year").limit(most)


def _running_min(spark: SparkSession, d: str) -> DataFrame:
    over = W.Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(W.Window.unboundedPreceding, 0)
    return read(spark, d, "events").select("event_id", F.min("value").over(over).alias("best"))


def _union(spark: SparkSession, d: str) -> DataFrame:
    docs, recs = read(spark, d, "documents").select("source"), read(spark, d, "shards").select("source")
    return docs.unionByName(recs).groupBy("source").agg(F.count("*").alias("n"))


def _difference(spark: SparkSession, d: str) -> DataFrame:
    held = read(spark, d, "shards").filter("split = 'val'").select(F.col("rec_id").alias("doc_id"))
    return read(spark, d, "documents").select("doc_id").distinct().join(held, "doc_id", "left_anti")


def _without_target(spark: SparkSession, d: str) -> DataFrame:
    have, goal = read(spark, d, "shards").select("source").distinct(), read(spark, d, "source_targets").select("source", "target_share")
    return have.join(goal, "source", "left")


def _bloat(spark: SparkSession, d: str) -> DataFrame:
    """Documents, lines, characters and a quarter of them by source."""
    text = F.coalesce("text", F.lit(""))
    lines, chars = F.sum(F.size(F.split(text, "\n", -1))), F.sum(F.length(text))
    return read(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n_docs"), lines.alias("n_lines"), chars.alias("n_chars"), F.floor(chars / 4).alias("n_est"))


def _latest(spark: SparkSession, d: str) -> DataFrame:
    """The deepest of a split's models, read from names like ``d12/model_000345``, and its last step."""
    name = F.concat(F.lit("d"), F.col("rec_id") % 24, F.lit("/model_"), F.lpad(F.col("row_idx") * 7, 6, "0"))
    files = read(spark, d, "shards").select("split", name.alias("name"))
    depth, step = F.regexp_extract("name", r"^d(\d+)/", 1).cast("int"), F.regexp_extract("name", r"_(\d+)$", 1).cast("int")
    best = F.max(F.struct(depth.alias("depth"), step.alias("step"))).alias("b")
    return files.groupBy("split").agg(best).select("split", "b.depth", "b.step")


def _revenue(spark: SparkSession, d: str) -> DataFrame:
    lines = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    orders = read(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderpriority").agg(F.count_distinct("o_orderkey").alias("n_orders"), F.round(F.sum("r"), 2).alias("revenue"))


def _head(spark: SparkSession, d: str, most: int = 150) -> DataFrame:
    """The first rows of a seeded order."""
    return O.placed(_docs(spark, d), 1337, ["doc_id"]).filter(F.col("place") <= most).select("doc_id", "place")


def _excerpts(spark: SparkSession, d: str, each: int = 3, chars: int = 500) -> DataFrame:
    """A few texts of each source, by a seeded draw, and how they begin."""
    drawn = _docs(spark, d).filter("text is not null").withColumn("key", O.order_key(5, "doc_id"))
    place = F.row_number().over(W.Window.partitionBy("source").orderBy("key", "doc_id"))
    return drawn.withColumn("place", place).filter(F.col("place") <= each).select("source", "doc_id", F.left("text", F.lit(chars)).alias("excerpt"))


def _last_shard(spark: SparkSession, d: str) -> DataFrame:
    rows = O.shards_with_held_out(_docs(spark, d), SEED, ["doc_id"], F.length("text"), BLOCK, SHARD_CHARS)
    return rows.groupBy("shard", "split").agg(F.count("*").alias("n_docs"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n_chars"))


def _fetched(spark: SparkSession, d: str) -> DataFrame:
    """What became of the items of each year: taken, failed (no text came) or passed over (taken before)."""
    items = read(spark, d, "internetarchive").select("identifier", "pub_year", "text", "fetched_at")
    again = F.row_number().over(W.Window.partitionBy("identifier").orderBy("fetched_at", "text")) > 1
    told = items.withColumn("what", F.when(again, "skip").when(F.col("text").isNull(), "fail").otherwise("ok"))
    return told.groupBy("pub_year").agg(*[F.count_if(F.col("what") == w).alias(f"n_{w}") for w in ("ok", "fail", "skip")], F.avg((F.col("what") == "ok").cast("double")).alias("rate"))


def _rounds(spark: SparkSession, d: str) -> DataFrame:
    """Pages taken in round by round, until a round brings less than 100 new ones."""
    work = S.work_folder(spark)
    keep = lambda df: df.select("page_id")
    new = S.rounds(lambda: S.ingest(S.file_stream(spark, d, "newspapers"), f"{work}/pages", f"{work}/state", keep), 100, 2_200_000)
    pages = spark.read.option("recursiveFileLookup", "true").schema("page_id bigint").parquet(f"{work}/pages")
    return pages.agg(F.count("*").alias("n_rows"), F.lit(len(new)).alias("n_rounds"), F.lit(new[-1]).cast("bigint").alias("last_new"))


_RANK = "CASE metric WHEN 'CORE' THEN 0 WHEN 'ChatCORE' THEN 2 ELSE 1 END"
#: Shards of the training rows alone, and the held-out rows as the last one.
_SQL_HELD = f"""
WITH RECURSIVE k AS (SELECT doc_id, coalesce(length(text), 0) AS c, row_number() OVER (ORDER BY {_key('doc_id')}) AS i, count(*) OVER () AS n FROM documents),
s AS (SELECT doc_id, c, i, i <= greatest(1, floor(n * 0.01)) AS held FROM k),
t AS (SELECT doc_id, c, (row_number() OVER (ORDER BY i) - 1) // {BLOCK} AS block FROM s WHERE NOT held),
b AS (SELECT block, sum(c) AS c, count(*) AS n FROM t GROUP BY block),
f AS (SELECT block, 0 AS shard, c AS held, c, n FROM b WHERE block = 0 UNION ALL
  SELECT b.block, CASE WHEN f.held >= {SHARD_CHARS} THEN f.shard + 1 ELSE f.shard END, CASE WHEN f.held >= {SHARD_CHARS} THEN b.c ELSE f.held + b.c END, b.c, b.n
  FROM f JOIN b ON b.block = f.block + 1)
SELECT shard::INT AS shard, 'train' AS split, sum(n)::BIGINT AS n_docs, sum(c)::BIGINT AS n_chars FROM f GROUP BY shard
UNION ALL SELECT (SELECT coalesce(max(shard) + 1, 0) FROM f)::INT, 'val', count(*), sum(c)::BIGINT FROM s WHERE held"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "corpus_summary": _corpus_summary, "source_upweight": _upweight, "doc_batches": _doc_batches,
    "seeded_shuffle": _seeded_shuffle, "train_val_split": _split, "shard_assign": _shards, "shard_stats": _shard_stats,
    "char_budget": _char_budget, "task_mixture": _mixture, "hold_out": _hold_out, "loss_ema": _ema,
    "incremental_anti": _incremental, "first_match_file": _first_file, "size_window": _size_window,
    "stream_ingest": _stream_ingest, "stream_windows": _stream_windows, "extract_fenced_json": _conv_lines,
    "report_extract": _report_extract, "report_pivot": _report_pivot, "fewshot_sample": _fewshot,
    "scan_shards": lambda s, d: read(s, d, "shards").groupBy("shard_name").agg(F.count("*").alias("n_rows"), F.sum(F.length("text")).alias("n_chars")),
    "rowgroup_stride": lambda s, d: _grouped(s, d).filter(F.col("row_group") % READERS == 1).select("rec_id", "row_group"),
    "rank_stride": lambda s, d: read(s, d, "shards").filter(F.pmod("row_idx", F.lit(8)) == 3).select("rec_id"),
    "rank_counts": lambda s, d: read(s, d, "shards").groupBy(F.pmod("row_idx", F.lit(8)).alias("reader")).agg(F.count("*").alias("n")),
    "task_slice": _slice, "task_sequence": _sequence, "smallest_first": _smallest, "manifest_read": _manifest_file, "index_read": _index,
    "catalog_range": _catalog_range, "running_min": _running_min, "union_bag": _union, "set_difference": _difference, "metric_union": _metrics,
    "sources_missing_targets": _without_target, "bloat_metrics": _bloat, "latest_checkpoint": _latest, "order_revenue": _revenue,
    "head_of_order": _head, "excerpts": _excerpts, "shard_held_out": _last_shard, "fetch_counters": _fetched, "ingest_rounds": _rounds,
}

ORACLES: dict[str, str] = {
    "corpus_summary": _SQL_SUMMARY, "source_upweight": _SQL_UPWEIGHT,
    "doc_batches": rf"""SELECT rec_id, e.epoch::INT AS epoch, regexp_extract(shard_name, '([0-9]+)', 1)::INT AS shard, (row_idx // {GROUP})::INT AS row_group
        FROM shards, (VALUES (1), (2)) e(epoch) WHERE (row_idx // {GROUP}) % {READERS} = 1 AND (e.epoch > 1 OR regexp_extract(shard_name, '([0-9]+)', 1)::INT > 0 OR row_idx // {GROUP} >= 2)""",
    "seeded_shuffle": f"SELECT doc_id, row_number() OVER (ORDER BY {_key('doc_id')}) AS place FROM documents",
    "train_val_split": _SQL_SPLIT, "shard_assign": _SQL_SHARDS,
    "shard_stats": f"SELECT shard, count(*) AS n_docs, sum(coalesce(length(text), 0))::BIGINT AS n_chars, floor(sum(coalesce(length(text), 0)) / 3.5)::BIGINT AS n_est FROM ({_SQL_SHARDS}) JOIN documents USING (doc_id) GROUP BY shard",
    "char_budget": _SQL_BUDGET, "task_mixture": _SQL_MIXTURE,
    "hold_out": f"SELECT conv_id, row_number() OVER (ORDER BY {_key('conv_id')}) <= 50 AS held_out FROM (SELECT DISTINCT conv_id FROM chat_messages WHERE dataset = 'general')",
    "loss_ema": _SQL_EMA, "incremental_anti": _SQL_INCREMENTAL, "first_match_file": _SQL_FIRST,
    "size_window": f"SELECT CASE WHEN name IS NULL THEN 'no_file' WHEN size < 1000 THEN 'too_small' WHEN size > 50000000 THEN 'too_large' ELSE 'kept' END AS outcome, count(*) AS n FROM ({_SQL_FIRST}) GROUP BY 1",
    "stream_ingest": "SELECT batch_name, count(*) AS n_pages, sum(length(text))::BIGINT AS n_chars FROM newspapers WHERE text IS NOT NULL GROUP BY batch_name",
    "stream_windows": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "extract_fenced_json": "SELECT DISTINCT conv_id, turn, CASE WHEN NOT contains(content, '```') THEN content END AS content FROM chat_messages WHERE content IS NOT NULL",
    "report_extract": "SELECT split, k.key, CASE WHEN k.key = 'rows' THEN (n + 1)::VARCHAR ELSE c::VARCHAR END AS value FROM (SELECT split, count(*) AS n, sum(length(text)) AS c FROM shards GROUP BY split), (VALUES ('rows'), ('chars')) k(key)",
    "report_pivot": f"""WITH r AS (SELECT source AS metric, split, 1 AS v FROM shards UNION ALL SELECT 'CORE', split, 1 FROM shards UNION ALL SELECT 'ChatCORE', split, length(text) FROM shards WHERE split <> 'train')
        SELECT metric, coalesce(sum(v) FILTER (split = 'train')::VARCHAR, '-') AS train, coalesce(sum(v) FILTER (split = 'val')::VARCHAR, '-') AS val, coalesce(sum(v) FILTER (split = 'test')::VARCHAR, '-') AS test,
          row_number() OVER (ORDER BY {_RANK}, metric)::INT AS place FROM r GROUP BY metric""",
    "fewshot_sample": _SQL_FEWSHOT,
    "scan_shards": "SELECT shard_name, count(*) AS n_rows, sum(length(text))::BIGINT AS n_chars FROM shards GROUP BY shard_name",
    "rowgroup_stride": f"SELECT rec_id, (row_idx // {GROUP})::INT AS row_group FROM shards WHERE (row_idx // {GROUP}) % {READERS} = 1",
    "rank_stride": "SELECT rec_id FROM shards WHERE row_idx % 8 = 3",
    "rank_counts": "SELECT row_idx % 8 AS reader, count(*) AS n FROM shards GROUP BY 1",
    "task_slice": "SELECT rec_id, row_idx FROM shards WHERE list_contains(range(10, 40, 3), row_idx)",
    "task_sequence": "SELECT CASE split WHEN 'val' THEN 0 ELSE 1 END AS task, rec_id, CASE split WHEN 'val' THEN '0/' ELSE '1/' END || shard_name || '/' || format('{:09d}', row_idx) AS \"order\" FROM shards WHERE split IN ('val', 'test')",
    "smallest_first": "SELECT page_id, n FROM (SELECT DISTINCT page_id, length(text) AS n FROM newspapers WHERE text <> '') ORDER BY n, page_id LIMIT 20",
    "manifest_read": "SELECT DISTINCT ebook_id, title, author, author_death, year_reason, language, url FROM manifest",
    "index_read": "SELECT batch_name AS name, 'batches/' || batch_name || '.tar.bz2' AS url, sum(strlen(text))::BIGINT AS size FROM newspapers WHERE batch_name IS NOT NULL GROUP BY batch_name HAVING sum(strlen(text)) >= 10000",
    "catalog_range": "SELECT DISTINCT identifier, pub_year FROM internetarchive WHERE pub_year >= '1800' AND pub_year <= '1913' AND len(list_filter(files, lambda f: suffix(f.name, '.txt'))) > 0",
    "running_min": "SELECT a.event_id, min(b.value) AS best FROM events a JOIN events b ON b.user_id = a.user_id AND (b.ts, b.event_id) <= (a.ts, a.event_id) GROUP BY a.event_id",
    "union_bag": "SELECT source, count(*) AS n FROM (SELECT source FROM documents UNION ALL SELECT source FROM shards) GROUP BY source",
    "set_difference": "SELECT doc_id FROM documents EXCEPT SELECT rec_id FROM shards WHERE split = 'val'",
    "metric_union": f"SELECT metric, row_number() OVER (ORDER BY {_RANK}, metric)::INT AS place FROM (SELECT event_type AS metric FROM events UNION SELECT CASE split WHEN 'train' THEN 'CORE' WHEN 'val' THEN 'ChatCORE' ELSE source END FROM shards) WHERE metric IS NOT NULL",
    "sources_missing_targets": "SELECT source, (SELECT any_value(target_share) FROM source_targets t WHERE t.source = s.source) AS target_share FROM shards s GROUP BY source",
    "bloat_metrics": "SELECT source, count(*) AS n_docs, sum(1 + length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')))::BIGINT AS n_lines, sum(length(coalesce(text, '')))::BIGINT AS n_chars, (sum(length(coalesce(text, ''))) // 4)::BIGINT AS n_est FROM documents GROUP BY source",
    "latest_checkpoint": "SELECT split, max(rec_id % 24)::INT AS depth, arg_max(row_idx * 7, (rec_id % 24) * 1000000 + row_idx * 7)::INT AS step FROM shards GROUP BY split",
    "order_revenue": "SELECT o_orderpriority, count(DISTINCT o_orderkey) AS n_orders, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderpriority",
    "head_of_order": f"SELECT doc_id, row_number() OVER (ORDER BY {_key('doc_id', seed=1337)}) AS place FROM documents QUALIFY place <= 150",
    "excerpts": f"SELECT source, doc_id, left(text, 500) AS excerpt FROM documents WHERE text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source ORDER BY {_key('doc_id', seed=5)}) <= 3",
    "shard_held_out": _SQL_HELD,
    "fetch_counters": "SELECT pub_year, count(*) FILTER (i = 1 AND text IS NOT NULL) AS n_ok, count(*) FILTER (i = 1 AND text IS NULL) AS n_fail, count(*) FILTER (i > 1) AS n_skip, count(*) FILTER (i = 1 AND text IS NOT NULL) / count(*) AS rate FROM (SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY fetched_at, text NULLS FIRST) AS i FROM internetarchive) GROUP BY pub_year",
    "ingest_rounds": "SELECT count(*) AS n_rows, CASE WHEN count(*) < 100 THEN 1 ELSE 2 END::INT AS n_rounds, CASE WHEN count(*) < 100 THEN count(*) ELSE 0 END AS last_new FROM newspapers",
}
