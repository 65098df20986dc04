"""Operators against plain Python and edge cases: catalog, prompts, rendering, schedules, sinks."""

import pytest
from pyspark.sql import functions as F

from quernwork.functions import training
from quernwork.operators import catalog, conversations, filters, ordering, tokens
from quernwork.sources import archives
from quernwork.streaming import ingest

ENTRY = "ebook_id int, author string, author_birth int, author_death int, language string, subjects array<string>, description string, has_text boolean"


def test_catalog_rules_in_order(spark):
    cases = [
        (("A", 1800, 1913, "en", [], "", True), True, "author died 1913", "included"),
        (("A", None, 1914, "en", ["Art -- 18th CENTURY"], "", True), True, "subject indicates pre-1914: Art -- 18th CENTURY", "included"),
        (("A", None, 1950, "en", ["x"], "of 1801, again 1950", True), True, "description mentions year 1801", "included"),
        (("A", None, 1950, "en", None, "of 1950, first 1801", True), False, "author died 1950, no pre-1914 evidence", "excluded"),
        (("A", 1849, None, "en", [], None, False), True, "author born 1849, likely pre-1914", "no_text"),
        (("A", 1850, None, "en", [], "", True), False, "no date information available", "excluded"),
        (("", None, None, "en", ["Cooking", "Bible. N.T."], "", True), True, "anonymous but subject indicates historical: Bible. N.T.", "included"),
        ((None, None, None, "en", [], "", True), False, "anonymous, no date signal", "excluded"),
        (("", None, 1950, "en", [], "", True), False, "anonymous, no date signal", "excluded"),
        (("A", 1800, 1860, "fr", [], "", False), True, "author died 1860", "excluded"),
    ]
    rows = spark.createDataFrame([(i, *entry) for i, (entry, *_) in enumerate(cases)], ENTRY).select("ebook_id", F.struct("*").alias("e"))
    got = rows.select("ebook_id", catalog.pre_1914(F.col("e")).alias("p"), catalog.outcome(F.col("e")).alias("o")).orderBy("ebook_id").collect()
    assert [(r.p.ok, r.p.reason, r.o) for r in got] == [tuple(c[1:]) for c in cases]
    none = spark.createDataFrame([(None,)], f"e struct<{ENTRY.replace(' ', ':').replace(',:', ',')}>")
    assert none.select(catalog.outcome(F.col("e"))).first()[0] == "parse_error"


def test_every_outcome_of_the_catalog_occurs(spark):
    from quernwork.plans import catalog_queries

    rows = catalog_queries._counters(spark, "/root/testdata/sf0.01").collect()
    assert {r.outcome for r in rows} == {"parse_error", "excluded", "no_text", "included"}
    reasons = {r.reason.split(":")[0].rstrip("0123456789") for r in catalog_queries._selected(spark, "/root/testdata/sf0.01").collect()}
    assert len(reasons) >= 6


MESSAGES = "messages array<struct<role:string,content:string>>"


def faults(spark, convs, rule):
    rows = spark.createDataFrame([([tuple(m) for m in c],) for c in convs], MESSAGES)
    return [r[0] for r in rows.coalesce(1).select(rule(F.col("messages"))).collect()]


def test_stored_and_generated_conversations(spark):
    convs = [
        [("user", "a"), ("assistant", "b")], [("user", "a")], [("assistant", "a"), ("user", "b")], [("user", None), ("assistant", "b")],
        [("user", "\n"), ("assistant", " 　")], [("user", "a"), ("user", "b")], [],
    ]
    assert faults(spark, convs, conversations.fault) == [None, "too_few", "roles", "no_content", None, "roles", "too_few"]
    assert faults(spark, convs, conversations.generated_fault) == [None, "too_few", "roles", "no_content", "blank", "roles", "too_few"]


def test_requests_name_the_first_broken_limit(spark):
    def rule(messages, t=None, k=None, m=None):
        lit = lambda v, kind: F.lit(v).cast(kind)
        return conversations.request_fault(messages, lit(t, "double"), lit(k, "int"), lit(m, "int"))

    convs = [[], [("user", "")], [("user", "x" * 8001), ("user", "")], [("user", ""), ("user", "x" * 8001)], [("user", "x" * 7000)] * 5, [("system", "x")], [("user", "x")], [(None, "x")]]
    want = ["no_messages", "empty_message", "message_too_long", "empty_message", "conversation_too_long", "bad_role", None, "bad_role"]
    assert faults(spark, convs, rule) == want
    assert faults(spark, [[("user", "x")] * 501], rule) == ["too_many_messages"]
    for given, fault in (((2.1,), "temperature"), ((2.0, 201), "top_k"), ((0.0, 0, 0), "max_tokens"), ((0.0, 200, 4096), None)):
        assert faults(spark, [[("user", "x")]], lambda c, g=given: rule(c, *g)) == [fault]


def test_prompts_keep_an_empty_line_between_examples(spark):
    shots = F.expr("array(named_struct('before', ' q1 ', 'after', 'a1'), named_struct('before', 'q2', 'after', 'a2'))")
    row = spark.range(1).select(
        conversations.choice_prompts(F.lit("q"), F.array(F.lit("x"), F.lit("y")), shots).alias("mc"),
        conversations.continued_prompts(F.lit("  c\t"), F.lit("d"), shots).alias("lm"),
        conversations.context_prompts(F.array(F.lit("x")), F.lit("end"), F.slice(shots, 1, 0)).alias("schema"),
    ).first()
    assert row.mc == [" q1  a1\n\nq2 a2\n\nq x", " q1  a1\n\nq2 a2\n\nq y"]
    assert row.lm == ["q1 a1\n\nq2 a2\n\nc", "q1 a1\n\nq2 a2\n\nc d"] and row.schema == ["x end"]


def test_spans_of_more_than_two_options(spark):
    seqs = F.lit([[1, 2, 3, 9, 9], [1, 2, 4, 9, 9], [1, 2, 3, 5, 9, 9]])
    got = spark.range(1).select(*[conversations.spans(k, seqs).alias(k) for k in ("choices", "contexts", "continued")]).first()
    assert [tuple(s) for s in got.choices] == [(2, 5), (2, 5), (2, 6)]
    assert [tuple(s) for s in got.contexts] == [(3, 5), (3, 5), (4, 6)]
    assert got.continued is None
    two = spark.range(1).select(conversations.spans("continued", F.lit([[1, 2], [1, 2, 3]]))).first()[0]
    assert [tuple(s) for s in two] == [(2, 3)]


def test_parts_of_answers(spark):
    rows = spark.createDataFrame(
        [([("user", [("text", "hi")]), ("assistant", [("text", "a"), ("python", "1+1"), ("python_output", "2"), ("text", "b")])],)],
        "messages array<struct<role:string,parts:array<struct<type:string,text:string>>>>",
    )
    r = rows.select(tokens.render_parts(F.col("messages"), None).alias("r")).first().r
    p = {s: 256 + i for i, s in enumerate(tokens.SPECIALS)}
    want = [(p["<|bos|>"], 0), (p["<|user_start|>"], 0), (104, 0), (105, 0), (p["<|user_end|>"], 0), (p["<|assistant_start|>"], 0), (97, 1)]
    want += [(p["<|python_start|>"], 1), (49, 1), (43, 1), (49, 1), (p["<|python_end|>"], 1), (p["<|output_start|>"], 0), (50, 0), (p["<|output_end|>"], 0)]
    want += [(98, 1), (p["<|assistant_end|>"], 1)]
    assert list(zip(r.ids, r.mask)) == want
    odd = spark.createDataFrame([([("assistant", [("image", "x")])],)], rows.schema)
    assert odd.select(tokens.render_parts(F.col("messages"))["ids"]).first()[0] is None


def test_requests_are_neither_merged_nor_cut(spark):
    rows = spark.createDataFrame([([("system", "s"), ("assistant", "é" * 3000), ("assistant", "")],)], MESSAGES)
    ids = rows.select(tokens.render_request(F.col("messages"))).first()[0]
    assert len(ids) == 1 + 6002 + 2 + 1 and ids[:2] == [256, 259] and ids[-2:] == [260, 259]


def test_long_unbroken_pieces_take_little_time():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"abab": 257, b"ba": 258}
    assert tokens.encode_piece(b"ab" * 100_000, ranks) == [257] * 50_000
    assert tokens.encode_piece(b"", ranks) == [] and tokens.encode_piece(b"aba", ranks) == [256, 97]


def test_encode_puts_marks_around_and_refuses_large_vocabularies(spark):
    docs = spark.createDataFrame([("hi",), ("",), (None,)], "text string").coalesce(1)
    vocabulary = tokens.train_bpe(docs, "text", 265)
    got = [r.ids for r in tokens.encode(docs, "text", vocabulary, prepend="<|bos|>", append=7).collect()]
    bos = vocabulary.filter(F.col("token") == F.lit(b"<|bos|>")).first().token_id
    assert got == [[bos, 104, 105, 7], [bos, 7], None]
    with pytest.raises(ValueError):
        tokens.decode(docs, "ids", vocabulary, most_tokens=10)


def test_padded_packing_and_its_targets(spark):
    with pytest.raises(ValueError):
        list(tokens.pack_rows(iter([[1] * 9]), 5, 10, False, 0, cut_long=False))
    assert list(tokens.pack_rows(iter([[1] * 9]), 5, 10, False, 0))[0] == ([1] * 5, 5, 4)
    ids = F.lit([5, 6, 7, 0, 0, 0])
    got = spark.range(1).select(tokens.ignored_padding(F.slice(ids, 2, 5), F.lit(3), 6), tokens.ignored_padding(F.slice(ids, 2, 5), F.lit(6), 6)).first()
    assert got[0] == [6, 7, -1, -1, -1] and got[1] == [6, 7, 0, 0, 0]


def test_schedules_at_their_corners(spark):
    rows = spark.createDataFrame([(s,) for s in (0, 9, 10, 50, 51, 100)], "s int")
    lr = [r[0] for r in rows.select(training.lr_by_step(F.col("s"), 100, 10, 0.5, 0.1)).collect()]
    assert lr == pytest.approx([0.1, 1.0, 1.0, 1.0, 0.982, 0.1])
    assert spark.range(1).select(training.lr_by_progress(F.lit(1.0), 0.0, 0.5, 0.2)).first()[0] == pytest.approx(0.2)
    values = spark.range(1).select(training.shown_int(F.lit(9999)), training.shown_int(F.lit(1234567)), training.shown_float(F.lit(2) / 3)).first()
    assert tuple(values) == ("9999", "1,234,567", "0.6667")


def test_model_sizes(spark):
    shape = training.Shape(*[F.lit(v) for v in (4, 256, 2, 1, 1000, 2048)], pattern="SL")
    row = spark.range(1).select(shape.windows().alias("w"), shape.parameters().alias("p"), shape.flops_per_token().alias("f")).first()
    assert row.w == [512, 2048, 512, 2048]
    kv, table = 128, 1024
    matrices = 4 * (2 * 256 * 256 + 2 * 256 * kv + 8 * 256 * 256) + 2 * 12
    assert (row.p.wte, row.p.value_embeds, row.p.matrices, row.p.scalars) == (table * 256, 2 * table * kv, matrices, 8 + 26)
    assert row.f == 6 * (matrices + table * 256) + 12 * 256 * (2 * 512 + 2 * 2048)
    half = spark.range(1).select(training.run_plan(F.lit(2.0 ** (0.5 / 0.383)), F.lit(1.0), 0.2)["batch"]).first()[0]
    assert half in (1 << 19, 1 << 20)


def test_first_rule_and_clock(spark):
    names = spark.createDataFrame([("NVIDIA H200 NVL",), ("h200",), ("GB200 x",), ("other",), (None,)], "n string")
    assert [r[0] for r in names.select(training.first_rule(F.col("n"), training.PEAKS)).collect()] == [836e12, 989e12, 2.5e15, None, None]
    took = spark.sql("select timestamp'2024-01-01 00:00:59' a, timestamp'2024-01-02 01:01:58' b, cast(null as timestamp) c")
    assert tuple(took.select(training.wall_clock(F.col("a"), F.col("b")), training.wall_clock(F.col("a"), F.col("c"))).first()) == ("25h0m", "unknown")


def test_sinks(spark, tmp_path):
    one = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "k string, v int")
    path = str(tmp_path / "x")
    assert archives.write_new(one, path, "k") == 2 and archives.write_new(one, path, "k") == 0
    assert spark.read.parquet(path).count() == 2
    vocabulary = tokens.special_tokens(spark).select("token_id", F.col("name").cast("binary").alias("token"))
    archives.save_vocabulary(vocabulary, str(tmp_path / "v"), tokens.SPLIT)
    assert archives.load_vocabulary(spark, str(tmp_path / "v")).count() == 9
    lines = archives.results_lines(spark.createDataFrame([("t", 0.5, 0.25)], "task string, accuracy double, centered double")).orderBy("place").collect()
    assert lines[1].line == f"{'t':<35}, {0.5:<10.6f}, {0.25:<10.6f}" and lines[2].line == f"{'CORE':<35}, {'':<10}, {0.25:<10.6f}"


def test_rounds_stop():
    new = iter([500, 300, 20, 9])
    assert ingest.rounds(lambda: next(new), 100, 10_000) == [500, 300, 20]
    new = iter([500, 600, 700])
    assert ingest.rounds(lambda: next(new), 100, 1000) == [500, 600]


def test_held_out_shard_is_last(spark):
    df = spark.range(300).withColumn("text", F.lit("x" * 10))
    rows = ordering.shards_with_held_out(df, 1, ["id"], F.length("text"), 8, 200, share=0.1).collect()
    last = max(r.shard for r in rows)
    assert {r.split for r in rows if r.shard == last} == {"val"} and sum(r.split == "val" for r in rows) == 30
    assert {r.split for r in rows if r.shard < last} == {"train"} and len(rows) == 300


def test_an_empty_lexicon_is_refused(spark):
    pages = spark.createDataFrame([("x",)], "text string")
    with pytest.raises(ValueError):
        filters.known_word_share(pages, spark.createDataFrame([], "word string"))


def test_words_are_known_without_a_join(spark):
    pages = spark.createDataFrame([("the cat", "q")], "text string, word string")
    df = filters.known_word_share(pages, spark.createDataFrame([("the",)], "word string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and df.first().quality == 0.5
