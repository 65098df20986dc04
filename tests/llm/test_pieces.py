import base64

import pytest
import tiktoken
from pyspark.sql import functions as F

from quernwork.llm import p4_tokens, p7_encoding, pieces
from quernwork.llm.common import vocabulary_path

public_tokenizers = pytest.importorskip("public_tokenizers")

ODD = [
    "", "   ", "\n\n\n  x", "a" * 700, "Hello’s world's 123 4567!!", None, "日本語 текст  ͫ",
    "<|endoftext|> [INST] </s>", "\x00\x01 \x85 sep", "don't  DON'T 'll", "é" * 300, "\U0001f600\U0001f600 ok", "x  \n y",
]


@pytest.fixture(scope="module")
def truth():
    path = vocabulary_path(pieces.RANK_FILE)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    code = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return code.encode_ordinary


def frame(spark, values):
    return spark.createDataFrame([(i, v, "x") for i, v in enumerate(values)], "doc_id bigint, text string, ids string")


def test_ids_are_the_public_ones(spark, truth):
    got = {r.doc_id: r.ids for r in p7_encoding.encode_documents(frame(spark, ODD + ODD[:3])).collect()}
    assert got == {i: truth(v or "") for i, v in enumerate(ODD + ODD[:3])}


@pytest.mark.parametrize("hot_pieces", [0, 3])
def test_rare_pieces_are_encoded_where_they_stand(spark, truth, hot_pieces):
    docs = frame(spark, ODD).drop("ids")
    counted = pieces.with_token_counts(docs, hot_pieces=hot_pieces)
    assert {r.doc_id: r.n_tokens for r in counted.collect()} == {i: len(truth(v or "")) for i, v in enumerate(ODD)}
    encoded = pieces.with_ids(docs, hot_pieces=hot_pieces)
    assert {r.doc_id: r.ids for r in encoded.collect()} == {i: truth(v or "") for i, v in enumerate(ODD)}
    for df in (counted, encoded):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan


def test_budget_of_documents_and_of_pieces_agree(spark, smoke_dir):
    docs, books = (spark.read.parquet(f"{smoke_dir}/{t}.parquet") for t in ("documents", "manifest"))
    keys = ["source", "language", "domain"]
    rows = p4_tokens.document_tokens(docs, books).groupBy(*keys).agg(F.count("*").alias("a"), F.sum("n_tokens").alias("b"))
    total = p4_tokens.token_budget(docs, books).filter("level = 'source, language, domain'")
    assert sorted(map(str, rows.collect())) == sorted(map(str, total.select(*keys, F.col("n_docs").alias("a"), F.col("n_tokens").alias("b")).collect()))


def test_queue_and_fold_agree(spark, truth):
    table = pieces.ranks(vocabulary_path(pieces.RANK_FILE))
    words = [" unfurnished", "Drayminster", "ééé", "zzzzzzzz", " ", "1863", "aaaaaaaaaaaaaaaaaaaaaaaa"]
    rows = spark.createDataFrame([(w,) for w in words], "piece string")
    fold = pieces.bound(pieces.rank_table(vocabulary_path(pieces.RANK_FILE)), lambda t: pieces.fold_merges(F.col("piece"), t))
    got = {r.piece: r.ids for r in rows.select("piece", fold.alias("ids")).collect()}
    for w in words:
        assert got[w] == pieces.queue_merges(w.encode(), table) == truth(w)


def test_round_trip_and_empty_table(spark):
    docs = pieces.with_ids(frame(spark, ODD).drop("ids"))
    rows = docs.select("text", pieces.decode(F.col("ids")).alias("back")).collect()
    assert all(r.back == (r.text or "") for r in rows)
    empty = p7_encoding.encode_documents(frame(spark, ODD).limit(0))
    assert empty.columns == ["doc_id", "ids"] and empty.count() == 0


DOCUMENT = "doc_id bigint, text string, lang string, source string, domain string, ebook_id int"
BOOK = "ebook_id int, language string"


def test_totals_by_language_of_the_book(spark, truth):
    docs = spark.createDataFrame(
        [
            (1, "one two", "en", "gutenberg", "a", 7), (2, "drei", " EN ", "gutenberg", None, 8), (3, None, None, "news", None, None),
            (4, "le mot", "fra", "news", "a", 7), (4, "le mot", "fra", "news", "a", 7),
        ],
        DOCUMENT,
    )
    books = spark.createDataFrame([(7, "German"), (7, "German"), (8, None), (None, "en")], BOOK)
    rows = {r.doc_id: r for r in p4_tokens.document_tokens(docs, books).collect()}
    assert {k: r.language for k, r in rows.items()} == {1: "de", 2: "en", 3: "und", 4: "fr"}
    assert rows[3].n_tokens == 0
    total = p4_tokens.token_budget(docs, books)
    whole = total.filter("level = 'all'").first()
    want = sum(len(truth(t)) for t in ("one two", "drei", "le mot", "le mot"))
    assert (whole.n_docs, whole.n_with_text, whole.n_tokens) == (5, 4, want)
    for level in ("source", "language", "domain", "source, language, domain"):
        assert total.filter(F.col("level") == level).agg(F.sum("n_tokens")).first()[0] == want


def test_totals_of_an_empty_table(spark):
    docs, books = spark.createDataFrame([], DOCUMENT), spark.createDataFrame([], BOOK)
    assert p4_tokens.document_tokens(docs, books).count() == 0
    assert p4_tokens.token_budget(docs, books).filter("level <> 'all'").count() == 0
