import random
import re
import tarfile
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quernwork.functions import rdf, text
from quernwork.operators import conversations, filters, ordering, tokens
from quernwork.sources import archives
from quernwork.streaming import ingest

ODD = ["", "   ", "a  b\t\r\n\r\n\r\nc ", "﻿x  y\x0b", None, "é", "\x1c x \x85", "«é» " * 50, "x" * 5000]


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def run(spark, values, column):
    rows = texts(spark, values).select("i", column(F.col("t")).alias("o")).collect()
    return [r.o for r in sorted(rows)]


def test_strip_is_pythons(spark):
    assert run(spark, ODD, text.strip) == [None if v is None else v.strip() for v in ODD]


def test_collapse_whitespace(spark):
    def want(t):
        t = t.replace("\r\n", "\n").replace("\r", "\n")
        t = re.sub(r"[ \t]+$", "", t, flags=re.MULTILINE)
        return re.sub(r"\n{3,}", "\n\n", t).strip()

    assert run(spark, ODD, text.collapse_whitespace) == [None if v is None else want(v) for v in ODD]


def test_normalize_unicode(spark):
    got = run(spark, [*ODD, "â\x80\x99s"], text.normalize_unicode)
    assert got[:4] == [v.replace("﻿", "") for v in ODD[:4]] and got[4] is None
    assert got[5] == unicodedata.normalize("NFC", ODD[5]) and got[-1] == "’s"


def test_markers_and_licences(spark):
    book = "front *** START OF THE PROJECT GUTENBERG EBOOK X *** body\n*** END OF THIS PROJECT GUTENBERG EBOOK *** tail"
    assert run(spark, [book, "plain", None], text.strip_markers) == ["body", "plain", None]
    told = "one\nDigitized by the Internet Archive\nsee https://a.b/c now\nFull Project Gutenberg text\nlost"
    assert run(spark, [told, "", None], text.drop_boilerplate) == ["one\nsee  now", "", None]


def test_article_title(spark):
    got = run(spark, ["HOLM, the isle", "OLD AGE is", "lower", "", None], lambda c: text.article_title(c, F.lit("article_0")))
    assert got == ["HOLM", "OLD AGE", "article_0", "article_0", "article_0"]


def test_first_year_takes_the_first_number_only(spark):
    assert run(spark, ["in 0999 or 1850", "1850 1999", "12345", None], text.first_year) == [None, 1850, None, None]


def test_anachronisms_in_order(spark):
    got = run(spark, ["The Internet and a World War I radar", "period text", None], filters.anachronisms)
    assert got == [["world war", "internet", "radar", "world war i"], [], None]


def test_known_word_share_handles_nulls_and_copies(spark):
    pages = spark.createDataFrame([(1, "the cat zzz"), (2, "the cat zzz"), (3, None), (4, "")], "page_id int, text string")
    words = spark.createDataFrame([("The",), ("cat",)], "word string")
    got = {r.page_id: r.quality for r in filters.known_word_share(pages, words).collect()}
    assert got[1] == got[2] == pytest.approx(2 / 3) and got[3] == got[4] == 0.0


def test_places_are_those_of_one_sort(spark):
    df = spark.range(500).withColumn("w", F.col("id") % 7)
    rows = ordering.placed(df, 3, ["id"], F.col("w")).orderBy("place").collect()
    assert [r.place for r in rows] == list(range(1, 501))
    total = 0
    for r in rows:
        total += r.w
        assert r.running == total
    assert ordering.placed(df.limit(0), 3, ["id"]).count() == 0


def test_split_holds_out_at_least_one(spark):
    rows = ordering.split_held_out(spark.range(20), 1, ["id"]).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in rows} == {"val": 1, "train": 19}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80), st.integers(5, 40), st.booleans())
def test_packing_keeps_every_token_or_counts_it(sizes, capacity, crop):
    sequences = [[k] * n for k, n in enumerate(sizes)]
    rows = list(tokens.pack_rows(iter(sequences), capacity, 10, crop, -1))
    assert all(len(r) == capacity for r, _, _ in rows)
    kept = sum(n for _, n, _ in rows)
    lost = sum(c for _, _, c in rows)
    assert kept + lost == sum(sizes)
    assert all(r[n:] == [-1] * (capacity - n) for r, n, _ in rows)


def test_packing_takes_the_longest_that_fits():
    rows = list(tokens.pack_rows(iter([[1] * 4, [2] * 7, [3] * 3]), 10, 10, True, 0))
    assert rows[0][0] == [2] * 7 + [3] * 3 and rows[1][0] == [1] * 4 + [0] * 6


def test_trained_pairs_match_a_plain_count():
    rng = random.Random(1)
    words = [("".join(rng.choice("abc") for _ in range(rng.randint(1, 6))), rng.randint(1, 9)) for _ in range(30)]
    words = list(dict(words).items())
    fast = tokens.train_pairs(words, 8)
    state = [[bytes([b]) for b in w.encode()] for w, _ in words]
    slow = []
    for _ in range(8):
        counts = {}
        for word, (_, n) in zip(state, words):
            for p in zip(word, word[1:]):
                counts[p] = counts.get(p, 0) + n
        if not counts:
            break
        best = min(counts, key=lambda p: (-counts[p], p))
        slow.append((*best, counts[best]))
        for i, word in enumerate(state):
            new, k = [], 0
            while k < len(word):
                if k + 1 < len(word) and (word[k], word[k + 1]) == best:
                    new.append(word[k] + word[k + 1])
                    k += 2
                else:
                    new.append(word[k])
                    k += 1
            state[i] = new
    assert fast == slow


def test_calculator_never_runs_code(spark):
    values = ["1,200 + 3*(2-5)", "2**9", "'strawberry'.count('r')", "__import__('os')", "1/0", None, "(" * 5000]
    assert run(spark, values, tokens.calculator) == ["1191", None, "3", None, None, None, None]


def test_conversation_faults(spark):
    df = spark.createDataFrame(
        [
            (1, 0, "User", "hi"), (1, 1, "bot", "yes"), (1, 1, "bot", "yes"), (2, 0, "user", "hi"),
            (3, 0, "user", "a"), (3, 1, "user", "b"), (4, 0, "human", "a"), (4, 1, "assistant", None),
        ],
        "conv_id int, turn int, role string, content string",
    )
    rows = conversations.conversations(df).select("conv_id", conversations.fault(F.col("messages")).alias("f")).collect()
    assert {r.conv_id: r.f for r in rows} == {1: None, 2: "too_few", 3: "roles", 4: "no_content"}


def test_rdf_without_a_book_is_null(spark):
    assert rdf.parse("<a/>") is None and rdf.parse("<broken") is None and rdf.parse(None) is None


def test_archive_reader(spark, tmp_path):
    for name, body in (("a/1901/x/ocr.txt", b"page"), ("a/other.xml", b"no")):
        path = tmp_path / name.replace("/", "_")
        path.write_bytes(body)
    with tarfile.open(tmp_path / "b.tar.bz2", "w:bz2") as tar:
        tar.add(tmp_path / "a_1901_x_ocr.txt", arcname="a/1901/x/ocr.txt")
        tar.add(tmp_path / "a_other.xml", arcname="a/other.xml")
    rows = archives.read_tar(spark, str(tmp_path / "b.tar.bz2"), "ocr.txt").collect()
    assert [(r.member, bytes(r.body)) for r in rows] == [("a/1901/x/ocr.txt", b"page")]


def test_bytes_decode_with_fallback(spark):
    df = spark.createDataFrame([("é".encode(),), ("é".encode("latin-1"),)], "b binary")
    assert [r.t for r in df.select(archives.decode_bytes(F.col("b")).alias("t")).collect()] == ["é", "é"]


def test_shards_are_written_with_small_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    df = spark.range(3000).select((F.col("id") % 2).cast("int").alias("shard"), F.col("id").alias("place"), F.lit("t").alias("text"))
    archives.write_shards(df, str(tmp_path / "s"))
    file = next((tmp_path / "s" / "shard=0").glob("*.parquet"))
    meta = pq.ParquetFile(file).metadata
    assert meta.num_row_groups == 2 and meta.row_group(0).column(0).compression == "ZSTD"


def test_catalog_and_conversations_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, "T, x", None, None, "r", "en", "u")], archives.CATALOG)
    archives.write_catalog(rows, str(tmp_path / "c"))
    assert archives.read_catalog(spark, str(tmp_path / "c")).first().title == "T, x"
    talk = spark.sql("SELECT array(named_struct('role', 'user', 'content', 'hi')) AS messages")
    archives.append_conversations(talk, str(tmp_path / "j"))
    archives.append_conversations(talk, str(tmp_path / "j"))
    assert archives.read_conversations(spark, str(tmp_path / "j")).count() == 2


def test_ingest_reads_each_file_once(spark, smoke_dir, tmp_path):
    for _ in range(2):
        ingest.ingest(ingest.file_stream(spark, smoke_dir, "newspapers"), str(tmp_path / "o"), str(tmp_path / "s"), lambda d: d.select("page_id"))
    got = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "o")).count()
    assert got == spark.read.parquet(f"{smoke_dir}/newspapers.parquet").count()


def test_pretokens_beyond_the_bound_are_refused(spark):
    from quernwork.operators import tokens

    df = spark.createDataFrame([("one two three",)], "text string")
    assert tokens.train_bpe(df, "text", 300, 3).count() > 256
    with pytest.raises(ValueError):
        tokens.train_bpe(df, "text", 300, 2)
