"""Problem 6: records of evaluation splits that stand in the training split too, the same or nearly so.

Records are canonicalised to their words (runs of letters or digits, in lower case), so that case, punctuation and
white space do not count. Equal canonical texts meet by a hash of the whole and form classes; of each class only the
record of the smallest id goes on to the search for nearly equal texts, which is exact too:

* If ``SHARE`` of the longer text's N words stand in both in order, at most 2 N (1 - ``SHARE``) words of both together
  are unmatched. A training text is cut into blocks of ``k`` words one after the other; an unmatched word breaks one
  block at most, so that of its n / k blocks at least n / k minus the unmatched words stand whole in the other text.
  ``k`` is 4, and 3 for short texts, which leaves at least one block for any two lengths.
* So training blocks meet the evaluation texts' word k-grams by hash, where the places are near enough, and pairs that
  share as many blocks as they must are compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

MIN_WORDS = 8
SHARE = 0.9
EVALUATION = ("val", "test")
#: Training texts of fewer words are cut into blocks of ``SHORT_BLOCK`` words, others into blocks of ``BLOCK``.
SHORT, SHORT_BLOCK, BLOCK = 12, 3, 4
#: Lengths of evaluation texts that may pair with short training texts and with the others.
PAIR_SHORT, PAIR_OTHER = 12, 11
#: Ids that are sent to all executors, 8 bytes each and flags; more are joined by a shuffle.
MOST_SENT = 1 << 20


def canonical(text: Column) -> Column:
    """The words in lower case with single blanks between them."""
    low = F.lower(text)
    ascii_only = F.octet_length(text) == F.length(text)
    return F.trim(
        F.when(ascii_only, F.regexp_replace(low, "[^a-z0-9]+", " ")).otherwise(F.regexp_replace(low, r"[^\p{L}\p{N}]+", " "))
    )


def _split(split: Column) -> Column:
    return F.lower(F.trim(split))


def _n_words(canon: Column) -> Column:
    """0 for no words."""
    return F.octet_length(canon) - F.octet_length(F.replace(canon, F.lit(" "), F.lit(""))) + (canon != "").cast("int")


def records(shards: DataFrame) -> DataFrame:
    """(rec_id, split, source, key), in a checkpoint: records with ``MIN_WORDS`` words or more; ``key`` is their exact
    class. What is filtered stands in the checkpoint already, so that no text is canonicalised for the filter again."""
    rows = cut(
        shards.filter(F.col("rec_id").isNotNull() & F.col("text").isNotNull())
        .select("rec_id", _split(F.col("split")).alias("split"), "source", canonical(F.col("text")).alias("canon"))
        .select("rec_id", "split", "source", F.unhex(F.md5("canon")).alias("key"), _n_words(F.col("canon")).alias("n"))
    )
    return rows.filter(F.col("n") >= MIN_WORDS).drop("n")


def lcs_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, a column of the table in one integer's bits."""
    if a == b:
        return len(a)
    where: dict[str, int] = {}
    for i, word in enumerate(a):
        where[word] = where.get(word, 0) | 1 << i
    mask = (1 << len(a)) - 1
    row = mask
    for word in b:
        hit = row & where.get(word, 0)
        row = ((row + hit) | (row - hit)) & mask
    return len(a) - row.bit_count()


def _near(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in batches:
        out = []
        for x, y in zip(left, right):
            a, b = x.split(" "), y.split(" ")
            out.append(lcs_length(a, b) >= SHARE * max(len(a), len(b)) - 1e-9)
        yield pd.Series(out, dtype=bool)


def _repeated(rows: DataFrame) -> DataFrame:
    """(rec_id, keep, in_eval, in_train) of the records that share their class or, with different texts, their id:
    whether the record goes on for its class, and the splits that the class stands in. Others are what they are."""
    in_eval, in_train = F.col("split").isin(*EVALUATION), F.col("split") == "train"
    one = rows.groupBy("key", "rec_id").agg(
        F.count("*").alias("n"), F.bool_or(in_eval).alias("in_eval"), F.bool_or(in_train).alias("in_train")
    )
    classes = one.groupBy("key").agg(
        F.min("rec_id").alias("first"), F.sum("n").alias("n"),
        F.bool_or("in_eval").alias("in_eval"), F.bool_or("in_train").alias("in_train"),
    ).filter("n > 1")
    shared = one.select("key", "rec_id").join(classes, "key").groupBy("rec_id").agg(
        F.count("*").alias("of_shared"), F.bool_or(F.col("rec_id") == F.col("first")).alias("first"),
        F.bool_or("in_eval").alias("in_eval"), F.bool_or("in_train").alias("in_train"),
    )
    several = one.groupBy("rec_id").agg(F.count("*").alias("texts")).filter("texts > 1")
    return shared.join(several, "rec_id", "full").select(
        "rec_id", (F.coalesce("first", F.lit(True)) | F.col("texts").isNotNull()).alias("keep"),
        (F.coalesce("in_eval", F.lit(True)) | F.col("texts").isNotNull()).alias("in_eval"),
        (F.coalesce("in_train", F.lit(True)) | F.col("texts").isNotNull()).alias("in_train"),
    )


def _sent(small: DataFrame) -> DataFrame:
    """``small``, which stands in a checkpoint, to be sent to all executors if it is small indeed."""
    return F.broadcast(small) if small.count() <= MOST_SENT else small


def _word_hashes(texts: DataFrame) -> DataFrame:
    """(id, n, words): number and hashes of the words."""
    words = texts.select(F.col("rec_id").alias("id"), F.split(canonical(F.col("text")), " ").alias("w"))
    return words.select("id", F.size("w").alias("n"), F.transform("w", lambda w: F.xxhash64(w)).alias("words"))


def _gram(i: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get("words", i + j) for j in range(k)])


def _blocks(texts: DataFrame) -> DataFrame:
    """(gram, id_2, n_2, at_2): blocks of training texts and where they begin."""
    def cut_up(k: int) -> Column:
        starts = F.sequence(F.lit(0), F.floor(F.col("n") / k).cast("int") * k - k, F.lit(k))
        return F.transform(starts, lambda i: F.struct(_gram(i, k).alias("gram"), i.alias("at")))

    blocks = F.when(F.col("n") >= SHORT, cut_up(BLOCK)).when(F.col("n") >= MIN_WORDS, cut_up(SHORT_BLOCK))
    return texts.select("id", "n", F.explode(blocks).alias("b")).select(
        "b.gram", F.col("id").alias("id_2"), F.col("n").alias("n_2"), F.col("b.at").alias("at_2")
    )


def _grams(texts: DataFrame) -> DataFrame:
    """(gram, id, n, lo, hi): different word k-grams of evaluation texts, with their outermost places."""
    def spelled(k: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col("n") - k), lambda i: F.struct(_gram(i, k).alias("gram"), i.alias("at")))

    none = F.array().cast("array<struct<gram:bigint,at:int>>")
    all_ = F.sort_array(
        F.concat(
            F.when(F.col("n") >= PAIR_OTHER, spelled(BLOCK)).otherwise(none),
            F.when(F.col("n").between(MIN_WORDS, PAIR_SHORT), spelled(SHORT_BLOCK)).otherwise(none),
        )
    )
    rows = texts.select("id", "n", all_.alias("all"))
    gram_at = lambda i: F.get("all", i)["gram"]
    firsts = F.filter("all", lambda x, i: ~x["gram"].eqNullSafe(gram_at(i - 1)))
    lasts = F.filter("all", lambda x, i: ~x["gram"].eqNullSafe(gram_at(i + 1)))
    each = F.zip_with(firsts, lasts, lambda a, b: F.struct(a["gram"].alias("gram"), a["at"].alias("lo"), b["at"].alias("hi")))
    return rows.select("id", "n", F.explode(each).alias("g")).select("g.gram", "id", "n", "g.lo", "g.hi")


def _least_shared(n: Column, n_2: Column) -> Column:
    """How many whole blocks of the training text of ``n_2`` words must stand in the other of ``n`` words."""
    unmatched = n + n_2 - 2 * F.ceil(F.greatest(n, n_2) * SHARE - 1e-9)
    return F.floor(n_2 / F.when(n_2 < SHORT, SHORT_BLOCK).otherwise(BLOCK)) - unmatched


def near_candidates(ev: DataFrame, tr: DataFrame) -> DataFrame:
    """(id, id_2): texts of near lengths, 1 of evaluation and 2 of training, that share as many blocks as they must.
    ``ev`` and ``tr`` are (rec_id, text). A hash that many texts have is split by the engine's skew join, as both
    sides come straight from a shuffle."""
    longer, shorter = F.greatest("n", "n_2"), F.least("n", "n_2")
    slack = longer - F.ceil(longer * SHARE - 1e-9)
    return (
        _grams(_word_hashes(ev)).join(_blocks(_word_hashes(tr)), "gram")
        .filter(
            (F.col("id") != F.col("id_2"))
            & (shorter >= longer * SHARE - 1e-9)
            & (F.col("at_2") >= F.col("lo") - slack)
            & (F.col("at_2") <= F.col("hi") + slack)
        )
        .groupBy("id", "id_2").agg(F.count("*").alias("shared"), F.max("n").alias("n"), F.max("n_2").alias("n_2"))
        .filter(F.col("shared") >= _least_shared(F.col("n"), F.col("n_2")))
        .select("id", "id_2")
    )


def near_classes(shards: DataFrame, rows: DataFrame) -> DataFrame:
    """(key_1, key_2): classes of different canonical texts that nearly agree, 1 from evaluation and 2 from training.
    ``rows`` are the records in a checkpoint. Texts are moved only where they are compared."""
    texts = shards.select("rec_id", _split(F.col("split")).alias("split"), "text").filter("rec_id is not null and text is not null")
    known = texts.join(_sent(cut(_repeated(rows))), "rec_id", "left").filter(F.coalesce("keep", F.lit(True)))
    ev = known.filter(F.coalesce("in_eval", F.col("split").isin(*EVALUATION))).select("rec_id", "text")
    tr = known.filter(F.coalesce("in_train", F.col("split") == "train")).select("rec_id", "text")
    pairs = cut(near_candidates(ev, tr))
    met = cut(pairs.select(F.col("id").alias("rec_id")).union(pairs.select("id_2")).distinct())
    compared = texts.join(_sent(met), "rec_id", "left_semi").select("rec_id", canonical(F.col("text")).alias("canon"))
    side = lambda i: compared.select(
        F.col("rec_id").alias("id" if i == 1 else "id_2"), F.unhex(F.md5("canon")).alias(f"key_{i}"), F.col("canon").alias(f"canon_{i}")
    )
    both = pairs.join(side(1), "id").join(side(2), "id_2").filter("key_1 <> key_2")
    return both.filter(F.pandas_udf(_near, "boolean")("canon_1", "canon_2")).select("key_1", "key_2").distinct()


def overlaps(shards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records (without their words) and the matching classes (key_1 of evaluation, key_2 of training, exact)."""
    rows = records(shards)
    same = (
        rows.groupBy("key")
        .agg(F.bool_or(F.col("split").isin(*EVALUATION)).alias("in_eval"), F.bool_or(F.col("split") == "train").alias("in_train"))
        .filter("in_eval and in_train")
        .select(F.col("key").alias("key_1"), F.col("key").alias("key_2"), F.lit(True).alias("exact"))
    )
    near = near_classes(shards, rows).withColumn("exact", F.lit(False))
    return rows, cut(same.unionByName(near))


def overlap_pairs(shards: DataFrame) -> DataFrame:
    """(rec_id_1, rec_id_2), smaller first: a record of train and one of val or test that agree or nearly agree.

    Null and blank texts and texts of fewer than ``MIN_WORDS`` words have no pairs, nor have records without an id or
    of other splits; repeated rows count once.
    """
    rows, classes = overlaps(shards)
    left = rows.filter(F.col("split").isin(*EVALUATION)).select(F.col("key").alias("key_1"), F.col("rec_id").alias("a"))
    right = rows.filter(F.col("split") == "train").select(F.col("key").alias("key_2"), F.col("rec_id").alias("b"))
    pairs = classes.join(left, "key_1").join(right, "key_2").filter("a <> b")
    return pairs.select(F.least("a", "b").alias("rec_id_1"), F.greatest("a", "b").alias("rec_id_2")).distinct()


def overlap_members(shards: DataFrame) -> DataFrame:
    """(rec_id, split, class_id, n_links): each record that overlaps with one across the splits, the class of equal
    texts that it belongs to, and with how many records across the splits it overlaps. Classes stand for their records,
    so that no pairs of copies are written; records repeated as a whole count once."""
    rows, classes = overlaps(shards)
    evaluated = F.col("split").isin(*EVALUATION)
    told = rows.filter(evaluated | (F.col("split") == "train")).select("rec_id", "split", "key", evaluated.alias("evaluated")).distinct()
    sizes = told.groupBy("key", "evaluated").agg(F.count_distinct("rec_id").alias("n"))
    size = lambda flag, key: sizes.filter(F.col("evaluated") == flag).select(F.col("key").alias(key), "n")
    pairs = classes.select("key_1", "key_2").distinct()
    of_eval = pairs.join(size(False, "key_2"), "key_2").groupBy(F.col("key_1").alias("key")).agg(F.sum("n").alias("n_links"))
    of_train = pairs.join(size(True, "key_1"), "key_1").groupBy(F.col("key_2").alias("key")).agg(F.sum("n").alias("n_links"))
    links = of_eval.withColumn("evaluated", F.lit(True)).unionByName(of_train.withColumn("evaluated", F.lit(False)))
    return told.join(links, ["key", "evaluated"]).select("rec_id", "split", F.lower(F.hex("key")).alias("class_id"), "n_links")


def overlap_report(shards: DataFrame) -> DataFrame:
    """Per evaluation split and source: n_records, n_exact, n_near (nearly the same and not exact), share_overlapping.

    ``n_records`` counts all rows of the split and source, those without words too.
    """
    rows, classes = overlaps(shards)
    per_key = classes.groupBy(F.col("key_1").alias("key")).agg(F.bool_or("exact").alias("exact"))
    hits = (
        rows.filter(F.col("split").isin(*EVALUATION)).join(per_key, "key").groupBy("split", "source")
        .agg(F.count_if("exact").alias("n_exact"), F.count_if(~F.col("exact")).alias("n_near"))
        .withColumn("n_records", F.lit(0).cast("bigint"))
    )
    all_ = (
        shards.select(F.lower(F.trim("split")).alias("split"), "source").filter(F.col("split").isin(*EVALUATION))
        .groupBy("split", "source").agg(F.count("*").alias("n_records"))
        .withColumns({"n_exact": F.lit(0).cast("bigint"), "n_near": F.lit(0).cast("bigint")})
    )
    total = (
        all_.unionByName(hits)
        .groupBy("split", "source")
        .agg(*[F.sum(c).alias(c) for c in ("n_records", "n_exact", "n_near")])
    )
    return total.withColumn("share_overlapping", (F.col("n_exact") + F.col("n_near")) / F.col("n_records"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_pairs(table(spark, sf_dir, "shards"))


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_report(table(spark, sf_dir, "shards"))


def p6_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_members(table(spark, sf_dir, "shards"))


QUERIES = {"p6_found": p6_found, "p6_members": p6_members, "p6_report": p6_report}
ORACLES: dict[str, str] = {}
