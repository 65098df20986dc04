"""Problem 9: stretches that stand verbatim in more than one document.

1. Of the exact copies of a text (by a digest) only the one of the smallest id goes on.
2. In every window of ``MIN_SPAN`` characters the k-gram of smallest hash is an anchor, so that two texts with such a
   stretch in common have an anchor in common. Texts with a common anchor meet under the smallest id among them, each
   with the stretch around its anchors; anchors of one text alone end here. Nothing is lost by this: any common stretch
   of ``MIN_SPAN`` lies whole within both stretches.
3. The stretches form shards of bounded size. Each shard is an FM-index over a wavelet matrix; the shard's stretches
   stream through it by backward search from every ``GRID``-th end. The matching statistic at such an end (how long a
   suffix of it also stands in another document) must reach ``NEEDED`` for any common stretch that holds the end.
4. The intervals above that threshold give the windows of ``MIN_SPAN`` characters that may be common. Equal windows are
   grouped by the ranks of the index, so that work and results grow with the stretches and never with the pairs of
   their places: what comes out are the stretches of each document and the sets of documents that share a window.

A meeting of more text than a shard holds is divided by its anchors, which every common window has exactly alike. The
rare anchor whose own surroundings are more than a shard holds (thousands of documents with the same 100 characters)
is divided further, by the hash of each window, so that no task ever holds more than a shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import cut, table
from .fmindex import CONTEXT, FMIndex

MIN_SPAN = 200
GRID = 100
GRAM = MIN_SPAN // 2
WINDOW = MIN_SPAN - GRAM + 1
NEEDED = MIN_SPAN - GRID + 1
#: Characters of text indexed in one shard, and of text handled at once when anchors are taken.
SHARD_CHARS = 1 << 20
CHUNK_CHARS = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_2 = 0xC2B2AE3D27D4EB4F | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` over x[i : i + width] for each i with a whole window."""
    have = 1
    while have * 2 <= width:
        x = best(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return best(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, position, hash) of the anchors of texts that are ``MIN_SPAN`` long or longer."""
    sizes = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    n = len(codes)
    if n < MIN_SPAN:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * _powers(_BASE, n), out=sums[1:])
    grams = (sums[GRAM:] - sums[:-GRAM]) * _powers(_INVERSE, n - GRAM + 1)
    grams ^= grams >> np.uint64(31)
    grams *= np.uint64(0xD6E8FEB86659FD93)
    grams ^= grams >> np.uint64(32)
    stops = np.cumsum(sizes)
    room = np.repeat(stops, sizes)[: n - MIN_SPAN + 1] - np.arange(n - MIN_SPAN + 1)
    least = _sliding(grams, WINDOW, np.minimum)
    least = np.where(room >= MIN_SPAN, least, np.uint64(0))
    edge = np.zeros(WINDOW - 1, np.uint64)
    most = _sliding(np.concatenate([edge, least, edge]), WINDOW, np.maximum)
    at = np.flatnonzero((grams == most) & (most > 0))
    number = np.searchsorted(stops, at, side="right")
    # of an anchor that comes again place by place, as in a run of one sign, the first and the last tell all
    same = (grams[at[1:]] == grams[at[:-1]]) & (number[1:] == number[:-1])
    outer = ~(np.append(False, same) & np.append(same, False))
    at, number = at[outer], number[outer]
    return number, at - (stops - sizes)[number], grams[at]


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, texts = batch.column(0), batch.column(1).to_pylist()
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop]) <= CHUNK_CHARS):
                size += len(texts[stop])
                stop += 1
            number, at, gram = anchors(texts[start:stop])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(gram.view(np.int64)),
                    keys.take(pa.array(number + start)),
                    pa.array(at.astype(np.int32)),
                ],
                names=["gram", "id", "at"],
            )
            start = stop


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """Dense codes of the texts with zeros around each, where each text begins, and the number of different signs."""
    joined = "\0".join(["", *texts, ""])
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    alphabet = np.unique(points)
    codes = np.searchsorted(alphabet, points).astype(np.int64) + 1
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes + 1) - sizes
    codes[begins - 1] = 0
    codes[-1] = 0
    return codes, begins, len(alphabet)


def _grouped(changes: np.ndarray) -> np.ndarray:
    """Numbers of the groups that begin where ``changes`` is set."""
    return np.cumsum(changes) - 1


def common_windows(owner: np.ndarray, starts: np.ndarray, texts: list[str]) -> tuple[np.ndarray, ...]:
    """What the documents of a shard have in common: (document, from, to) of the stretches, and (set, document) of the
    different sets of documents that share a window.

    ``texts`` are stretches of the documents ``owner`` that begin at ``starts`` there.
    """
    codes, begins, sigma = _codes(texts)
    names, number = np.unique(owner, return_inverse=True)
    row_of = np.repeat(np.arange(-1, len(texts)), np.diff(np.concatenate([[0], begins, [len(codes)]])))
    index = FMIndex(codes, sigma, np.where(row_of < 0, -1, number[np.maximum(row_of, 0)]))

    sizes = np.array([len(t) for t in texts], np.int64)
    per = np.where(sizes >= MIN_SPAN, sizes // GRID, 0)
    lane_row = np.repeat(np.arange(len(texts)), per)
    ends = (np.arange(len(lane_row)) - np.repeat(np.cumsum(per) - per, per) + 1) * GRID
    keep = ends >= NEEDED
    lane_row, ends = lane_row[keep], ends[keep]
    at, mine = begins[lane_row] + ends, number[lane_row]
    low, high = np.zeros(len(at), np.int64), np.full(len(at), len(codes), np.int64)
    for step in range(1, NEEDED + 1):
        low, high = index.extend(codes[at - step], low, high)
        alive = ~index.alone(mine, low, high)
        if not alive.all():
            lane_row, ends, at, mine, low, high = (x[alive] for x in (lane_row, ends, at, mine, low, high))

    # windows that hold the end and the NEEDED characters before it
    first = (ends[:, None] + np.arange(-MIN_SPAN, GRID - MIN_SPAN)[None, :]).ravel()
    row = np.repeat(lane_row, GRID)
    whole = (first >= 0) & (first + MIN_SPAN <= sizes[row])
    first, row = first[whole], row[whole]
    place = begins[row] + first
    head, tail, doc = index.rank[place], index.rank[place + MIN_SPAN - CONTEXT], number[row]
    order = np.lexsort((doc, tail, head))
    head, tail, doc, row, first = (x[order] for x in (head, tail, doc, row, first))
    new = np.ones(len(head), bool)
    new[1:] = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
    group = _grouped(new)
    new_doc = new.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    docs_in = np.bincount(group[new_doc], minlength=group[-1] + 1 if len(group) else 0)
    common = docs_in[group] > 1

    lo, by = starts[row[common]] + first[common], doc[common]
    order = np.lexsort((lo, by))
    lo, by = lo[order], by[order]
    begin = np.ones(len(lo), bool)
    begin[1:] = (by[1:] != by[:-1]) | (lo[1:] > lo[:-1] + MIN_SPAN)
    end = np.append(begin[1:], True)[: len(lo)]
    spans = names[by[begin]], lo[begin], lo[end] + MIN_SPAN

    member = common & new_doc
    group, doc = group[member], doc[member]
    marks = np.random.default_rng(len(names)).integers(1, 1 << 62, (2, len(names)))
    edge = np.flatnonzero(np.append(True, group[1:] != group[:-1])[: len(group)])
    if not len(edge):
        return (*spans, group, names[doc])
    sums = [np.add.reduceat(m[doc], edge) for m in marks]
    sets = np.unique(np.stack([*sums, np.diff(np.append(edge, len(group)))]), axis=1, return_index=True)[1]
    chosen = np.zeros(group[-1] + 1, bool)
    chosen[group[edge[sets]]] = True
    return (*spans, group[chosen[group]], names[doc[chosen[group]]])


#: Rows of stretches (``share`` null: id, lo, hi) and of sets of documents (share, id).
_FOUND = "share string, id bigint, lo bigint, hi bigint"
#: Ids and stretches that are sent to all executors, about 40 bytes each; more are joined by a shuffle.
MOST_SENT = 1 << 20


def _shard(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
    rows = shard.drop_duplicates(["id", "start", "piece"])
    doc, lo, hi, group, member = common_windows(
        rows["id"].to_numpy(np.int64), rows["start"].to_numpy(np.int64), rows["piece"].tolist()
    )
    none = np.full(len(member), -1)
    return pd.DataFrame(
        {
            "share": [None] * len(doc) + [f"{key[0]}:{g}" for g in group],
            "id": np.concatenate([doc, member]), "lo": np.concatenate([lo, none]), "hi": np.concatenate([hi, none]),
        }
    )


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash_1, hash_2, id, lo) of all windows of the pieces."""
    names = ["hash_1", "hash_2", "id", "lo"]
    for batch in batches:
        for id_, start, piece in zip(*(batch.column(i).to_pylist() for i in range(3))):
            for at in range(0, len(piece) - MIN_SPAN + 1, CHUNK_CHARS):
                text = piece[at : at + CHUNK_CHARS + MIN_SPAN - 1]
                codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
                hashes = [_window_hashes(codes, base) for base in (_BASE, _BASE_2)]
                n = len(hashes[0])
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(h.view(np.int64)) for h in hashes), pa.array(np.full(n, id_, np.int64)), pa.array(np.arange(n) + start + at)],
                    names=names,
                )


def _window_hashes(codes: np.ndarray, base: int) -> np.ndarray:
    n = len(codes)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * _powers(base, n), out=sums[1:])
    return (sums[MIN_SPAN:] - sums[:-MIN_SPAN]) * _powers(pow(base, -1, 1 << 64), n - MIN_SPAN + 1)


def _by_windows(pieces: DataFrame) -> DataFrame:
    """As a shard's result, of pieces that no shard holds: equal windows meet by two hashes of 64 bits."""
    key = ["hash_1", "hash_2"]
    windows = cut(pieces.select("id", "start", "piece").mapInArrow(_window_batches, "hash_1 bigint, hash_2 bigint, id bigint, lo bigint"))
    groups = windows.groupBy(*key).agg(
        F.min("id").alias("least"), F.max("id").alias("most"),
        F.sum(F.xxhash64("id").cast("decimal(20)")).alias("mark"), F.count("*").alias("n"),
    ).filter("least < most")
    spans = windows.join(groups.select(*key), key).select(
        F.lit(None).cast("string").alias("share"), "id", "lo", (F.col("lo") + MIN_SPAN).alias("hi")
    )
    sets = groups.groupBy("least", "most", "mark", "n").agg(F.min(F.struct(*key)).alias("k")).select("k.*")
    share = F.concat(F.hex("hash_1"), F.hex("hash_2"))
    members = windows.join(sets, key).select(share.alias("share"), "id", F.lit(-1).cast("bigint").alias("lo"), F.lit(-1).cast("bigint").alias("hi"))
    return spans.unionByName(members.distinct())


def _long(documents: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents that are long enough; rows without an id take no part."""
    return documents.select("doc_id", "text").filter(
        F.col("doc_id").isNotNull() & (F.length("text") >= MIN_SPAN)
    )


def _copies(long_: DataFrame) -> DataFrame:
    """(first, doc_id): documents whose text also stands in one of a smaller id, with the smallest such id."""
    rows = long_.select(F.unhex(F.md5("text")).alias("key"), "doc_id").distinct()
    first = rows.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    return cut(rows.join(first, "key").filter("doc_id <> first").select("first", "doc_id"))


def _stretches(met: DataFrame, key: str) -> DataFrame:
    """(key, id, start, stop): the stretch of a text around its anchors of one key."""
    return met.groupBy(key, "id").agg(
        F.greatest(F.min("at") - (WINDOW - 1), F.lit(0)).cast("bigint").alias("start"),
        (F.max("at") + MIN_SPAN).cast("bigint").alias("stop"),
    )


def _sized(stretches: DataFrame, key: str) -> DataFrame:
    """``stretches`` with the characters of their key, which are summed before they are joined."""
    return stretches.join(stretches.groupBy(key).agg(F.sum(F.col("stop") - F.col("start")).alias("chars")), key)


def shared_windows(long_: DataFrame, copies: DataFrame, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """What different texts have in common, as rows of ``_FOUND``; a text goes by its smallest id."""
    few = copies.count() <= MOST_SENT
    others = copies.select("doc_id")
    texts = long_.join(F.broadcast(others) if few else others, "doc_id", "left_anti")
    found = (
        texts.select("doc_id", "text").mapInArrow(_anchor_batches, "gram bigint, id bigint, at int").repartition("gram")
    )
    # the filter on ``last`` holds always; with it both uses of ``found`` read the same columns and share one shuffle
    leads = found.groupBy("gram").agg(F.min("id").alias("lead"), F.max("id").alias("most"), F.max("at").alias("last"))
    met = cut(found.join(leads.filter("lead < most and last >= 0").select("gram", "lead"), "gram"))
    by_lead = cut(_sized(_stretches(met, "lead"), "lead"))
    large = by_lead.filter(F.col("chars") > shard_chars).select("lead").distinct()
    by_gram = cut(_sized(_stretches(met.join(large, "lead"), "gram"), "gram"))
    total = sum(df.filter(F.col("chars") <= shard_chars).agg(F.sum(F.col("stop") - F.col("start"))).first()[0] or 0 for df in (by_lead, by_gram))
    shards = max(1, -(-2 * total // shard_chars))
    numbered = lambda df, key: df.filter(F.col("chars") <= shard_chars).select(
        F.pmod(F.xxhash64(key), F.lit(shards)).alias("shard"), F.col("id").alias("doc_id"), "start", "stop"
    )
    hot = by_gram.filter(F.col("chars") > shard_chars).select(
        F.lit(-1).cast("bigint").alias("shard"), F.col("id").alias("doc_id"), "start", "stop"
    )
    wanted = cut(numbered(by_lead, "lead").unionByName(numbered(by_gram, "gram")).unionByName(hot).distinct())
    some = wanted.count() <= MOST_SENT
    pieces = long_.join(F.broadcast(wanted) if some else wanted, "doc_id").select(
        "shard", F.col("doc_id").alias("id"), "start",
        F.substring("text", (F.col("start") + 1).cast("int"), (F.col("stop") - F.col("start")).cast("int")).alias("piece"),
    )
    out = pieces.filter("shard >= 0").groupBy("shard").applyInPandas(_shard, _FOUND)
    if not hot.isEmpty():
        out = out.unionByName(_by_windows(pieces.filter("shard < 0")))
    return cut(out)


def document_pairs(documents: DataFrame) -> DataFrame:
    """(doc_id_1, doc_id_2), smaller first: pairs of documents with ``MIN_SPAN`` consecutive characters in common.

    Null, empty and shorter texts have no pairs; rows repeated with the same id count once; an empty table gives none.
    """
    long_ = _long(documents)
    copies = _copies(long_)
    sets = shared_windows(long_, copies).filter("share is not null").select("share", "id")
    one, two = sets.withColumnRenamed("id", "id_1"), sets.withColumnRenamed("id", "id_2")
    pairs = one.join(two, "share").filter("id_1 < id_2").select("id_1", "id_2").distinct()
    # what holds for a text holds for its copies; the smallest id stands for itself
    ends = pairs.select(F.col("id_1").alias("first")).union(pairs.select("id_2")).union(copies.select("first")).distinct()
    members = copies.unionByName(ends.select("first", F.col("first").alias("doc_id")))
    left = members.select(F.col("first").alias("id_1"), F.col("doc_id").alias("a"))
    right = members.select(F.col("first").alias("id_2"), F.col("doc_id").alias("b"))
    across = pairs.join(left, "id_1").join(right, "id_2").select("a", "b")
    within = left.join(right, (F.col("id_1") == F.col("id_2")) & (F.col("a") < F.col("b"))).select("a", "b")
    return (
        across.unionByName(within)
        .filter("a <> b")
        .select(F.least("a", "b").alias("doc_id_1"), F.greatest("a", "b").alias("doc_id_2"))
        .distinct()
    )


def shared_share(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, n_shared (characters that lie in a stretch that another document has too), share.

    Null texts have n_chars null and nothing shared; exact copies of ``MIN_SPAN`` or more are shared whole.
    """
    long_ = _long(documents)
    copies = _copies(long_)
    spans = shared_windows(long_, copies).filter("share is null")
    span = spans.groupBy(F.col("id").alias("doc_id"), "lo").agg(F.max("hi").alias("hi"))
    before = F.max("hi").over(W.Window.partitionBy("doc_id").orderBy("lo").rowsBetween(W.Window.unboundedPreceding, -1))
    new = F.col("hi") - F.greatest(F.col("lo"), F.coalesce(before, F.lit(0)))
    part = span.withColumn("new", F.greatest(new, F.lit(0))).groupBy("doc_id").agg(F.sum("new").alias("part"))
    whole = copies.select("doc_id").union(copies.select("first")).distinct().withColumn("whole", F.lit(True))
    rows = documents.select("doc_id", F.length("text").cast("bigint").alias("n_chars"))
    shared = F.when(F.col("n_chars") >= MIN_SPAN, F.when(F.col("whole"), F.col("n_chars")).otherwise(F.col("part")))
    return (
        rows.join(part, "doc_id", "left")
        .join(whole, "doc_id", "left")
        .select("doc_id", "n_chars", F.coalesce(shared, F.lit(0)).alias("n_shared"))
        .withColumn("share", F.coalesce(F.try_divide("n_shared", "n_chars"), F.lit(0.0)))
    )


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_pairs(table(spark, sf_dir, "documents"))


def p9_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_share(table(spark, sf_dir, "documents"))


QUERIES = {"p9_found": p9_found, "p9_shared": p9_shared}
#: All stretches of ``MIN_SPAN`` characters of all texts, and those that stand in two documents.
_SQL = f"""WITH w AS (SELECT doc_id, i, substr(text, i, {MIN_SPAN}) AS s FROM (
  SELECT doc_id, text, unnest(generate_series(1, length(text) - {MIN_SPAN - 1})) AS i FROM (SELECT DISTINCT doc_id, text FROM documents WHERE length(text) >= {MIN_SPAN}))),
m AS (SELECT s FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)), c AS (SELECT doc_id, i, s FROM w SEMI JOIN m USING (s))"""
ORACLES: dict[str, str] = {
    "p9_found": f"""{_SQL}, d AS (SELECT DISTINCT doc_id, s FROM c)
        SELECT DISTINCT a.doc_id AS doc_id_1, b.doc_id AS doc_id_2 FROM d a JOIN d b ON a.s = b.s AND a.doc_id < b.doc_id""",
    "p9_shared": f"""{_SQL}, p AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + {MIN_SPAN - 1})) AS place FROM c), n AS (SELECT doc_id, count(*) AS n FROM p GROUP BY doc_id)
        SELECT doc_id, length(text) AS n_chars, coalesce(n, 0) AS n_shared, coalesce(n / nullif(length(text), 0), 0.0)::DOUBLE AS share FROM documents LEFT JOIN n USING (doc_id)""",
}
