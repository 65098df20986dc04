"""Byte-level BPE over the distinct pieces of a corpus.

A text is cut into pieces by the vocabulary's public pattern; merges never cross pieces, so the tokens of a text
are the tokens of its pieces in order. A first scan counts the distinct pieces (map-side combined); the most frequent
ones (``HOT_PIECES`` at most, each of ``HOT_BYTES`` at most: a proven bound of 8 MB) are encoded once each and become a
literal bucketed map. A second scan looks the pieces of each text up in it and encodes the others where they stand. So
neither texts nor pieces are joined with anything, the plan is the same at every size, and which pieces are hot tells
only in the time.

Null texts give null piece lists, which callers turn into their defined result (no tokens).
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, vocabulary_path

RANK_FILE = "byte_bpe_50k.tiktoken"
#: White space of the Unicode property, as ranges of a Java character class.
_SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: The public pattern of the vocabulary (fixed value), its white space written out for Java.
PIECE_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
HOT_PIECES = 1 << 16
HOT_BYTES = 64
BUCKETS = 1 << 14
#: Longer pieces are merged with a queue instead of a fold, whose steps are linear in the piece.
FOLD_BYTES = 192
#: Stands for a long piece among the ids of a text.
LONG = "L"
#: Pieces whose number of tokens a worker keeps; then it starts afresh.
MOST_KEPT = 1 << 18


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file; ranks are the token ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PIECE_PATTERN), F.lit(0))


def piece_counts(df: DataFrame, text: str) -> DataFrame:
    """(piece, n): distinct pieces of all texts and their frequencies."""
    return df.select(F.explode(pieces(F.col(text))).alias("piece")).groupBy("piece").agg(F.count("*").alias("n"))


def _bucket(key: Column) -> Column:
    return F.crc32(key.cast("binary")).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def literal_table(values: dict[str, int | str], kind: str) -> Column:
    """A literal map: an array of small maps, indexed by a hash of the key."""
    buckets: list[dict] = [{} for _ in range(BUCKETS)]
    for key, value in values.items():
        buckets[zlib.crc32(key.encode()) & (BUCKETS - 1)][key] = value
    return F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,{kind}>>")


def looked_up(table: Column, key: Column) -> Column:
    """The value of a key in a literal table; null for missing keys."""
    return F.get(table, _bucket(key))[key]


def literal_map(values: dict[str, int | str], kind: str) -> Callable[[Column], Column]:
    table = literal_table(values, kind)
    return lambda key: looked_up(table, key)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that stands in the plan once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def rank_table(path: str) -> Column:
    return literal_table({token.hex(): r for token, r in ranks(path).items()}, "int")


def fold_merges(piece: Column, table: Column) -> Column:
    """Token ids of a piece: higher-order functions fold the merges of lowest rank over its bytes (in hex)."""
    rank = lambda key: looked_up(table, key)
    hexed = F.lower(F.hex(piece.cast("binary")))
    size = F.octet_length(piece)
    symbols = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.substring(hexed, i * 2 + 1, F.lit(2)))

    def step(acc: Column, _: Column) -> Column:
        def merged(pairs: Column) -> Column:
            at = F.array_position(pairs, F.array_min(pairs)).cast("int")
            joined = F.concat(F.get(acc, at - 1), F.get(acc, at))
            return F.concat(F.slice(acc, F.lit(1), at - 1), F.array(joined), F.slice(acc, at + 2, F.size(acc)))

        pairs = F.transform(
            F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
            lambda left, i: rank(F.concat(left, F.get(acc, i + 1))),
        )
        return bound(pairs, lambda p: F.when(F.array_min(p).isNull(), acc).otherwise(merged(p)))

    folded = F.aggregate(F.sequence(F.lit(1), size), symbols, step)
    return bound(rank(hexed), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(folded, rank)))


def queue_merges(data: bytes, table: dict[bytes, int]) -> list[int]:
    """Token ids of a piece: its symbols as a linked list, the merges in a queue by rank and place.

    A queue entry is valid only if both its symbols still stand as they were when it was pushed, which the lengths
    tell. Time is O(n log n) for n bytes.
    """
    n = len(data)
    if data in table:
        return [table[data]]
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    end = list(range(1, n + 1))  # symbol i is data[i:end[i]]; end 0 marks a symbol that was merged away
    queue = [(r, i, i + 2) for i in range(n - 1) if (r := table.get(data[i : i + 2])) is not None]
    heapq.heapify(queue)
    while queue:
        _, i, stop = heapq.heappop(queue)
        j = after[i] if end[i] else n
        if j >= n or end[j] != stop:
            continue
        end[i], end[j] = stop, 0
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
            if (r := table.get(data[i : end[after[j]]])) is not None:
                heapq.heappush(queue, (r, i, end[after[j]]))
        k = before[i]
        if k >= 0 and (r := table.get(data[k:stop])) is not None:
            heapq.heappush(queue, (r, k, stop))
    out, i = [], 0
    while i < n:
        out.append(table[data[i : end[i]]])
        i = after[i]
    return out


def _queue_udf(path: str) -> Callable:
    """Token ids of a piece by the queue, as text."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = ranks(path)
        for batch in batches:
            yield pd.Series([",".join(map(str, queue_merges(p.encode(), table))) for p in batch], dtype=object)

    return run


def token_count(path: str) -> Callable:
    """Column function: number of tokens of a piece by the queue."""

    @F.pandas_udf("bigint")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kept: dict[str, int] = {}
        table = ranks(path)
        for batch in batches:
            yield pd.Series([_kept_count(p, kept, table) for p in batch], dtype="int64")

    return run


def _kept_count(piece: str, kept: dict[str, int], table: dict[bytes, int]) -> int:
    if (n := kept.get(piece)) is None:
        n = len(queue_merges(piece.encode(), table))
        if len(piece) <= HOT_BYTES:
            if len(kept) >= MOST_KEPT:
                kept.clear()
            kept[piece] = n
    return n


def _rest_counts(path: str) -> Callable:
    """Number of tokens of a list of pieces; 0 for null."""

    @F.pandas_udf("bigint")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kept: dict[str, int] = {}
        table = ranks(path)
        for batch in batches:
            yield pd.Series([0 if ps is None else sum(_kept_count(p, kept, table) for p in ps) for ps in batch], dtype="int64")

    return run


def _filled_in(path: str) -> Callable:
    """Ids of a text with ``LONG`` in the place of each long piece, and those pieces -> all ids; null for null."""

    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        table = ranks(path)
        for ids, long in batches:
            out = []
            for text, ps in zip(ids, long):
                if text is None:
                    out.append(None)
                    continue
                parts = text.split(LONG)
                filled = [parts[0]]
                for p, part in zip(ps, parts[1:]):
                    filled += [",".join(map(str, queue_merges(p.encode(), table))), part]
                out.append("".join(filled))
            yield pd.Series(out, dtype=object)

    return run


def hot_values(df: DataFrame, text: str, value: Callable[[Column], Column], hot_pieces: int = HOT_PIECES) -> dict[str, str]:
    """piece -> ``value`` of the most frequent pieces, ``hot_pieces`` at most.

    Frequencies are counted over all texts. Frequency classes are taken whole, from the most frequent down, so that
    one small table of classes tells the least frequency and no rows are ranked.
    """
    counts = cut(piece_counts(df, text).filter(F.octet_length("piece") <= HOT_BYTES))
    size = F.floor(F.log2("n") * 16).cast("int")
    classes = counts.groupBy(size.alias("size")).agg(F.count("*").alias("pieces")).collect()
    least, total = None, 0
    for row in sorted(classes, key=lambda r: -r["size"]):
        total += row["pieces"]
        if total > hot_pieces:
            break
        least = row["size"]
    if least is None:
        return {}
    hot = counts.filter(size >= least)
    return {r.piece: r.value for r in hot.select("piece", value(F.col("piece")).cast("string").alias("value")).collect()}


def with_ids(
    df: DataFrame, text: str = "text", out: str = "ids", path: str | None = None, hot_pieces: int = HOT_PIECES
) -> DataFrame:
    """``df`` with the token ids of ``text``; null and empty texts give the empty list.

    Pieces that are not hot are folded in place. The steps of a fold are linear in the piece, so pieces of more than
    ``FOLD_BYTES`` are merged by the queue, which gives the same ids; only they and the ids around them go to Python.
    """
    path = path or vocabulary_path(RANK_FILE)
    table = rank_table(path)
    joined = lambda piece, t: F.array_join(fold_merges(piece, t), ",")
    lookup = literal_map(hot_values(df, text, lambda p: bound(table, lambda t: joined(p, t)), hot_pieces), "string")
    fits = lambda p: F.octet_length(p) <= FOLD_BYTES
    folded = lambda t: F.transform("_pieces", lambda p: F.coalesce(lookup(p), F.when(fits(p), joined(p, t))))
    rows = df.withColumn("_pieces", pieces(F.col(text)))
    rows = rows.withColumn("_ids", F.array_join(bound(table, folded), ",", LONG))
    lacks = F.contains("_ids", F.lit(LONG))
    rows = rows.withColumn("_long", F.when(lacks, F.filter("_pieces", lambda p: ~fits(p)))).drop("_pieces")
    rows = rows.withColumn("_full", _filled_in(path)(F.when(F.col("_long").isNotNull(), F.col("_ids")), "_long"))
    whole = F.coalesce("_full", "_ids")
    ids = F.when(F.length(whole) > 0, F.split(whole, ",").cast("array<int>"))
    return rows.withColumn(out, F.coalesce(ids, F.array().cast("array<int>"))).drop("_ids", "_long", "_full")


def with_token_counts(
    df: DataFrame, text: str = "text", out: str = "n_tokens", path: str | None = None, hot_pieces: int = HOT_PIECES
) -> DataFrame:
    """``df`` with the number of tokens of ``text`` (BIGINT); null and empty texts have none. Pieces that are not hot
    are counted in place by the queue; only they go to Python."""
    path = path or vocabulary_path(RANK_FILE)
    lookup = literal_map({p: int(n) for p, n in hot_values(df, text, token_count(path), hot_pieces).items()}, "int")
    rows = df.withColumn("_pieces", pieces(F.col(text))).withColumn("_values", F.transform("_pieces", lookup))
    lacks = F.exists("_values", lambda v: v.isNull())
    rest = F.when(lacks, F.filter("_pieces", lambda p, i: F.get("_values", i).isNull()))
    known = F.aggregate("_values", F.lit(0).cast("bigint"), lambda a, v: a + F.coalesce(v, F.lit(0)))
    rows = rows.withColumns({"_rest": rest, "_known": F.coalesce(known, F.lit(0))}).drop("_pieces", "_values")
    return rows.withColumn(out, F.col("_known") + _rest_counts(path)("_rest")).drop("_rest", "_known")


def decode(ids: Column, path: str | None = None) -> Column:
    """The text of token ids: their byte pieces concatenated; null for null, U+FFFD for bytes that are no UTF-8."""
    path = path or vocabulary_path(RANK_FILE)
    by_id = sorted(ranks(path).items(), key=lambda x: x[1])
    literal = F.from_json(F.lit(json.dumps([token.hex() for token, _ in by_id])), "array<string>")
    return F.make_valid_utf8(F.unhex(F.array_join(F.transform(ids, lambda i: F.get(literal, i)), "")).cast("string"))
