"""Problem 5: texts of each split into containers of fixed capacity, with little room unused.

Sizes are whole tokens, so all that packing needs of a split is how many items there are of each size: a table of at
most ``capacity`` rows however many texts there are. It is packed in one task; texts take their places by rank.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import cut, join_equal, table
from .pieces import with_token_counts

#: Ranks within one size are counted in parts of about ``PART_ROWS`` rows of all texts, ``RANK_PARTS`` at least, so that
#: a size that a third of all texts have is no one task.
RANK_PARTS, PART_ROWS = 64, 1 << 18
#: Longest run of places that one row describes before places are spelled out.
RUN_PLACES = 4096
#: The containers are a small fixed table; more rows than this are refused.
MOST_CONTAINERS = 1000


class Packing:
    """Packs ``counts`` (size -> items) into bins of ``capacity``.

    ``runs`` holds (size, first_rank, items, first_bin, per_bin, fixed): items of one size, taken in order of rank,
    ``per_bin`` to each of consecutive bins.
    """

    def __init__(self, capacity: int, counts: dict[int, int]) -> None:
        self.capacity = capacity
        self.left = {s: n for s, n in counts.items() if n > 0}
        self.sizes = sorted(self.left)
        self.rank = dict.fromkeys(self.left, 0)
        self.bins = 0
        self.runs: list[tuple[int, int, int, int, int, bool]] = []

    def _take(self, size: int, items: int, first_bin: int, per_bin: int, fixed: bool) -> None:
        self.runs.append((size, self.rank[size], items, first_bin, per_bin, fixed))
        self.rank[size] += items
        self.left[size] -= items
        if not self.left[size]:
            del self.left[size]
            self.sizes.pop(bisect_left(self.sizes, size))

    def _smallest(self, size: int, k: int) -> list[int]:
        """The ``k`` smallest items besides one of ``size``."""
        out: list[int] = []
        for s in self.sizes:
            out += [s] * min(self.left[s] - (s == size), k - len(out))
            if len(out) == k:
                break
        return out

    def _largest(self, size: int, room: int) -> int | None:
        """The largest item that fits into ``room`` besides one of ``size``."""
        i = bisect_right(self.sizes, room) - 1
        if i >= 0 and self.sizes[i] == size and self.left[size] == 1:
            i -= 1
        return self.sizes[i] if i >= 0 else None

    def _best_two(self, size: int, room: int) -> int:
        """The largest sum of two items that fit into ``room`` besides one of ``size``; 0 if no two do."""
        have = lambda s: self.left[s] - (s == size)
        best, lo, hi = 0, 0, bisect_right(self.sizes, room) - 1
        while lo <= hi:
            a, b = self.sizes[lo], self.sizes[hi]
            if not have(a):
                lo += 1
            elif not have(b) or (lo == hi and have(a) < 2) or a + b > room:
                hi -= 1
            else:
                best = max(best, a + b)
                lo += 1
        return best

    def _dominating(self, size: int) -> tuple[int | None, int] | None:
        """A set with one item of ``size`` that dominates every other such set: (partner or None, how many such sets),
        or None where none is proven."""
        room, small = self.capacity - size, self._smallest(size, 3)
        if not small or small[0] > room:
            return None, self.left[size]
        partner = self._largest(size, room)
        sure = partner == room or len(small) < 2 or small[0] + small[1] > room
        if not sure and (len(small) < 3 or sum(small) > room):
            sure = partner >= self._best_two(size, room)
            # fixing one set changes which two are best, so one at a time
            return (partner, 1) if sure else None
        times = self.left[size] // 2 if partner == size else min(self.left[size], self.left[partner])
        return (partner, times) if sure else None

    def reduce(self) -> None:
        """Fix dominating sets of at most three items, from the largest size down, until none is left to find."""
        found = True
        while found:
            found, i = False, len(self.sizes) - 1
            while i >= 0:
                size = self.sizes[i]
                if (fixed := self._dominating(size)) is not None:
                    found = True
                    partner, times = fixed
                    bin_from = self.bins
                    self.bins += times
                    if partner == size:
                        self._take(size, 2 * times, bin_from, 2, True)
                    else:
                        self._take(size, times, bin_from, 1, True)
                        if partner is not None:
                            self._take(partner, times, bin_from, 1, True)
                    i = min(i, len(self.sizes) - 1)
                    if i >= 0 and self.sizes[i] < size:
                        continue
                    i = bisect_right(self.sizes, size) - 1
                else:
                    i -= 1

    def best_fit(self) -> None:
        """Put what is left, largest first, where it leaves the least room. Bins of equal room are one entry."""
        rooms: dict[int, list[tuple[int, int]]] = {}
        keys: list[int] = []

        def put(room: int, first: int, n: int) -> None:
            if room > 0 and n > 0:
                if room not in rooms:
                    rooms[room] = []
                    insort(keys, room)
                rooms[room].append((first, n))

        while self.sizes:
            size = self.sizes[-1]
            items = self.left[size]
            at = bisect_left(keys, size)
            if at < len(keys):
                room = keys[at]
                first, n = rooms[room].pop()
            else:
                room = self.capacity
                first, n = self.bins, -(-items // (room // size))
                self.bins += n
            each = room // size
            full = min(n, items // each)
            more = items - full * each if full < n else 0
            if full:
                self._take(size, full * each, first, each, False)
                put(room - each * size, first, full)
            if more:
                self._take(size, more, first + full, more, False)
                put(room - more * size, first + full, 1)
            put(room, first + full + (more > 0), n - full - (more > 0))
            if room in rooms and not rooms[room]:
                del rooms[room]
                keys.pop(bisect_left(keys, room))


def pack_sizes(capacity: int, counts: dict[int, int]) -> Packing:
    packing = Packing(capacity, counts)
    packing.reduce()
    packing.best_fit()
    return packing


_RUNS = (
    "split string, container string, capacity int, size int, first_rank bigint, items bigint, first_bin bigint,"
    " per_bin bigint, fixed boolean"
)


def _pack_group(sizes: pd.DataFrame) -> pd.DataFrame:
    head = sizes.iloc[0]
    done = pack_sizes(int(head["capacity"]), {int(s): int(n) for s, n in zip(sizes["size"], sizes["n"])})
    rows = []
    for size, rank, items, first, per_bin, fixed in done.runs:
        step = max(per_bin, RUN_PLACES // per_bin * per_bin)
        for at in range(0, items, step):
            rows.append((size, rank + at, min(step, items - at), first + at // per_bin, per_bin, fixed))
    out = pd.DataFrame(rows, columns=["size", "first_rank", "items", "first_bin", "per_bin", "fixed"])
    out.insert(0, "capacity", int(head["capacity"]))
    out.insert(0, "container", head["container"])
    out.insert(0, "split", head["split"])
    return out


def _items(sized: DataFrame, containers: DataFrame) -> DataFrame:
    """(split, container, capacity, rec_id, part, size): a text longer than the capacity is divided into full
    containers and a rest; any other is one item."""
    rows = containers.dropna().filter("capacity > 0").dropDuplicates().limit(MOST_CONTAINERS + 1).collect()
    if len(rows) > MOST_CONTAINERS:
        raise ValueError(f"more than {MOST_CONTAINERS} containers")
    kinds = F.array(
        *[F.struct(F.lit(r.container).alias("container"), F.lit(int(r.capacity)).alias("capacity")) for r in rows]
    )
    each = sized.withColumn("c", F.explode(kinds)).select("rec_id", "split", "n_tokens", "c.*")
    last = F.greatest(F.ceil(F.col("n_tokens") / F.col("capacity")) - 1, F.lit(0)).cast("bigint")
    parts = each.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    size = F.least(F.col("capacity"), F.col("n_tokens") - F.col("part") * F.col("capacity")).cast("int")
    return parts.select("split", "container", "capacity", "rec_id", F.col("part").cast("int"), size.alias("size"))


def _ranked(items: DataFrame, keys: list[str], tie: list[Column], n_parts: int) -> DataFrame:
    """``items`` with ``rank`` from 0 within ``keys``, counted in parts by a hash and joined by the parts' sums."""
    parted = items.withColumn("_part", F.pmod(F.xxhash64(*tie), F.lit(n_parts)).cast("int"))
    sums = parted.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.Window.partitionBy(*keys).orderBy("_part")) - F.col("_n")
    sums = sums.withColumn("_before", before).drop("_n")
    inside = F.row_number().over(W.Window.partitionBy(*keys, "_part").orderBy(*tie))
    return join_equal(parted.withColumn("_in", inside), sums, [*keys, "_part"]).select(
        *items.columns, (F.col("_before") + F.col("_in") - 1).alias("rank")
    )


def _runs(items: DataFrame) -> DataFrame:
    counts = (
        items.filter("size > 0")
        .groupBy("split", "container", "capacity", "size")
        .agg(F.count("*").alias("n"))
    )
    return counts.groupBy("split", "container", "capacity").applyInPandas(_pack_group, _RUNS)


def pack(sized: DataFrame, containers: DataFrame) -> DataFrame:
    """(split, container, capacity, rec_id, part, size, bin) of every text and part of a text.

    ``sized`` is (rec_id, split, n_tokens). Bins are numbered from 0 within split and container. Texts without tokens
    (null, empty) need no room: size 0, bin null. A null split is a split of its own.
    """
    items = cut(_items(sized, containers))
    keys = ["split", "container", "capacity", "size"]
    runs = _runs(items)
    places = runs.withColumn("at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("items") - 1))).select(
        *keys,
        (F.col("first_rank") + F.col("at")).alias("rank"),
        (F.col("first_bin") + F.floor(F.col("at") / F.col("per_bin"))).alias("bin"),
    )
    n_parts = max(RANK_PARTS, items.count() // PART_ROWS)
    ranked = _ranked(items.filter("size > 0"), keys, [F.col("rec_id"), F.col("part")], n_parts)
    # the engine takes the spelled out places for no larger than the table of sizes, and would broadcast them
    placed = join_equal(ranked, places.hint("merge"), [*keys, "rank"]).select(*items.columns, "bin")
    empty = items.filter("size = 0").withColumn("bin", F.lit(None).cast("bigint"))
    return placed.unionByName(empty)


def packing_report(sized: DataFrame, containers: DataFrame) -> DataFrame:
    """Per split and container: items, tokens, bins, lower_bound (tokens / capacity, rounded up), fill, fixed_bins
    (bins that dominance fixed)."""
    runs = _runs(_items(sized, containers))
    last = F.col("first_bin") + F.ceil(F.col("items") / F.col("per_bin"))
    tokens = F.sum(F.col("size") * F.col("items"))
    return (
        runs.groupBy("split", "container", "capacity")
        .agg(
            F.sum("items").alias("items"),
            tokens.alias("tokens"),
            F.max(last).alias("bins"),
            F.max(F.when(F.col("fixed"), last)).alias("fixed_bins"),
        )
        .select(
            "split", "container", "capacity", "items", "tokens", "bins",
            F.ceil(F.col("tokens") / F.col("capacity")).alias("lower_bound"),
            (F.col("tokens") / (F.col("bins") * F.col("capacity"))).alias("fill"),
            F.coalesce("fixed_bins", F.lit(0)).alias("fixed_bins"),
        )
    )


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = table(spark, sf_dir, "shards").select("rec_id", "split", "text")
    return with_token_counts(shards).select("rec_id", "split", "n_tokens")


def p5_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_sized(spark, sf_dir), table(spark, sf_dir, "containers"))


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_report(_sized(spark, sf_dir), table(spark, sf_dir, "containers"))


QUERIES = {"p5_assignment": p5_assignment, "p5_report": p5_report}
ORACLES: dict[str, str] = {}
