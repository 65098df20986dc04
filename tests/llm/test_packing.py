import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quernwork.llm import p5_packing

SIZED = "rec_id bigint, split string, n_tokens bigint"


def spelled(packing):
    bins, places = defaultdict(int), Counter()
    for size, rank, items, first, per_bin, _ in packing.runs:
        for k in range(items):
            bins[first + k // per_bin] += size
            places[size, rank + k] += 1
    return bins, places


def best_fit_decreasing(items, capacity):
    rooms = []
    for size in sorted(items, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= size]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= size
        else:
            rooms.append(capacity - size)
    return len(rooms)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60), st.data())
def test_every_item_once_and_never_more_bins_than_best_fit(capacity, data):
    items = data.draw(st.lists(st.integers(1, capacity), max_size=60))
    packing = p5_packing.pack_sizes(capacity, dict(Counter(items)))
    bins, places = spelled(packing)
    assert places == Counter((s, k) for s, n in Counter(items).items() for k in range(n))
    assert all(v <= capacity for v in bins.values()) and sorted(bins) == list(range(packing.bins))
    assert packing.bins <= best_fit_decreasing(items, capacity)


def test_dominance_fixes_perfect_pairs_and_lone_items():
    packing = p5_packing.Packing(10, {9: 2, 6: 1, 4: 1, 3: 2})
    packing.reduce()
    assert not packing.left and packing.bins == 4


def test_optimal_on_small_instances():
    rng = random.Random(4)

    def least(items, capacity):
        best = len(items)

        def place(i, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if i == len(items):
                best = len(rooms)
                return
            for k in range(len(rooms)):
                if rooms[k] >= items[i] and rooms[k] not in rooms[:k]:
                    rooms[k] -= items[i]
                    place(i + 1, rooms)
                    rooms[k] += items[i]
            rooms.append(capacity - items[i])
            place(i + 1, rooms)
            rooms.pop()

        place(0, [])
        return best

    over = 0
    for _ in range(60):
        items = sorted((rng.randint(1, 20) for _ in range(9)), reverse=True)
        over += p5_packing.pack_sizes(20, dict(Counter(items))).bins - least(items, 20)
    assert over <= 2


def test_assignment(spark):
    rows = [(i, "train", n) for i, n in enumerate([25, 10, 7, 3, 3, 0, None and 0 or 0, 5])]
    rows += [(100 + i, None, 4) for i in range(5)] + [(7, "train", 5)]
    sized = spark.createDataFrame(rows, SIZED)
    containers = spark.createDataFrame([("c", 10), ("c", 10), ("d", 100)], "container string, capacity int")
    out = p5_packing.pack(sized, containers).collect()
    fill = defaultdict(int)
    for r in out:
        if r.size:
            fill[r.split, r.container, r.bin] += r.size
    assert all(v <= (10 if k[1] == "c" else 100) for k, v in fill.items())
    parts = sorted((r.part, r.size) for r in out if r.rec_id == 0 and r.container == "c")
    assert parts == [(0, 10), (1, 10), (2, 5)]
    assert sum(r.size for r in out if r.container == "d") == sum(n for _, _, n in rows)
    assert all((r.bin is None) == (r.size == 0) for r in out)
    report = {(r.split, r.container): r for r in p5_packing.packing_report(sized, containers).collect()}
    for (split, container), r in report.items():
        assert r.bins == len({k for k in fill if k[:2] == (split, container)}) >= r.lower_bound


def test_a_size_that_all_share_is_ranked_once_each(spark):
    sized = spark.createDataFrame([(i, "train", 4) for i in range(300)], SIZED)
    containers = spark.createDataFrame([("c", 10)], "container string, capacity int")
    out = p5_packing.pack(sized, containers).collect()
    assert len(out) == 300 and set(Counter(r.bin for r in out).values()) == {2}


def test_places_are_never_broadcast(spark):
    sized = spark.range(5000).selectExpr("id as rec_id", "'train' as split", "id % 5 + 1 as n_tokens")
    containers = spark.createDataFrame([("c", 10)], "container string, capacity int")
    out = p5_packing.pack(sized, containers)
    assert len(out.collect()) == 5000
    ran = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    joined = [line for line in ran.splitlines() if "Join" in line and "rank" in line]
    assert joined and all("SortMergeJoin" in line for line in joined)


@pytest.mark.parametrize("column", ["rec_id", "split"])
def test_empty_table(spark, column):
    sized = spark.createDataFrame([], SIZED)
    containers = spark.createDataFrame([("c", 10)], "container string, capacity int")
    assert column in p5_packing.pack(sized, containers).columns
    assert p5_packing.pack(sized, containers).count() == 0
