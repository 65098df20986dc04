import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from quernwork.llm import p6_overlap

SHARD = "rec_id bigint, split string, source string, text string, key string, id int"


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=20), st.lists(st.sampled_from("abc"), max_size=20))
def test_lcs(a, b):
    assert p6_overlap.lcs_length(a, b) == slow_lcs(a, b)


def make(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([8, 9, 10, 11, 20, 39, 41, 45, 120]))]
        texts.append(base)
        for _ in range(2):
            other = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 8))):
                at = rng.randrange(len(other))
                kind = rng.random()
                if kind < 0.4:
                    other[at] = rng.choice(words)
                elif kind < 0.7 and len(other) > 1:
                    del other[at]
                else:
                    other.insert(at, rng.choice(words))
            texts.append(other)
    rows = []
    for i, t in enumerate(texts):
        shown = " ".join(w.upper() if rng.random() < 0.2 else w for w in t) + rng.choice(["", ".", " !"])
        rows.append((i, rng.choice(["train", "train", "val", "test"]), "s", shown, "k", 0))
    rows += [(900, "val", None, None, "k", 0), (901, "val", "s", " ", "k", 0), (902, None, "s", rows[0][3], "k", 0), rows[0], rows[1]]
    return rows


def test_pairs_are_those_of_brute_force(spark):
    for seed in (1, 2):
        rows = make(seed)
        got = {(r[0], r[1]) for r in p6_overlap.overlap_pairs(spark.createDataFrame(rows, SHARD)).collect()}
        cut = {i: (s, re.findall(r"[^\W_]+", (t or "").lower())) for i, s, _, t, _, _ in rows}
        want = set()
        for i, (s, a) in cut.items():
            for j, (u, b) in cut.items():
                if s == "train" and u in ("val", "test") and min(len(a), len(b)) >= 8:
                    if slow_lcs(a, b) >= 0.9 * max(len(a), len(b)) - 1e-9:
                        want.add((min(i, j), max(i, j)))
        assert got == want


def test_report_counts_all_rows(spark):
    rows = make(3)
    report = p6_overlap.overlap_report(spark.createDataFrame(rows, SHARD)).collect()
    assert sum(r.n_records for r in report) == sum(r[1] in ("val", "test") for r in rows)
    assert all(r.n_exact + r.n_near <= r.n_records for r in report)


def test_empty_table(spark):
    frame = spark.createDataFrame([], SHARD)
    assert p6_overlap.overlap_pairs(frame).count() == 0 and p6_overlap.overlap_report(frame).count() == 0


def test_some_block_stays_whole_at_any_two_lengths():
    for n_2 in range(p6_overlap.MIN_WORDS, 600):
        k = p6_overlap.SHORT_BLOCK if n_2 < p6_overlap.SHORT else p6_overlap.BLOCK
        for n in range(p6_overlap.MIN_WORDS, 700):
            kept = -(-9 * max(n, n_2) // 10)
            if kept <= min(n, n_2):
                assert n_2 // k - (n + n_2 - 2 * kept) >= 1
                assert n <= p6_overlap.PAIR_SHORT if k == p6_overlap.SHORT_BLOCK else n >= p6_overlap.PAIR_OTHER


def test_members_have_as_many_links_as_pairs(spark):
    frame = spark.createDataFrame(make(1), SHARD)
    links = {}
    for a, b in p6_overlap.overlap_pairs(frame).collect():
        links[a], links[b] = links.get(a, 0) + 1, links.get(b, 0) + 1
    rows = p6_overlap.overlap_members(frame).collect()
    assert {r.rec_id: r.n_links for r in rows} == links and len(rows) == len(links)
