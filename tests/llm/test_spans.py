import random
import time

import numpy as np

from quernwork.llm import p9_spans
from quernwork.llm.fmindex import CONTEXT, FMIndex

DOCUMENT = "doc_id bigint, text string, key string, id int"


def longest(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0] * (len(b) + 1)
        for j, y in enumerate(b):
            if x == y:
                new[j + 1] = row[j] + 1
                best = max(best, new[j + 1])
        row = new
    return best


def make(seed, n=24):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    shared = [word(rng.choice([199, 200, 201, 260, 420])) for _ in range(5)]
    docs = []
    for i in range(n):
        parts = [word(rng.randint(0, 150))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(shared), word(rng.randint(0, 60))]
        docs.append("".join(parts))
    return docs + [docs[0], "x" * 500, "x" * 450, "ab" * 160, "ba" * 160, None, "", "é" * 199]


def test_interval_sizes_are_occurrences():
    rng = np.random.default_rng(1)
    codes = np.concatenate([[0], rng.integers(1, 5, 3000), [0]])
    index = FMIndex(codes, 4, np.zeros(len(codes), np.int64))
    text = "".join(map(chr, codes))
    for size in (1, 3, 9):
        starts = rng.integers(1, 2900, 40)
        low, high = np.zeros(40, np.int64), np.full(40, len(codes), np.int64)
        for step in range(1, size + 1):
            low, high = index.extend(codes[starts + size - step], low, high)
        for s, a, b in zip(starts, low, high):
            pattern = text[s : s + size]
            assert b - a == sum(text.startswith(pattern, i) for i in range(len(text)))
    assert CONTEXT > p9_spans.NEEDED


def test_pairs_are_those_of_brute_force(spark):
    for seed in (1, 2):
        docs = make(seed)
        frame = spark.createDataFrame([(i, t, "k", 0) for i, t in enumerate(docs)] + [(0, docs[0], "k", 1)], DOCUMENT)
        got = {(r[0], r[1]) for r in p9_spans.document_pairs(frame).collect()}
        want = {
            (i, j)
            for i in range(len(docs))
            for j in range(i)
            if docs[i] and docs[j] and longest(docs[i], docs[j]) >= p9_spans.MIN_SPAN
        }
        assert got == {(j, i) for i, j in want}


def test_large_meetings_lose_nothing(spark):
    docs = make(3)
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id bigint, text string")
    long_ = p9_spans._long(frame)
    copies = p9_spans._copies(long_)

    def result(size):
        rows = p9_spans.shared_windows(long_, copies, size).collect()
        sets, signs = {}, set()
        for r in rows:
            if r.share is None:
                signs |= {(r.id, i) for i in range(r.lo, r.hi)}
            else:
                sets.setdefault(r.share, set()).add(r.id)
        return {(a, b) for s in sets.values() for a in s for b in s if a < b}, signs

    whole = result(1 << 20)
    assert whole == result(2000) == result(300) and whole[0]


def test_runs_of_one_sign_take_time_by_their_length():
    texts = ["a" * 200_000, "a" * 200_000, "b" + "a" * 250]
    began = time.time()
    doc, lo, hi, _, member = p9_spans.common_windows(np.array([7, 8, 9]), np.zeros(3, np.int64), texts)
    assert sorted(zip(doc, lo, hi)) == [(7, 0, 200_000), (8, 0, 200_000), (9, 1, 251)] and set(member) == {7, 8, 9}
    assert len(p9_spans.anchors(texts)[0]) < 20 and time.time() - began < 20


def test_shared_characters(spark):
    a, b = make(5)[0] + "q" * 5, "0123456789" * 30
    docs = [b + a[:50], "zz" + b, "none", None]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in p9_spans.shared_share(frame).collect()}
    assert got[0].n_shared == 300 and got[1].n_shared == 300 and got[2].n_shared == 0 and got[3].n_chars is None


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert p9_spans.document_pairs(frame).count() == 0 and p9_spans.shared_share(frame).count() == 0
