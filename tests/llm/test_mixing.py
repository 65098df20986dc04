from collections import defaultdict

import pytest

from quernwork.llm import p8_mixing

SIZED = "doc_id bigint, source string, language string, domain string, n_tokens bigint"
TARGETS = "source string, target_share double, max_repeats int"


def test_shortage_goes_to_siblings():
    assert p8_mixing.fill(10, [1, 1], [2, 100]) == [2, 8]
    assert p8_mixing.fill(10, [1, 1], [2, 3]) == [2, 3]
    assert sum(p8_mixing.fill(9, [1, 2, 3], [100, 100, 100])) == pytest.approx(9)


def test_leaves_sum_to_targets_and_keep_caps():
    available = {("a", "en", "x"): 100, ("a", "en", None): 5, ("a", "fr", "x"): 20, ("b", "en", "x"): 50, ("z", "en", "x"): 9}
    targets = {"a": (0.6, 2), "b": (0.4, 1)}
    plan = p8_mixing.plan_leaves(available, targets)
    by_source = defaultdict(int)
    for leaf, n in plan.items():
        by_source[leaf[0]] += n
        assert n <= available[leaf] * targets[leaf[0]][1]
    assert by_source["b"] == 50 and by_source["a"] == pytest.approx(75, abs=2) and "z" not in by_source


def test_mixture_reaches_shares(spark):
    rows = [(i, "a" if i % 3 else "b", "en" if i % 5 else None, None if i % 7 else "x", 1 + i % 11) for i in range(4000)]
    rows += [(9000, "a", "en", "x", 0), (9001, None, "en", "x", 5)]
    sized = spark.createDataFrame(rows, SIZED)
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 3), ("c", 0.0, 2)], TARGETS)
    mixed = p8_mixing.mix(sized, targets)
    shares = {r.source: r for r in p8_mixing.reached_shares(mixed, sized, targets).collect()}
    assert shares["a"].share == pytest.approx(0.5, abs=0.003) and shares["b"].share == pytest.approx(0.5, abs=0.003)
    assert shares["a"].most_repeats == 1 and shares["b"].most_repeats <= 3 and shares["c"].tokens == 0
    again = p8_mixing.mix(sized, targets)
    assert sorted(mixed.collect()) == sorted(again.collect())
    assert mixed.filter("n_tokens = 0 or source is null").count() == 0


def test_empty_tables(spark):
    sized, targets = spark.createDataFrame([], SIZED), spark.createDataFrame([("a", 1.0, 1)], TARGETS)
    assert p8_mixing.mix(sized, targets).count() == 0
    assert p8_mixing.reached_shares(p8_mixing.mix(sized, targets), sized, targets).first().tokens == 0
