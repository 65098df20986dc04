"""Every query of the core against its SQL, on the smallest tables; the rest must run."""

import compare
import pytest

from quernwork.plans import registry

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(smoke_dir):
    return compare.views(smoke_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, smoke_dir, con, name):
    assert compare.differences(QUERIES[name](spark, smoke_dir), con, ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, smoke_dir, name):
    rows = QUERIES[name](spark, smoke_dir)
    assert rows.columns and rows.count() > 0


def test_entry_has_a_stable_schema(spark):
    import __spark_entry__ as entry

    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema and first.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
