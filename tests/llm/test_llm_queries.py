"""Every query of the package runs on the smallest tables and has the columns that the tables' description gives."""

import pytest

from quernwork.llm import registry

FOUND = {
    "p1_found": {"conv_id": "bigint", "turn": "int", "defect": "string"},
    "p2_found": {"page_id": "bigint", "kind": "string", "item": "string"},
    "p3_found": {"table_name": "string", "record_id": "string", "kind": "string"},
    "p6_found": {"rec_id_1": "bigint", "rec_id_2": "bigint"},
    "p9_found": {"doc_id_1": "bigint", "doc_id_2": "bigint"},
    "p7_ids": {"doc_id": "bigint", "ids": "array<int>"},
}


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_runs(spark, smoke_dir, name):
    frame = registry.queries()[name](spark, smoke_dir)
    if name in FOUND:
        assert dict(frame.dtypes) == FOUND[name]
    rows = frame.collect()
    if name.endswith("_found"):
        assert len(rows) == len({tuple(r) for r in rows})


def test_there_is_a_query_for_each_problem():
    names = registry.queries()
    assert all(any(n.startswith(f"p{k}_") for n in names) for k in range(1, 10))
