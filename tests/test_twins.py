"""Every registered query equals its SQL twin, and no plan pairs everything with everything."""

from __future__ import annotations

import pytest

from workload import compare, load_all
from workload.registry import QUERIES, TWINS

load_all()


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_twin(spark, con, sf, name):
    found = compare.compare(spark, con, QUERIES[name], TWINS[name], sf)
    assert found["ok"] and found["exact"], found


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("stream_", "write_"))))
def test_no_nested_loops(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoop" not in plan
