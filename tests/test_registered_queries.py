from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from cashloom.plans import oracles, registry


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", registry.queries())
def test_query_agrees_with_sql(spark, con, small, name):
    assert difference(spark, con, registry.queries()[name], oracles.oracle_sql()[name], small) == ""


@pytest.mark.parametrize("name", ["rf_status", "rate_asof", "curve_interpolate", "events_flat", "discount_factor"])
def test_no_nested_loops_and_no_python(spark, small, name):
    plan = registry.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    for operator in ("NestedLoop", "CartesianProduct", "Window", "Python", "Pandas", "Arrow"):
        assert operator not in plan


def test_every_query_has_sql():
    assert registry.queries().keys() == oracles.oracle_sql().keys()


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["contract_id", "date", "type", "currency", "value", "nominal", "accrued"]
    assert frame.count() > 0
