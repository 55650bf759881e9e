from __future__ import annotations

import random

import pytest

from cashloom.operators.intervals import interval_join
from cashloom.plans import registry


def pairs(points, intervals):
    return sorted(
        (n, m) for k, x, n in points for j, lo, hi, m in intervals
        if None not in (k, j, x, lo, hi) and k == j and lo <= x < hi
    )


@pytest.mark.parametrize("width", [1, 10, 1000])
@pytest.mark.parametrize("hot_rows", [3, 10_000])
def test_against_all_pairs(spark, width, hot_rows):
    rng = random.Random(width)
    keys = ["a", "a", "a", "b", None]
    points = [(rng.choice(keys), rng.choice([None, rng.randint(-300, 300), 7]), n) for n in range(400)]
    intervals = []
    for m in range(150):
        lo = rng.choice([None, rng.randint(-300, 300)])
        length = rng.choice([0, 1, 2, 3, 64, 500, -4, None])
        intervals.append((rng.choice(keys), lo, None if None in (lo, length) else lo + length, m))
    p = spark.createDataFrame(points, "k string, x long, n long")
    i = spark.createDataFrame(intervals, "k string, lo long, hi long, m long")
    got = interval_join(p, i, ["k"], "x", "lo", "hi", width, hot_rows)
    assert got.columns == ["k", "x", "n", "lo", "hi", "m"]
    assert sorted((r.n, r.m) for r in got.collect()) == pairs(points, intervals)


def test_wide_intervals_take_few_cells_and_ends_may_be_far(spark):
    low, high = -(2**63), 2**63 - 1
    intervals = [(low, high, 0), (0, 10**12, 1), (5, 6, 2), (high - 1, high, 3), (low, low + 1, 4)]
    points = [low, low + 1, -1, 0, 5, 6, 10**12, high - 1, high]
    p = spark.createDataFrame([("k", x) for x in points], "k string, x long")
    i = spark.createDataFrame([("k", *row) for row in intervals], "k string, lo long, hi long, m long")
    got = sorted((r.x, r.m) for r in interval_join(p, i, ["k"], "x", "lo", "hi").collect())
    assert got == sorted((x, m) for x in points for lo, hi, m in intervals if lo <= x < hi)


def test_empty_tables(spark):
    p = spark.range(3).selectExpr("1 AS k", "id AS x")
    i = spark.range(3).selectExpr("1 AS k", "id AS lo", "id + 1 AS hi")
    assert interval_join(p, i.limit(0), ["k"], "x", "lo", "hi").count() == 0
    assert interval_join(p.limit(0), i, ["k"], "x", "lo", "hi").count() == 0
    with pytest.raises(ValueError):
        interval_join(p, i, ["k"], "x", "lo", "hi", width=0)


@pytest.mark.parametrize("name", ["period_lookup", "asof_events"])
def test_no_nested_loops(spark, small, name):
    plan = registry.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    for operator in ("NestedLoop", "CartesianProduct", "Python", "Pandas"):
        assert operator not in plan
