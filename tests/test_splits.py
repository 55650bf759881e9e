from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cashloom.operators import splits
from cashloom.operators.splits import CUT, SPLIT, asof_rows, with_last, with_running, with_splits
from cashloom.operators.states import flat_events
from cashloom.plans import rows as row_plans
from cashloom.plans.pam import evaluate
from cashloom.plans.rows import evaluate_rows
from cashloom.sources.contracts import parse_contracts
from cashloom.sources.lines import lines_from
from cashloom.sources.market import last_per_code, parse_market


def table(spark, seed=1, n=900):
    rng = random.Random(seed)
    keys = ["hot"] * 5 + ["warm"] * 2 + [None, "a", "b", "c"]
    rows = [(rng.choice(keys), rng.randrange(200), k, rng.choice([None, float(rng.randrange(50))]), rng.random() < 0.1) for k in range(n)]
    return rows, spark.createDataFrame(rows, "k string, at long, n long, v double, closes boolean")


def test_splits_are_in_order_and_of_bounded_size(spark):
    rows, frame = table(spark)
    got = with_splits(frame, ["k"], "at", hot_rows=40).collect()
    assert len(got) == len(rows)
    by_key = {}
    for r in got:
        by_key.setdefault(r.k, {}).setdefault(r[SPLIT], []).append(r.at)
    for key, found in by_key.items():
        ordered = [found[s] for s in sorted(found)]
        assert all(max(a) < min(b) for a, b in zip(ordered, ordered[1:]))
    assert len(by_key["hot"]) >= 8 and max(map(len, by_key["hot"].values())) < 80
    assert all(len(v) >= 2 for v in by_key.values())
    assert {r[CUT] for r in got} == {True}
    assert {(r[SPLIT], r[CUT]) for r in with_splits(frame, ["k"], "at", hot_rows=1000).collect()} == {(0, False)}


@pytest.mark.parametrize("hot_rows", [1, 7, 40, 5000])
def test_last_and_running_against_loops(spark, hot_rows):
    rows, frame = table(spark)
    cut = with_splits(frame, ["k"], "at", hot_rows)
    order = [F.col("at"), F.col("n")]
    last = with_last(cut, ["k"], order, {"before": "v", "place": "at"})
    got = {r.n: r for r in with_running(last, ["k"], order, "v", "closes", "total").collect()}
    assert len(got) == len(rows)
    state = {}
    for k, at, n, v, closes in sorted(rows, key=lambda r: (r[1], r[2])):
        seen, place, total = state.get(k, (None, None, 0.0))
        total += v or 0.0
        assert (got[n].before, got[n].place, got[n].total) == (seen, place, total)
        state[k] = (seen if v is None else v, at, 0.0 if closes else total)


def test_one_key_is_many_tasks(spark):
    """A running sum over one key of 40,000 rows: no window group holds more than some times hot_rows."""
    frame = spark.range(40_000).selectExpr("1 AS k", "id AS at", "1D AS v", "id % 1000 = 999 AS closes")
    cut = with_splits(frame, ["k"], "at", hot_rows=2000)
    sizes = cut.groupBy("k", SPLIT).count().collect()
    assert len(sizes) >= 15 and max(r["count"] for r in sizes) < 5000
    got = with_running(cut, ["k"], [F.col("at")], "v", "closes", "total")
    assert got.where("total <> at % 1000 + 1").count() == 0 and got.count() == 40_000


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("hot_rows", [1, 15, 10_000])
def test_asof_against_a_loop(spark, strict, hot_rows):
    rng = random.Random(3)
    keys = [("hot", 1)] * 6 + [("hot", 2), ("x", 1), (None, 1), ("x", None)]
    # many probes and observations at one place
    place = lambda: rng.choice([50, 50, 50, rng.randrange(100), None])
    probes = [(*rng.choice(keys), place(), n) for n in range(700)]
    seen = [(*rng.choice(keys), place(), float(rng.randrange(9)), rng.choice("ab")) for _ in range(160)]
    p = spark.createDataFrame(probes, "k string, j int, at long, n long")
    o = spark.createDataFrame(seen, "k string, j int, at long, v double, w string")
    got = {r.n: (r.v, r.w) for r in asof_rows(p, o, ["k", "j"], "at", ["v", "w"], strict, hot_rows).collect()}
    assert len(got) == len(probes)
    for k, j, at, n in probes:
        there = [] if None in (k, j, at) else [s for s in seen if s[:2] == (k, j) and s[2] is not None and (s[2] < at or s[2] == at and not strict)]
        best = max(there, key=lambda s: s[2:], default=(None,) * 5)
        assert got[n] == best[3:], (k, j, at)


def test_asof_of_empty_tables(spark):
    p, o = spark.range(3).selectExpr("id AS k", "id AS at"), spark.range(3).selectExpr("id AS k", "id AS at", "id AS v")
    assert [r.v for r in asof_rows(p, o.limit(0), ["k"], "at", ["v"]).collect()] == [None] * 3
    assert asof_rows(p.limit(0), o, ["k"], "at", ["v"]).count() == 0


def test_probes_at_one_place_are_dealt_out(spark):
    probes = spark.range(3000).selectExpr("'c' AS k", "7L AS at", "id AS n")
    seen = spark.createDataFrame([("c", 3, 1.0), ("c", 7, 2.0), ("c", 9, 3.0)], "k string, at long, v double")
    found = asof_rows(probes, seen, ["k"], "at", ["v"], hot_rows=200)
    assert found.where("v = 2").count() == 3000
    cut = with_splits(probes, ["k"], "at", 200, spread=F.lit(True)).groupBy(SPLIT).count().collect()
    assert len(cut) >= 10 and max(r["count"] for r in cut) < 600


TERMS = "{id};x;;;2015-01-01;{role};;{id};;2015-02-01;{cycle};0.05;A/365;;;;EUR;2015-01-01;2015-01-01;{end};1000;{bought};990;{stop};1010;;;;;;2015-03-01;1M-;0.01;{code};;;{next};1.0;6M;-5"
MARKET = [
    "REF;x;ReferenceRate;2015-06-01!2016-01-01!2016-01-01!2018-01-01;0.06!0.09!0.07!0.08", "BAD;x;ReferenceRate;2015-06-01!no;0.5!0.5", "CRV;x;TermStructure;6M!1Y;0.05!0.07",
]


def test_states_of_rows_against_states_of_arrays(spark):
    """Also a contract of daily interest over forty years, cut into many splits."""
    lines = [
        TERMS.format(id=f"C{k}", role=("RPA", "RPL")[k % 2], cycle=("1M-", "1Q-", "NULL", "1D-")[k % 4], end=f"20{17 + k}-06-15",
                     bought=("NULL", "2016-05-05")[k % 3 == 0], stop=("NULL", "2016-11-11")[k % 5 == 0],
                     code=("REF", "CRV", "BAD", "MISSING")[k // 2 % 4], next=("NULL", "0.03")[k % 2])
        for k in range(16)
    ]
    lines += lines[:2] + [TERMS.format(id="LONG", role="RPA", cycle="1D-", end="2055-01-01", bought="NULL", stop="NULL", code="REF", next="NULL")]
    contracts = parse_contracts(lines_from(spark, lines))
    market = last_per_code(parse_market(lines_from(spark, MARKET)))
    for t0, hot_rows in (("2014-01-01", 50), ("2016-07-01", 3000)):
        rows = evaluate_rows(contracts, t0, market, hot_rows=hot_rows).collect()
        arrays = flat_events(evaluate(contracts, t0, market)).collect()
        key = lambda r: (r.contract_id, r.date, r.kind, round(r.value, 6), round(r.nominal, 6), round(r.accrued, 6), r.rate and round(r.rate, 9))
        assert sorted(map(key, rows), key=str) == sorted(map(key, arrays), key=str)
    assert sum(r.contract_id == "LONG" for r in rows) > 10_000
    assert len({r.contract for r in rows}) == len(lines)


def test_a_contract_of_many_events_is_spread_over_tasks(spark, monkeypatch):
    found = []
    plain = splits.with_splits
    monkeypatch.setattr("cashloom.plans.rows.with_splits", lambda *a, **b: found.append(plain(*a, **b)) or found[-1])
    line = TERMS.format(id="LONG", role="RPA", cycle="1D-", end="2135-01-01", bought="NULL", stop="NULL", code="NULL", next="NULL")
    events = evaluate_rows(parse_contracts(lines_from(spark, [line])), "2014-01-01", last_per_code(parse_market(lines_from(spark, MARKET))), hot_rows=4000)
    assert events.count() > 43_000
    sizes = found[0].groupBy(SPLIT).count().collect()
    assert len(sizes) > 10 and max(r["count"] for r in sizes) < 10_000


def test_cuts_are_found_by_halving(spark):
    rng = random.Random(5)
    lists = [sorted(rng.randrange(-20, 20) for _ in range(n)) for n in (1, 2, 3, 7, 8, 9, 64, 100)]
    cases = [(cuts, at) for cuts in lists for at in (-21, -20, -3, 0, 7, 19, 20)]
    found = {sign: splits.cuts_before("cuts", "at", sign) for sign in ("<", "<=")}
    got = spark.createDataFrame(cases, "cuts array<long>, at long").selectExpr("cuts", "at", f"{found['<']} AS low", f"{found['<=']} AS high")
    assert [r for r in got.collect() if (r.low, r.high) != (sum(c < r.at for c in r.cuts), sum(c <= r.at for c in r.cuts))] == []
    _, frame = table(spark)
    assert "filter(" not in with_splits(frame, ["k"], "at", 40, spread=F.lit(True))._jdf.queryExecution().optimizedPlan().toString()


RESETTING = "{id};x;;;2015-01-01;RPA;;{id};;2015-02-01;1Q-;0.05;A/365;;;;EUR;2015-01-01;2015-01-01;2017-06-15;1000;NULL;NULL;NULL;NULL;;;;;;2015-03-01;1M-;0.01;{code};;;NULL;1.0;{term};-5"


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_a_day_of_a_code_is_observed_once(spark, monkeypatch, limit):
    """However many resets there are; also of contracts without a code or a term, joined and broadcast."""
    lines = [RESETTING.format(id=f"C{k}", code=("REF", "CRV", "NULL")[k % 3], term=("6M", "NULL", "1Y")[k // 3 % 3]) for k in range(27)]
    contracts, market = parse_contracts(lines_from(spark, lines)), last_per_code(parse_market(lines_from(spark, MARKET)))
    asked = []
    monkeypatch.setattr(row_plans, "asof_rows", lambda probes, *a, **b: asked.append(probes) or asof_rows(probes, *a, **b))
    key = lambda r: (r.contract_id, r.date, r.kind, round(r.value, 6), round(r.accrued, 6), r.rate and round(r.rate, 9))
    rows = evaluate_rows(contracts, "2014-01-01", market, hot_rows=10, limit=limit).collect()
    arrays = flat_events(evaluate(contracts, "2014-01-01", market)).collect()
    assert sorted(map(key, rows)) == sorted(map(key, arrays))
    days = {r.date for r in rows if r.type == "RR"}
    assert [probes.count() for probes in asked] == [2 * len(days)]
