from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cashloom.operators.states import flat_events
from cashloom.plans.pam import evaluate
from cashloom.plans.scenarios import evaluate_scenarios, exposures, scenario_blocks, scenario_totals, scenario_values
from cashloom.plans.testdata import MIDWAY, SHIFTS, contract_lines, market_table
from cashloom.sources.contracts import parse_contracts
from cashloom.sources.market import in_scenarios


def shifts(spark, named):
    return spark.createDataFrame(list(named.items()), "scenario string, shift double")


def rounded(rows):
    return sorted((r.scenario, r.contract_id, r.date, r.kind, round(r.value, 5), round(r.nominal, 5), round(r.accrued, 5)) for r in rows)


@pytest.mark.parametrize("together", [2, 32])
def test_the_same_as_scenarios_by_name(spark, small, together):
    contracts = parse_contracts(contract_lines(spark, small)).where("cast(substring(contract_id, 3) AS int) % 7 = 1 OR contract_id = 'CT17'")
    market = market_table(spark, small)
    fixed, floating = evaluate_scenarios(contracts, MIDWAY, market, shifts(spark, SHIFTS), together=together)
    named = flat_events(evaluate(contracts, MIDWAY, in_scenarios(market, SHIFTS), list(SHIFTS)), keep=("scenario",)).collect()
    got = flat_events(floating, keep=("scenario",)).collect()
    same = flat_events(fixed).withColumn("scenario", F.explode(F.array(*map(F.lit, SHIFTS)))).collect()
    assert rounded(got + same) == rounded(named)
    assert len(got) > 100 and len(same) > 100


def test_plan_of_the_same_size_for_many_scenarios(spark, small):
    contracts = parse_contracts(contract_lines(spark, small))
    market = market_table(spark, small)

    def plan(n):
        named = spark.range(n).selectExpr("concat('s', id) AS scenario", "id / 10000D AS shift")
        totals = scenario_totals(contracts, MIDWAY, market, named, ("currency",), "sum(value)")
        text = totals._jdf.queryExecution().optimizedPlan().toString()
        return totals, [line.strip(" :+-").split(" ")[0] for line in text.splitlines()]

    few, short = plan(3)
    many, long = plan(1000)
    assert short == long
    assert few.count() == 9


def test_totals(spark, small):
    contracts, market = parse_contracts(contract_lines(spark, small)), market_table(spark, small)
    got = scenario_totals(contracts, MIDWAY, market, shifts(spark, SHIFTS), ("currency",), "sum(value)").collect()
    events = flat_events(evaluate(contracts, MIDWAY, in_scenarios(market, SHIFTS), list(SHIFTS)), keep=("scenario",))
    want = {(r.scenario, r.currency): r for r in events.groupBy("scenario", "currency").agg(F.count("*").alias("n"), F.sum("value").alias("total")).collect()}
    assert len(got) == len(want) == 9
    for r in got:
        assert r.n_events == want[r.scenario, r.currency].n and r.total == pytest.approx(want[r.scenario, r.currency].total, rel=1e-9)


@pytest.mark.parametrize("rows", [[("a", 0.1), ("a", 0.2)], [(None, 0.1)], [("a", None)]])
def test_scenarios_have_one_name_and_shift(spark, rows):
    with pytest.raises(Exception, match="a scenario needs one name and one shift"):
        scenario_blocks(spark.createDataFrame(rows, "scenario string, shift double")).collect()


def test_blocks(spark):
    got = scenario_blocks(spark.range(7).selectExpr("concat('s', id) AS scenario", "id / 10D AS shift"), 3).orderBy("block").collect()
    assert [(r.block, r.names) for r in got] == [(0, ["s0", "s1", "s2"]), (1, ["s3", "s4", "s5"]), (2, ["s6"])]
    assert got[1].shifts == [0.3, 0.4, 0.5]
    assert scenario_blocks(spark.createDataFrame([], "scenario string, shift double")).count() == 0


def test_values_from_sums_over_contracts(spark, small):
    """As event by event, faulty contracts too, and before the scenarios there are no more rows than observations."""
    contracts, market = parse_contracts(contract_lines(spark, small, faults=True)), market_table(spark, small)
    named = shifts(spark, SHIFTS)
    got = scenario_values(contracts, MIDWAY, market, named, ("currency",)).collect()
    want = {(r.scenario, r.currency): r for r in scenario_totals(contracts, MIDWAY, market, named, ("currency",), "sum(value)").collect()}
    assert len(got) == len(want)
    for r in got:
        of = want[r.scenario, r.currency]
        assert r.n_events == of.n_events and r.total == pytest.approx(of.total, rel=1e-9, nan_ok=True)
    sums = exposures(contracts, MIDWAY, market, ("currency",))
    assert sums.select("currency", "reset_code", "years", "place").distinct().count() == sums.count()
