"""Contracts worked out by hand, contracts against the loop evaluator, and invariants."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from evaluator import add_months, events
from pyspark.sql import functions as F

from cashloom.operators.states import event_counts, event_rows, flat_events, nested_events, unnested
from cashloom.plans.job import events_from_files
from cashloom.plans.pam import evaluate
from cashloom.plans.testdata import contract_lines, market_table, rendered
from cashloom.sources.contracts import parse_contracts
from cashloom.sources.layouts import FULL_LAYOUT
from cashloom.sources.lines import lines_from
from cashloom.sources.market import last_per_code, parse_market

T0 = "2015-01-01"
PLAIN = {
    "contract_id": "C",
    "role": "RPA",
    "currency": "EUR",
    "day_count": "30E/360",
    "initial_exchange_date": "2015-02-01",
    "maturity_date": "2016-02-01",
    "notional": "1000",
    "nominal_rate": "0.12",
    "interest_cycle": "1Q-",
    "interest_anchor": "2015-05-01",
}
MARKET = [
    "REF;x;ReferenceRate;2015-05-01T00!2015-07-01!2015-10-01;0.06!0.24!0.36",
    "CRV;x;TermStructure;6M!1Y;0.05!0.07",
    "IDX;x;ReferenceIndex;2015-01-01;100",
]


def line(**terms) -> str:
    tokens = [""] * 40
    for term in FULL_LAYOUT:
        tokens[term.position] = {**PLAIN, **terms}.get(term.name, "NULL")
    return ";".join(tokens)


def run(spark, lines, t0=T0, market=None):
    contracts = parse_contracts(lines_from(spark, lines), FULL_LAYOUT)
    table = None if market is None else last_per_code(parse_market(lines_from(spark, market)))
    rows = flat_events(evaluate(contracts, t0, table)).orderBy("contract_id", "date", "kind").collect()
    return [
        (r["date"].isoformat(), r["type"], round(r["value"], 6), round(r["nominal"], 6), round(r["accrued"], 6))
        for r in rows
    ]


def test_quarterly_interest(spark):
    assert run(spark, [line()]) == [
        ("2015-02-01", "IED", -1000, 1000, 0),
        ("2015-05-01", "IP", 30, 1000, 0),
        ("2015-08-01", "IP", 30, 1000, 0),
        ("2015-11-01", "IP", 30, 1000, 0),
        ("2016-02-01", "IP", 30, 1000, 0),
        ("2016-02-01", "MD", 1000, 0, 0),
    ]


def test_bullet_and_discount_at_exchange(spark):
    terms = {"interest_cycle": "NULL", "interest_anchor": "NULL", "premium_discount": "-100"}
    assert run(spark, [line(**terms)]) == [
        ("2015-02-01", "IED", -900, 1000, 0),
        ("2016-02-01", "IP", 120, 1000, 0),
        ("2016-02-01", "MD", 1000, 0, 0),
    ]


def test_liability(spark):
    assert [e[2] for e in run(spark, [line(role="RPL")])] == [1000, -30, -30, -30, -30, -1000]


def test_two_resets(spark):
    """Resets on 2015-06-01 at 6% and 2015-09-01 at 24%, each in the middle of a quarter."""
    terms = {"reset_code": "REF", "reset_anchor": "2015-06-01", "reset_cycle": "1Q-", "rate_spread": "0"}
    assert run(spark, [line(**terms)], market=MARKET)[1:7] == [
        ("2015-05-01", "IP", 30, 1000, 0),
        ("2015-06-01", "RR", 0, 1000, 10),
        ("2015-08-01", "IP", 20, 1000, 0),
        ("2015-09-01", "RR", 0, 1000, 5),
        ("2015-11-01", "IP", 45, 1000, 0),
        ("2015-12-01", "RR", 0, 1000, 20),
    ]


def test_several_resets_between_payments(spark):
    """Monthly resets under one payment at maturity: 12 % a month, then 6, 6, 24, 24, 24, 36, ... %."""
    terms = {"interest_cycle": "NULL", "interest_anchor": "NULL", "reset_code": "REF", "reset_cycle": "1M-"}
    result = run(spark, [line(**terms, reset_anchor="2015-03-01")], market=MARKET)
    accrued = [e[4] for e in result if e[1] == "RR"]
    # The first two resets have no observation and keep the rate of the contract.
    assert accrued == [10, 20, 30, 35, 40, 60, 80, 100, 130, 160, 190]
    assert ("2016-02-01", "IP", 220, 1000, 0) in result


def test_fixed_first_reset_and_curve(spark):
    terms = {
        "reset_code": "CRV",
        "reset_anchor": "2015-05-01",
        "reset_cycle": "1Q-",
        "next_reset_rate": "0.24",
        "rate_term": "9M",
        "rate_multiplier": "2",
        "rate_spread": "0.04",
    }
    # The curve gives 6 % at nine months, doubled and raised by 4 %.
    assert run(spark, [line(**terms)], market=MARKET)[1:6] == [
        ("2015-05-01", "IP", 30, 1000, 0),
        ("2015-05-01", "RRF", 0, 1000, 0),
        ("2015-08-01", "IP", 60, 1000, 0),
        ("2015-08-01", "RR", 0, 1000, 0),
        ("2015-11-01", "IP", 40, 1000, 0),
    ]


def test_missing_code_keeps_the_rate(spark):
    terms = {"reset_code": "NOWHERE", "reset_anchor": "2015-06-01", "reset_cycle": "1Q-"}
    result = run(spark, [line(**terms)], market=MARKET)
    assert [e[2] for e in result if e[1] == "IP"] == [30, 30, 30, 30]


def test_reset_status(spark):
    terms = {"reset_anchor": "2015-03-01", "reset_cycle": "1Q-"}
    codes = ["REF", "CRV", "IDX", "NOWHERE", "NULL"]
    lines = [line(**terms, contract_id=c, reset_code=c, rate_term="6M") for c in codes]
    table = last_per_code(parse_market(lines_from(spark, MARKET)))
    rows = evaluate(parse_contracts(lines_from(spark, lines)), T0, table).select("contract_id", "reset_status").collect()
    assert {r[0]: r[1] for r in rows} == {
        "REF": "no_observation",
        "CRV": "ok",
        "IDX": "unsupported_type",
        "NOWHERE": "missing",
        None: "none",
    }


def test_running_contract(spark):
    assert run(spark, [line()], t0="2015-09-15") == [
        ("2015-11-01", "IP", 30, 1000, 0),
        ("2016-02-01", "IP", 30, 1000, 0),
        ("2016-02-01", "MD", 1000, 0, 0),
    ]


def test_analysis_date_on_an_event(spark):
    """Events of the analysis date itself are past."""
    assert run(spark, [line()], t0="2015-02-01")[0] == ("2015-05-01", "IP", 30, 1000, 0)
    assert run(spark, [line()], t0="2015-11-01")[0] == ("2016-02-01", "IP", 30, 1000, 0)
    assert run(spark, [line()], t0="2016-02-01") == []


def test_purchase(spark):
    assert run(spark, [line(purchase_date="2015-09-01", purchase_price="990")]) == [
        ("2015-09-01", "PRD", -1000, 1000, 10),
        ("2015-11-01", "IP", 30, 1000, 0),
        ("2016-02-01", "IP", 30, 1000, 0),
        ("2016-02-01", "MD", 1000, 0, 0),
    ]


def test_termination(spark):
    assert run(spark, [line(termination_date="2015-09-01", termination_price="1010")]) == [
        ("2015-02-01", "IED", -1000, 1000, 0),
        ("2015-05-01", "IP", 30, 1000, 0),
        ("2015-08-01", "IP", 30, 1000, 0),
        ("2015-09-01", "TD", 1020, 0, 0),
    ]


def test_month_end(spark):
    terms = {"initial_exchange_date": "2015-01-31", "interest_anchor": "2015-01-31", "interest_cycle": "1M-"}
    days = [e[0] for e in run(spark, [line(**terms, maturity_date="2015-06-15")]) if e[1] == "IP"]
    assert days == ["2015-02-28", "2015-03-31", "2015-04-30", "2015-05-31", "2015-06-15"]


@pytest.mark.parametrize(("cycle", "days"), [("1Q-", 4), ("1Q+", 3), ("1QL1", 4), ("1QL0", 3), ("P1Q", 4)])
def test_stub(spark, cycle, days):
    result = run(spark, [line(interest_cycle=cycle, maturity_date="2015-12-15")])
    assert len([e for e in result if e[1] == "IP"]) == days
    assert result[-2][2] == pytest.approx({4: 1000 * 0.12 * 44 / 360, 3: 1000 * 0.12 * 134 / 360}[days], abs=1e-6)


@pytest.mark.parametrize("cycle", ["3 M -", "3 X -", "999999999Y", "200000000M", "9999999999D"])
@pytest.mark.parametrize("anchor", ["2015-05-01", "NULL"])
def test_no_cycle_text_ends_the_job(spark, cycle, anchor):
    """A cycle longer than the calendar has its anchor only, a malformed one no date; others go on."""
    terms = {"interest_cycle": cycle, "reset_cycle": cycle, "interest_anchor": anchor, "reset_code": "REF"}
    result = run(spark, [line(**terms), line(contract_id="D")], market=MARKET)
    paid = [e[0] for e in result if e[1] == "IP"]
    first = ["2015-05-01"] if anchor != "NULL" and " " not in cycle else []
    assert sorted(paid) == sorted([*first, "2016-02-01", "2015-05-01", "2015-08-01", "2015-11-01", "2016-02-01"])


def test_equal_lines_are_separate_contracts(spark):
    assert len(run(spark, [line()] * 3)) == 18


def test_unreadable_terms(spark):
    contracts = parse_contracts(lines_from(spark, [line(purchase_price="n/a", maturity_date="2016-02-30")]))
    row = contracts.select("purchase_price", "maturity_date", "notional", "term_errors").first()
    assert tuple(row) == (None, None, 1000.0, ["maturity_date", "purchase_price"])
    assert flat_events(evaluate(contracts, T0)).count() == 0
    evaluated = evaluate(contracts, T0)
    assert nested_events(evaluated).first()["id"] == []
    assert evaluated.first()["contract_status"] == "unreadable maturity_date, unreadable purchase_price"


@pytest.mark.parametrize(
    ("terms", "status"),
    [
        ({}, "ok"),
        ({"role": "BUY"}, "unknown role"),
        ({"day_count": "ACT/360"}, "unknown day_count"),
        ({"day_count": "NULL"}, "unknown day_count"),
        ({"interest_cycle": "quarterly"}, "unknown interest_cycle"),
        ({"interest_cycle": "NULL"}, "ok"),
        ({"reset_cycle": "3 X -", "role": "NULL"}, "unknown reset_cycle, unknown role"),
        ({"maturity_date": "NULL", "notional": "x"}, "unreadable notional, missing maturity_date"),
        ({"maturity_date": "2014-01-01"}, "matures before its exchange"),
        ({"currency": "NULL"}, "missing currency"),
        ({"contract_id": "NULL"}, "missing contract_id"),
        ({"purchase_date": "2015-06-01"}, "missing purchase_price"),
        ({"purchase_date": "2015-06-01", "purchase_price": "990"}, "ok"),
        ({"purchase_date": "2015-06-01", "purchase_price": "x"}, "unreadable purchase_price"),
        ({"termination_date": "2015-06-01"}, "missing termination_price"),
        ({"notional": "NaN"}, "not finite notional"),
        ({"nominal_rate": "Infinity", "premium_discount": "-Infinity"}, "not finite nominal_rate, not finite premium_discount"),
        ({"rate_spread": "NaN", "next_reset_rate": "NaN"}, "not finite rate_spread, not finite next_reset_rate"),
    ],
)
def test_contract_status_comes_with_the_events(spark, terms, status):
    evaluated = evaluate(parse_contracts(lines_from(spark, [line(**terms)])), T0)
    assert evaluated.first()["contract_status"] == status
    assert event_counts(evaluated, keep=("contract_status",)).first()["contract_status"] == status
    assert {r["contract_status"] for r in flat_events(evaluated, keep=("contract_status",)).collect()} <= {status}


def test_no_line_ends_the_job(spark, tmp_path):
    """Each fault alone in a file with a good contract: events of the good one, a status of both."""
    faults = [
        {"currency": "NULL"}, {"contract_id": "NULL"}, {"notional": "NaN"}, {"notional": "NULL"}, {"nominal_rate": "x"},
        {"purchase_date": "2015-06-01"}, {"termination_date": "2015-06-01"}, {"role": "BUY"}, {"maturity_date": "2016-13-01"},
        {"premium_discount": "Infinity"}, {"day_count": "NULL"}, {"interest_cycle": "3 X -"}, {"initial_exchange_date": "NULL"},
    ]
    paths = {n: str(tmp_path / n) for n in ("contracts", "market", "date", "events", "statuses")}
    lines = [line(contract_id="GOOD"), *[line(**f) for f in faults], "", ";;;"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(paths["contracts"])
    spark.createDataFrame([(x,) for x in MARKET], "value string").write.text(paths["market"])
    spark.createDataFrame([(f"{T0}T00;x",)], "value string").write.text(paths["date"])
    events_from_files(spark, **paths)
    events, statuses = spark.read.parquet(paths["events"]), spark.read.parquet(paths["statuses"])
    assert {r.id for r in events.collect()} == {"GOOD"} and events.count() == 6
    assert [r.n_events for r in statuses.where("contract_status = 'ok'").collect()] == [6]
    assert statuses.where("contract_status <> 'ok'").count() == len(faults) + 2


def test_unreadable_market_objects(spark):
    market = [
        "REF;x;ReferenceRate;2015-05-01T00!bad;0.06!0.24", "CRV;x;TermStructure;6M!1Y;0.05",
        "NAN;x;ReferenceRate;2015-05-01;NaN", "INF;x;TermStructure;6M!1Y;0.05!Infinity",
    ]
    table = last_per_code(parse_market(lines_from(spark, market)))
    terms = {"reset_anchor": "2015-06-01", "reset_cycle": "1Q-", "rate_term": "6M"}
    contracts = parse_contracts(lines_from(spark, [line(**terms, reset_code=c) for c in ("REF", "CRV", "NAN", "INF")]))
    assert [r["reset_status"] for r in evaluate(contracts, T0, table).collect()] == ["unreadable"] * 4


def random_contract(rng: random.Random, number: int) -> dict:
    start = date(2014, 1, 1) + timedelta(rng.randrange(900))
    maturity = add_months(start, rng.randrange(1, 50)) + timedelta(rng.randrange(20))

    def some(value, share=0.5):
        return value if rng.random() < share else None

    cycles = ["1M-", "1Q-", "2M+", "6M-", "1Y-", "10D-", "3WL0", "P1QL1"]
    return {
        "contract_id": f"C{number}",
        "role": rng.choice(["RPA", "RPL"]),
        "currency": "EUR",
        "day_count": rng.choice(["A/365", "A/360", "30E/360", "A/A ISDA"]),
        "initial_exchange_date": start,
        "maturity_date": maturity,
        "notional": float(rng.randrange(1000, 9000)),
        "nominal_rate": rng.randrange(1, 12) / 100,
        "interest_cycle": some(rng.choice(cycles), 0.9),
        "interest_anchor": some(start + timedelta(rng.randrange(-40, 200))),
        "reset_code": some(rng.choice(["REF", "NOWHERE"]), 0.8),
        "reset_cycle": some(rng.choice([*cycles, "1D", "2D"]), 0.8),
        "reset_anchor": some(start + timedelta(rng.randrange(-40, 200))),
        "next_reset_rate": some(0.03),
        "rate_spread": some(0.01),
        "rate_multiplier": some(2.0),
        "purchase_date": some(start + timedelta(rng.randrange(-40, 600)), 0.3),
        "purchase_price": 900.0,
        "termination_date": some(start + timedelta(rng.randrange(-40, 600)), 0.3),
        "termination_price": 1100.0,
        "premium_discount": some(-50.0),
    }


def test_against_loop_evaluator(spark):
    rng = random.Random(7)
    contracts = [random_contract(rng, n) for n in range(400)]
    lines = [line(**{k: "NULL" if v is None else str(v) for k, v in c.items()}) for c in contracts]
    series = sorted({date(2014, 6, 1) + timedelta(rng.randrange(1500)) for _ in range(90)})
    rates = {day: rng.randrange(100) / 1000 for day in series}
    market = [f"REF;x;ReferenceRate;{'!'.join(map(str, series))};{'!'.join(str(rates[d]) for d in series)}"]

    def rate_at(code, day):
        known = [d for d in series if d <= day]
        return rates[known[-1]] if code == "REF" and known else None

    table = last_per_code(parse_market(lines_from(spark, market)))
    for t0 in (date(2013, 1, 1), date(2015, 6, 30)):
        evaluated = evaluate(parse_contracts(lines_from(spark, lines, 4)), t0.isoformat(), table)
        got: dict[str, list] = {c["contract_id"]: [] for c in contracts}
        for r in flat_events(evaluated).orderBy("contract_id", "date", "kind").collect():
            got[r["contract_id"]].append((r["date"], r["type"], r["value"], r["nominal"], r["accrued"]))
        for c in contracts:
            expected = events(c, t0, rate_at)
            assert [e[:2] for e in got[c["contract_id"]]] == [e[:2] for e in expected], c
            for ours, theirs in zip(got[c["contract_id"]], expected):
                assert ours[2:] == pytest.approx(theirs[2:], abs=1e-6), (c, ours, theirs)


def test_invariants(spark, small):
    market = market_table(spark, small)
    evaluated = evaluate(parse_contracts(contract_lines(spark, small)), "1996-07-01", market).cache()
    flat = flat_events(evaluated)
    assert flat.where("type IN ('MD', 'TD') AND (nominal <> 0 OR accrued <> 0)").count() == 0
    assert flat.where("type = 'IP' AND accrued <> 0").count() == 0
    ends = flat.where("type IN ('MD', 'TD')").groupBy("contract_id").count()
    assert ends.where("count <> 1").count() == 0
    assert event_rows(evaluated).count() == flat.count()
    columns = ["id", "date", "type", "currency", "value", "nominal", "accrued"]
    back = unnested(nested_events(evaluated)).select(columns)
    out = flat.select(F.col("contract_id").alias("id"), F.col("date").cast("string").alias("date"), *columns[2:])
    assert back.exceptAll(out).count() == 0 and out.exceptAll(back).count() == 0


def test_interest_adds_up(spark, small):
    """Payments of a fixed contract sum to the interest of its whole life."""
    from cashloom.functions.daycount import year_fraction

    contracts = parse_contracts(contract_lines(spark, small)).where("termination_date IS NULL AND purchase_date IS NULL")
    paid = flat_events(evaluate(contracts, "1990-01-01")).where("type = 'IP'").groupBy("contract_id").sum("value")
    life = year_fraction("initial_exchange_date", "maturity_date", "day_count")
    whole = contracts.selectExpr(
        "contract_id", f"if(role = 'RPL', -1, 1) * notional * nominal_rate * ({life}) AS whole", "next_reset_rate", "reset_code"
    ).where("next_reset_rate IS NULL OR reset_code IS NULL")
    joined = whole.join(paid, "contract_id")
    assert joined.where("abs(whole - `sum(value)`) > 1e-6").count() == 0
    assert joined.count() > 500


def test_rendered_lines_have_forty_positions():
    assert rendered({t.name: "''" for t in FULL_LAYOUT}, FULL_LAYOUT).count("''") == 40
