"""Parsing, market data, lookups beyond the broadcast bound, sinks and small operators."""

from __future__ import annotations

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cashloom import session
from cashloom.functions.cycles import parse_cycle, tenor_years
from cashloom.functions.daycount import year_fraction
from cashloom.functions.numbers import half_up
from cashloom.functions.text import split_trimmed, to_date, to_double
from cashloom.operators.asof import asof_join
from cashloom.operators.curve import interpolate
from cashloom.operators.hits import hit_ratio, random_points
from cashloom.operators.lookup import fits_broadcast, lookup, with_reset_object
from cashloom.operators.states import flat_events
from cashloom.operators.tokens import token_arrays, token_counts, token_rows
from cashloom.plans.job import EVENT_SCHEMA, declared
from cashloom.plans.pam import evaluate, event_records
from cashloom.plans.testdata import BEFORE_ALL, DISCOUNT_CURVE, SHIFTS, contract_lines, market_table
from cashloom.sources.analysis_date import first_date, with_analysis_date
from cashloom.sources.catalog import create_table, drop_table, insert_rows, select_all
from cashloom.sources.contracts import TRUNCATE, parse_contracts
from cashloom.sources.layouts import FULL_LAYOUT, SHORT_LAYOUT
from cashloom.sources.lines import lines_from, read_lines
from cashloom.sources.market import curve_points, dated_points, in_scenarios, last_per_code, parse_market
from cashloom.sources.runlog import append_runs, read_runs
from cashloom.sources.sinks import append_csv, read_csv, read_text_rows, write_text_rows


def value(spark, expression: str):
    return spark.range(1).selectExpr(f"{expression} AS v").first()["v"]


@pytest.mark.parametrize(
    ("text", "tokens"),
    [
        ("a;b", ["a", "b"]),
        ("a;b;;", ["a", "b"]),
        (";a;;b", ["", "a", "", "b"]),
        (";;;", []),
        ("", [""]),
        ("abc", ["abc"]),
    ],
)
def test_split_drops_trailing_empty_tokens(spark, text, tokens):
    assert value(spark, split_trimmed(f"'{text}'", ";")) == tokens


@pytest.mark.parametrize(
    ("text", "separator", "tokens"),
    [
        ("a|b||", "|", ["a", "b"]),
        ("a.b..", ".", ["a", "b"]),
        ("ab..", "..", ["ab"]),
        ("a.b.", "..", ["a.b."]),
        ("x^y^]z^]", "^]", ["x^y", "z"]),
        ("1\\\\2\\\\", "\\", ["1", "2"]),
        ("a&&b[c&&", "&&", ["a", "b[c"]),
        ("$a$", "$", ["", "a"]),
    ],
)
def test_separators_are_text(spark, text, separator, tokens):
    assert value(spark, split_trimmed(f"'{text}'", separator)) == tokens


def test_separator_must_not_be_empty():
    with pytest.raises(ValueError):
        split_trimmed("'a'", "")


def test_hour_24_is_the_next_day(spark):
    texts = ["2015-04-01T24", "2015-12-31T24", "2015-02-30T24", "2015-04-01T25"]
    days = [value(spark, to_date(f"'{t}'")) for t in texts]
    assert [d and d.isoformat() for d in days] == ["2015-04-02", "2016-01-01", None, None]


def test_dates_and_numbers(spark):
    texts = ["2015-04-01", "2015-04-01T00", "2015-04-01T23", "2015-02-29", "2015-4-1", "NULL", "", "2015-04-01T99"]
    days = [value(spark, to_date(f"'{t}'")) for t in texts]
    assert [d and d.isoformat() for d in days] == ["2015-04-01"] * 3 + [None] * 5
    assert [value(spark, to_double(f"'{t}'")) for t in ("1.5", "-2E3", "NULL", "n/a", "")] == [1.5, -2000, None, None, None]


def test_cycles(spark):
    texts = ["3M-", "P2Q+", "1HL0", "1YL1", "10D", "2W", "0M-", "M", "3X", "3ML2", "3M-x"]
    steps = [value(spark, parse_cycle(f"'{t}'")) for t in texts]
    assert [s and tuple(s) for s in steps] == [
        (3, 0, False), (6, 0, True), (6, 0, True), (12, 0, False), (0, 10, False), (0, 14, False),
        None, None, None, None, None,
    ]
    assert value(spark, tenor_years("'18M'")) == 1.5
    texts = ["3 M -", "3 X -", " 3M", "3M ", "999999999Y", "200000000M", "9999999999D", "9" * 30 + "D", "9" * 19 + "Y"]
    steps = [value(spark, parse_cycle(f"'{t}'")) for t in texts]
    assert [s and tuple(s) for s in steps] == [
        None, None, None, None, (11999999988, 0, False), (200000000, 0, False), (0, 9999999999, False), None, None,
    ]
    assert value(spark, tenor_years("'73D'")) == 0.2


def test_day_counts(spark):
    def years(a, b, convention):
        return value(spark, year_fraction(f"DATE'{a}'", f"DATE'{b}'", f"'{convention}'"))

    assert years("2015-01-31", "2015-07-31", "30E/360") == 0.5
    assert years("2015-01-01", "2015-07-20", "A/360") == 200 / 360
    assert years("2015-01-01", "2015-07-20", "A/365") == 200 / 365
    assert years("2015-12-01", "2016-03-01", "A/A ISDA") == pytest.approx(31 / 365 + 60 / 366, abs=1e-12)
    assert years("2015-01-01", "2015-07-20", "other") is None


def test_half_up(spark):
    assert [value(spark, half_up(f"{v}D", 4)) for v in (0.00005, -0.00005, 1.00005, 2.5)] == [0.0001, 0.0, 1.0001, 2.5]
    assert math.copysign(1, value(spark, half_up("-0.00001D", 4))) == 1
    assert [value(spark, half_up(f"double('{v}')", 4)) for v in (1e16, -1e300, math.inf, 1.23454991, 922337203685477.9)] == [
        1e16, -1e300, math.inf, 1.2345, 922337203685477.9,
    ]
    assert math.isnan(value(spark, half_up("double('NaN')", 4))) and value(spark, half_up("cast(NULL AS double)", 4)) is None
    assert value(spark, half_up("1.23454991D", 4, nudge=0.001)) == 1.2346
    assert units_of(spark, "1e16D") == "100000000000000000000" and units_of(spark, "double('NaN')") == "NaN"


def units_of(spark, expression):
    from cashloom.plans.registry import units

    return value(spark, units(expression, 4))


def contract_line(layout, **terms) -> str:
    tokens = [""] * (max(t.position for t in layout) + 1)
    for term in layout:
        tokens[term.position] = terms.get(term.name, "NULL")
    return ";".join(tokens)


def test_truncating_parse_stops_at_the_first_failure(spark):
    lines = [
        contract_line(FULL_LAYOUT, nominal_rate="0.1", notional="oops", currency="EUR", rate_term="6M"),
        contract_line(FULL_LAYOUT, contract_id="C2", nominal_rate="0.1", notional="5"),
        ";;;;2015-01-01;RPA",
    ]
    parsed = parse_contracts(lines_from(spark, lines, 1), FULL_LAYOUT, on_error=TRUNCATE)
    rows = parsed.select("role", "nominal_rate", "currency", "notional", "rate_term", "term_errors").collect()
    assert [tuple(r) for r in rows] == [
        (None, 0.1, "EUR", None, None, ["notional"]),
        (None, 0.1, None, 5.0, None, ["purchase_price"]),
        ("RPA", None, None, None, None, ["contract_id"]),
    ]
    with pytest.raises(ValueError):
        parse_contracts(lines_from(spark, lines), FULL_LAYOUT, on_error="other")


def test_layouts_differ_in_the_place_of_the_currency(spark):
    short = parse_contracts(lines_from(spark, [contract_line(SHORT_LAYOUT, currency="CHF", notional="7")]), SHORT_LAYOUT)
    assert tuple(short.select("currency", "notional").first()) == ("CHF", 7.0)
    assert [t.position for t in FULL_LAYOUT][-1] == 39 and [t.position for t in SHORT_LAYOUT][-1] == 21


def test_line_order_over_files_and_splits(spark):
    """The last line of a code wins though the file comes in many splits and is one of several."""
    path = session.new_folder(spark, "order")
    rows = spark.range(6000).selectExpr("id", "concat('K', id % 7, ';x;ReferenceRate;2015-01-01;', id) AS value")
    rows.coalesce(1).sortWithinPartitions("id").select("value").write.text(path)
    later = spark.range(6000, 6003).selectExpr("concat('K', id % 7, ';x;ReferenceRate;2015-01-01;', id) AS value")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = read_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 5
        last = {r["code"]: r["values"] for r in last_per_code(parse_market(lines)).collect()}
        assert last == {f"K{n % 7}": [float(n)] for n in range(5993, 6000)}
        later.coalesce(1).write.mode("append").text(path)
        names = sorted(r["f"] for r in spark.read.text(path).selectExpr("_metadata.file_name AS f").distinct().collect())
        first = read_lines(spark, path).orderBy("place").first()["place"]["file"]
        assert first.endswith(names[0])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_last_per_code_with_one_code_holding_most_lines(spark):
    hot = spark.range(0, 30000, 1, 8).selectExpr(
        "if(id % 3 = 0, concat('C', id % 50), 'HOT') AS code", "id AS place", "id AS payload"
    )
    last = {r["code"]: r["payload"] for r in last_per_code(hot).collect()}
    assert last["HOT"] == 29999 and len(last) == 51 and all(v >= 29850 for v in last.values())


MARKET = [
    "A;x;ReferenceRate;2015-03-10!2015-01-05!2015-01-20!2015-01-20;3!1!2!2.5",
    "B;x;TermStructure;1Y!6M;0.02!0.01",
    "D;x;ForeignExchangeRate;2015-01-01T00;1.1",
    "E;x;ReferenceRate;NULL;NULL",
    "F;x;ReferenceRate;2015-01-01!bad;1!2",
    "G;x;ReferenceRate;2015-01-01!2015-02-01;1",
    "H;x;TermStructure;1Y!6M;0.02!n/a",
]


def test_as_of(spark):
    market = last_per_code(parse_market(lines_from(spark, MARKET)))
    days = ["2014-12-31", "2015-01-04", "2015-01-05", "2015-01-19", "2015-01-20", "2015-02-28", "2015-03-09", "2015-03-10", "2030-01-01"]
    probes = spark.createDataFrame([(c, d) for c in ("A", "B", "E", "F", "G", "Z") for d in days], "code string, day string")
    probes = probes.selectExpr("code", "cast(day AS date) AS day")
    for limit in (1 << 20, 0):
        got = asof_join(probes, market, "code", "day", "v", limit).orderBy("code", "day").collect()
        assert [r["v"] for r in got[:9]] == [None, None, 1, 1, 2.5, 2.5, 2.5, 3, 3]
        assert {r["v"] for r in got[9:]} == {None}


def test_curve(spark):
    market = last_per_code(parse_market(lines_from(spark, MARKET)))
    probes = spark.createDataFrame([("B", float(y)) for y in (0, 0.5, 0.75, 1, 9)] + [("A", 1.0), ("H", 1.0)], "c string, y double")
    for limit in (1 << 20, 0):
        got = interpolate(probes, market, {"c": "code"}, "y", "r", limit).orderBy("c", "y").collect()
        assert [r["r"] for r in got] == [None, 0.01, 0.01, pytest.approx(0.015), 0.02, 0.02, None]


def test_points_by_kind(spark):
    market = last_per_code(parse_market(lines_from(spark, MARKET)))
    assert {r["code"] for r in dated_points(market, "ForeignExchangeRate").collect()} == {"D"}
    assert [(r["tenor"], r["years"]) for r in curve_points(market.where("code = 'B'")).orderBy("years").collect()] == [("6M", 0.5), ("1Y", 1.0)]
    moved = in_scenarios(market, {"base": 0.0, "up": 1.0}).where("code IN ('B', 'D')").collect()
    assert {(r["code"], r["scenario"]): r["values"][0] for r in moved} == {
        ("B", "base"): 0.02, ("B", "up"): 1.02, ("D", "base"): 1.1, ("D", "up"): 1.1,
    }


def test_large_market_gives_the_same_events(spark, small):
    """Beyond the broadcast bound the lookups turn to sort-merge joins, with the same result."""
    market = market_table(spark, small, scenarios=True)
    contracts = parse_contracts(contract_lines(spark, small, portfolio=True), FULL_LAYOUT, keep=["portfolio"])
    assert fits_broadcast(market) and not fits_broadcast(market, 100)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        merged = evaluate(contracts, BEFORE_ALL, market, list(SHIFTS), limit=0)
        plan = merged._jdf.queryExecution().toString()
        assert "SortMergeJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
        large = flat_events(merged, keep=("scenario",)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    broadcast = flat_events(evaluate(contracts, BEFORE_ALL, market, list(SHIFTS)), keep=("scenario",)).collect()
    assert sorted(map(str, large)) == sorted(map(str, broadcast)) and len(large) > 3000


def test_rows_without_a_key_stay_where_they_are(spark, small):
    """Beyond the broadcast bound: hot keys in several groups, rows without a key in no join."""
    rows = spark.range(0, 5000, 1, 4).selectExpr("id", "CASE WHEN id % 4 = 0 THEN NULL WHEN id % 3 = 0 THEN 'HOT' ELSE concat('K', id % 50) END AS code")
    table = spark.range(40).selectExpr("concat('K', id) AS code", "id AS v").unionByName(spark.sql("SELECT 'HOT' AS code, 99L AS v"))
    merged = lookup(rows, table, ["code"], limit=0, hot_rows=100)
    assert merged.columns == ["code", "id", "v"] or set(merged.columns) == {"id", "code", "v"}
    plain = lookup(rows, table, ["code"])
    key = lambda r: (r["id"], str(r["code"]), str(r["v"]))
    assert sorted(map(key, merged.collect())) == sorted(map(key, plain.collect()))
    keyed, unkeyed = (merged._jdf.queryExecution().optimizedPlan().children().apply(i).toString() for i in (0, 1))
    assert "Join" in keyed and "Join" not in unkeyed and "Aggregate" not in unkeyed


def test_scenarios_must_be_known(spark):
    contracts = parse_contracts(lines_from(spark, [contract_line(FULL_LAYOUT, contract_id="C")]))
    market = last_per_code(parse_market(lines_from(spark, MARKET)))
    with pytest.raises(ValueError, match="without scenarios"):
        evaluate(contracts, BEFORE_ALL, market, ["up"])
    shifted = in_scenarios(market, {"base": 0.0, "up": 1.0})
    with pytest.raises(Exception, match="no market data for scenario sideways"):
        evaluate(contracts, BEFORE_ALL, shifted, ["up", "sideways"]).collect()


def test_event_records_of_a_plain_market(spark, small):
    market = market_table(spark, small)
    contracts = parse_contracts(contract_lines(spark, small, portfolio=True), FULL_LAYOUT, keep=["portfolio"])
    records = event_records(evaluate(contracts, BEFORE_ALL, market), market, DISCOUNT_CURVE)
    assert {r[0] for r in records.select("riskScenario").distinct().collect()} == {"base"}
    assert records.where("discount IS NULL").count() == 0
    assert "NestedLoop" not in plan_of(records)


def test_declared_schema_is_asserted(spark):
    rows = spark.sql("SELECT 'C' AS id, '2015-01-01' AS date, 'IP' AS type, 'EUR' AS currency, 1D AS value, 2D AS nominal, 3D AS accrued, 4 AS other")
    out = declared(rows, EVENT_SCHEMA)
    assert out.schema == EVENT_SCHEMA and out.count() == 1
    with pytest.raises(Exception, match="value is null"):
        declared(rows.withColumn("value", F.lit(None).cast("double")), EVENT_SCHEMA).collect()
    with pytest.raises(PySparkException):
        declared(rows.drop("value"), EVENT_SCHEMA)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_evaluation_needs_no_shuffle(spark, small):
    """Contract rows are never moved; market data come by broadcast."""
    path = session.new_folder(spark, "contracts")
    contract_lines(spark, small).write.text(path)
    market = market_table(spark, small)
    events = flat_events(evaluate(parse_contracts(read_lines(spark, path)), BEFORE_ALL, market))
    exchanges = [line for line in plan_of(events).splitlines() if "Exchange" in line]
    # the single partition is that of the scenario names, in a subquery
    assert exchanges and all("BroadcastExchange" in line or "SinglePartition" in line for line in exchanges)
    assert "Window" not in plan_of(events) and "Python" not in plan_of(events)


def test_series_pass_the_join_once_per_contract(spark, small):
    market = market_table(spark, small)
    contracts = parse_contracts(contract_lines(spark, small))
    found = with_reset_object(contracts, market)
    assert found.count() == contracts.count()


def test_event_records(spark, small):
    market = market_table(spark, small, scenarios=True)
    contracts = parse_contracts(contract_lines(spark, small, portfolio=True), FULL_LAYOUT, keep=["portfolio"])
    records = event_records(evaluate(contracts, BEFORE_ALL, market, list(SHIFTS)), market, DISCOUNT_CURVE)
    assert records.columns == [
        "riskScenario", "portfolio", "id", "date", "type", "currency", "value", "nominal", "accrued", "discount",
    ]
    bounds = records.groupBy("riskScenario").agg(F.min("discount"), F.max("discount"), F.count("*")).collect()
    assert {r[0] for r in bounds} == set(SHIFTS) and len({r[3] for r in bounds}) == 1
    assert all(0 < r[1] < r[2] <= 1.1 for r in bounds)


def test_analysis_date(spark):
    contracts = spark.createDataFrame([("C",)], "contract_id string")
    dated = first_date(lines_from(spark, ["2015-04-01T00;x", "1999-01-01"]))
    for t0 in ("2015-04-01T00", dated):
        assert with_analysis_date(contracts, t0).first()["t0"].isoformat() == "2015-04-01"
    for wrong in ("tomorrow", first_date(lines_from(spark, ["tomorrow;x"])), first_date(lines_from(spark, ["x"]).limit(0))):
        with pytest.raises(Exception, match="not an analysis date"):
            with_analysis_date(contracts, wrong).collect()


def test_sinks(spark):
    rows = spark.createDataFrame([(1, [1.5, 2.5], "a,b"), (2, [], None)], "id int, amounts array<double>, note string")
    path = session.new_folder(spark, "text")
    write_text_rows(rows, path)
    assert read_text_rows(spark, path, "id int, amounts array<double>, note string").orderBy("id").collect() == rows.collect()
    flat = rows.select("id", "note")
    folder = session.new_folder(spark, "csv")
    append_csv(flat, folder)
    append_csv(flat, folder)
    back = read_csv(spark, folder, "id int, note string").orderBy("id").collect()
    assert [tuple(r) for r in back] == [(1, "a,b"), (1, "a,b"), (2, None), (2, None)]
    with pytest.raises(PySparkException):
        append_csv(rows, folder)


def test_catalog(spark):
    location = session.new_folder(spark, "days")
    create_table(spark, "days_test", "id INT, datum STRING", location)
    create_table(spark, "days_test", "id INT, datum STRING", location)
    insert_rows(spark.sql("VALUES (1, '09.09.2016')"), "days_test")
    insert_rows(spark.sql("VALUES (2, '10.09.2016')"), "days_test")
    assert {tuple(r) for r in select_all(spark, "days_test").collect()} == {(1, "09.09.2016"), (2, "10.09.2016")}
    kept = select_all(spark, "days_test")
    drop_table(spark, "days_test")
    assert kept.count() == 2 and not spark.catalog.tableExists("days_test")


def test_run_log(spark):
    path = session.new_folder(spark, "runs")
    fields = "class_name string, output string, ram string, contracts int, risk_factors int, nodes int, run int"
    run = spark.createDataFrame([("events", "parquet", "4g", 10, 2, 3, 1, 100, 350)], f"{fields}, start long, stop long")
    append_runs(run, path)
    append_runs(run, path)
    assert [tuple(r) for r in read_runs(spark, path).collect()] == [("events", "parquet", "4g", "10", "2", "3", "1", 250)] * 2


def test_tokens(spark):
    lines = lines_from(spark, ["spark rdd example", "sample example", "   ", ""])
    assert lines.rdd.getNumPartitions() == 2
    arrays = {r["value"]: r["tokens"] for r in token_arrays(lines, "value").collect()}
    assert arrays["sample example"] == ["sample", "example"] and arrays["   "] == [] and arrays[""] == [""]
    assert token_rows(lines, "value").count() == 6
    assert {r["token"]: r["n"] for r in token_counts(lines, "value").collect()}["example"] == 2


def test_hit_ratio_of_random_points(spark):
    points = random_points(spark, slices=3)
    assert points.rdd.getNumPartitions() == 3
    row = hit_ratio(points).first()
    assert row["n"] == 300_000 and row["ratio"] == pytest.approx(math.pi, abs=0.02)
    assert row == hit_ratio(random_points(spark, slices=3)).first()


def test_shared_folder(spark):
    assert session.new_folder(spark, "x") != session.new_folder(spark, "x")
    assert spark.sparkContext.getCheckpointDir() is not None
    assert session.materialised(spark.range(3)).count() == 3


def test_spread_moves_only_small_inputs(spark, small):
    rows = spark.read.parquet(f"{small}/orders.parquet")
    assert session.spread(rows).rdd.getNumPartitions() == 4
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    try:
        assert "Exchange" not in plan_of(session.spread(spark.read.parquet(f"{small}/orders.parquet")))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
