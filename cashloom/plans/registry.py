"""The registered queries. Each takes a session and a folder of test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashloom.functions import numbers, quoted, quoted_list
from cashloom.functions.cycles import parse_cycle
from cashloom.functions.daycount import ACTUAL_360, ACTUAL_365, ACTUAL_ACTUAL, THIRTY_E_360, year_fraction
from cashloom.functions.text import date_text
from cashloom.operators.asof import as_of, asof_join, with_series
from cashloom.operators import states
from cashloom.operators.curve import interpolate
from cashloom.operators.hits import hit_ratio, spread_points
from cashloom.operators.intervals import interval_join
from cashloom.operators.lookup import reset_status, scaling_status, with_reset_object, with_scaling_object
from cashloom.operators.schedule import event_name, role_sign
from cashloom.operators.splits import asof_rows
from cashloom.operators.states import event_rows, flat_events, nested_events, regrouped
from cashloom.operators.tokens import token_arrays, token_counts
from cashloom.plans import job, scenarios
from cashloom.plans.pam import discounted, evaluate, event_records
from cashloom.plans.rows import evaluate_rows
from cashloom.plans.testdata import (
    BEFORE_ALL,
    DISCOUNT_CURVE,
    MIDWAY,
    SHIFTS,
    contract_lines,
    market_lines,
    market_table,
    part_market,
    part_market_lines,
    scenario_table,
    short_contract_lines,
    table,
)
from cashloom.session import configure, drop_folder, materialised, new_folder, spread, stored, stored_at
from cashloom.sources.analysis_date import first_date, with_analysis_date
from cashloom.sources.batches import append_once, read_batches, written
from cashloom.sources.catalog import create_table, drop_table, insert_rows, select_all
from cashloom.sources.contracts import KEEP_GOOD, TRUNCATE, parse_contracts
from cashloom.sources.layouts import DATE, FULL_LAYOUT, SHORT_LAYOUT, Term
from cashloom.sources.lines import read_lines
from cashloom.sources.market import curve_points, dated_points, last_per_code, lines_of, parse_market
from cashloom.sources.runlog import append_runs, read_runs
from cashloom.sources.sinks import append_csv, read_csv, read_text_rows, write_text_rows
from cashloom.sources.stored import drop_stored, lookup_stored, store_by_code

Query = Callable[[SparkSession, str], DataFrame]

MONEY_DIGITS = 4
RATE_DIGITS = 10
FACTOR_DIGITS = 8
# For comparison only: an exact half can come out of the arithmetic a little below itself. In units
# of the last digit, some ten times what sums of a few hundred amounts are off.
COMPARISON_TOLERANCE = 1e-5
# Fewer units than these come out of dividing and multiplying again as they were.
WHOLE_UNITS = float(1 << 50)

NESTED_SCHEMA = (
    "id array<string>, date array<string>, type array<string>, currency array<string>, "
    "value array<double>, nominal array<double>, accrued array<double>"
)
FLAT_SCHEMA = "id string, date string, type string, currency string, value double, nominal double, accrued double"


def half_up(value: str, digits: int) -> str:
    """``value`` rounded so that it can be compared with what another engine computed."""
    return numbers.half_up(value, digits, COMPARISON_TOLERANCE)


def units(value: str, digits: int) -> str:
    """The rounded value in units of its last digit, as text; a value without such a unit as it is.

    Up to ``WHOLE_UNITS`` the units are counted as a whole number, beyond by way of the rounded value.
    """
    counted = f"floor(({value}) * 1e{digits}D + {0.5 + COMPARISON_TOLERANCE!r}D)"
    whole = f"try_cast(({half_up(value, digits)}) * 1e{digits}D AS decimal(38, 0))"
    text = f"coalesce(cast({whole} AS string), cast({value} AS string))"
    return f"CASE WHEN abs({value}) < {WHOLE_UNITS / 10**digits!r}D THEN cast({counted} AS string) ELSE {text} END"


def _money(*names: str) -> list[str]:
    return [f"{half_up(name, MONEY_DIGITS)} AS {name}" for name in names]


def _parsed(contracts: DataFrame, layout: list[Term]) -> DataFrame:
    columns = [f"{date_text(t.name)} AS {t.name}" if t.kind == DATE else t.name for t in layout]
    return contracts.selectExpr(*columns, "array_join(term_errors, ',') AS term_errors")


def _full_contracts(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    keep = ["portfolio"] if options.get("portfolio") else []
    return parse_contracts(contract_lines(spark, sf_dir, **options), FULL_LAYOUT, keep=keep)


def _short_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_contracts(short_contract_lines(spark, sf_dir), SHORT_LAYOUT)


def _event_table(events: DataFrame) -> DataFrame:
    amounts = _money("value", "nominal", "accrued")
    return events.selectExpr("contract_id", f"{date_text('date')} AS date", "type", "currency", *amounts)


# --- reading ---------------------------------------------------------------------------------


def contract_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract lines through a text file and back to typed terms."""
    path = new_folder(spark, "contracts")
    contract_lines(spark, sf_dir).write.text(path)
    return _parsed(parse_contracts(read_lines(spark, path), FULL_LAYOUT), FULL_LAYOUT)


def contract_parse_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(_short_contracts(spark, sf_dir), SHORT_LAYOUT)


def contract_parse_truncating(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = contract_lines(spark, sf_dir, spoiled=True)
    return _parsed(parse_contracts(lines, FULL_LAYOUT, on_error=TRUNCATE), FULL_LAYOUT)


def analysis_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line of a file of order days, attached to every contract."""
    path = new_folder(spark, "days")
    days = table(spark, sf_dir, "orders").selectExpr("cast(o_orderdate AS date) AS day").distinct()
    days.orderBy("day").selectExpr("concat(cast(day AS string), 'T00;x') AS value").write.text(path)
    dated = with_analysis_date(_short_contracts(spark, sf_dir), first_date(read_lines(spark, path)))
    return dated.selectExpr(
        "contract_id", f"{date_text('t0')} AS t0", "cast(t0 >= initial_exchange_date AS int) AS running"
    )


def riskfactor_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market lines through a text file, repeated codes included."""
    return _object_summary(parse_market(_market_file(spark, sf_dir)))


def riskfactor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _object_summary(last_per_code(parse_market(_market_file(spark, sf_dir))))


def _market_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "market")
    market_lines(spark, sf_dir).orderBy("place").select("value").write.text(path)
    return read_lines(spark, path)


def _object_summary(market: DataFrame) -> DataFrame:
    return market.selectExpr(
        "code",
        "kind",
        "size(points) AS n_points",
        "get(points, 0) AS first_point",
        "get(points, size(points) - 1) AS last_point",
        "aggregate(values, 0L, (total, v) -> total + cast(v * 1e6D + 0.5D AS bigint)) AS total_micro",
    )


def riskfactor_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    market = market_table(spark, sf_dir)
    dated = dated_points(market).selectExpr("code", "kind", f"{date_text('date')} AS point", "value")
    curves = curve_points(market).selectExpr("code", "kind", "tenor AS point", "value")
    return dated.unionByName(curves)


# Cycle texts that almost are one, or are longer than any calendar.
ODD_CYCLES = ["3 M -", "3 X -", "999999999Y", "200000000M", "9999999999D", "99999999999999999999D", "", "-3M"]


# --- terms -----------------------------------------------------------------------------------


def cycle_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cycle texts of every form, malformed ones included, by order key."""

    def pick(every: int, *texts: str) -> str:
        return f"element_at(array({quoted_list(texts)}), cast(o_orderkey div {every} % {len(texts)} AS int) + 1)"

    prefix, unit = pick(2, "", "P"), pick(3, "D", "W", "M", "Q", "H", "Y", "X")
    stub = pick(5, "", "-", "+", "L0", "L1", "L2")
    orders = table(spark, sf_dir, "orders")
    plain = f"concat({prefix}, o_orderkey % 13, {unit}, {stub})"
    texts = orders.selectExpr("o_orderkey", f"if(o_orderkey % 19 = 0, {pick(19, *ODD_CYCLES)}, {plain}) AS cycle")
    steps = texts.selectExpr("*", f"{parse_cycle('cycle')} AS step")
    return steps.selectExpr(
        "o_orderkey", "cycle", "step.months", "step.days", "cast(step.long_stub AS int) AS long_stub"
    )


def contract_sign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order status stands in for the role, one of the three being no role at all."""
    role = "CASE o_orderstatus WHEN 'F' THEN 'RPA' WHEN 'P' THEN 'RPL' ELSE 'BUY' END AS role"
    signed = table(spark, sf_dir, "orders").selectExpr("o_orderkey", role).selectExpr("*", f"{role_sign('role')} AS sign")
    return signed.selectExpr("*", "cast(sign IS NULL AS int) AS unknown")


def day_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year fractions from the ship date over a span of up to 2000 days, by every convention."""
    start = "cast(l_shipdate AS date)"
    end = f"date_add({start}, cast(l_orderkey % 2000 AS int))"
    spans = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{start} AS a", f"{end} AS b")
    names = {"a365": ACTUAL_365, "a360": ACTUAL_360, "e30360": THIRTY_E_360, "aa": ACTUAL_ACTUAL}
    return spans.selectExpr(
        "l_orderkey",
        "l_linenumber",
        f"{date_text('a')} AS a",
        f"{date_text('b')} AS b",
        *[f"{half_up(year_fraction('a', 'b', quoted(c)), RATE_DIGITS)} AS {n}" for n, c in names.items()],
    )


# --- market lookups --------------------------------------------------------------------------


def rf_lookup_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_reset_object(_full_contracts(spark, sf_dir), market_table(spark, sf_dir))
    return found.selectExpr("contract_id", "reset_code", "reset_kind", "coalesce(size(reset_points), 0) AS n_points")


def rf_lookup_scaling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scaling index found and its value at the initial exchange over the one agreed."""
    market = market_table(spark, sf_dir)
    found = with_scaling_object(_full_contracts(spark, sf_dir), market)
    valued = asof_join(found, market, "scaling_code", "initial_exchange_date", "index_value")
    return valued.selectExpr(
        "contract_id",
        "scaling_code",
        "scaling_kind",
        "coalesce(size(scaling_points), 0) AS n_points",
        f"{half_up('index_value / scaling_index', FACTOR_DIGITS)} AS index_ratio",
    )


def rf_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup outcomes with codes that also point at the wrong kind of object.

    A contract's scaling code, where it has one, takes the place of its reset code and the reset
    code that of the scaling code.
    """
    contracts = _full_contracts(spark, sf_dir).selectExpr(
        "contract_id", "coalesce(scaling_code, reset_code) AS reset_code", "reset_code AS scaling_code"
    )
    market = market_table(spark, sf_dir)
    found = with_scaling_object(with_reset_object(contracts, market), market)
    return found.selectExpr(
        "contract_id", f"{reset_status()} AS reset_status", f"{scaling_status()} AS scaling_status"
    )


def rf_lookup_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate of the part that an order is given, by broadcast and by the join for markets beyond it.

    A third of the orders have one part, a fifth have none.
    """
    part = "CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'PRT_1' ELSE concat('PRT_', o_custkey) END"
    probes = spread(table(spark, sf_dir, "orders"), "o_orderkey").selectExpr(
        "o_orderkey", f"{part} AS code", "add_months(cast(o_orderdate AS date), 12) AS date"
    )
    market = stored(part_market(spark, sf_dir), "part_market")  # looked at by each of the ways
    broadcast = asof_join(probes, market, "code", "date", "rate").withColumn("way", F.lit("broadcast"))
    merged = asof_join(probes, market, "code", "date", "rate", limit=0, hot_rows=500).withColumn("way", F.lit("merged"))
    return broadcast.unionByName(merged).selectExpr("way", "o_orderkey", "code", f"{date_text('date')} AS date", "rate")


def _part_probes(spark: SparkSession, sf_dir: str, part: str) -> DataFrame:
    return spread(table(spark, sf_dir, "orders"), "o_orderkey").selectExpr(
        "o_orderkey", f"{part} AS code", "add_months(cast(o_orderdate AS date), 12) AS date"
    )


def lookup_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and rates of parts stored by code in buckets, and joined without moving either.

    A third of the orders have one part, a fifth have none: these lie apart.
    """
    part = "CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'PRT_1' ELSE concat('PRT_', o_custkey) END"
    location = new_folder(spark, "by_code")
    probes, objects = (f"{location.rsplit('/', 1)[1].replace('-', '_')}_{n}" for n in ("probes", "objects"))
    store_by_code(_part_probes(spark, sf_dir, part), "code", probes, f"{location}/probes", buckets=8, hot_rows=500)
    series = with_series(part_market(spark, sf_dir)).select("code", "series")
    store_by_code(series, "code", objects, f"{location}/objects", buckets=8)
    found = lookup_stored(spark, probes, objects, "code")
    rated = found.selectExpr("o_orderkey", "code", f"{date_text('date')} AS date", f"{as_of('series', 'date')} AS rate")
    for name in (probes, objects):
        drop_stored(spark, name)  # the rows stay readable: they lie in the folder of this run
    return rated


def lookup_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates for orders that use a few parts' series of a file, whose other lines are never parsed."""
    path = new_folder(spark, "parts")
    part_market_lines(spark, sf_dir).write.text(path)
    probes = _part_probes(spark, sf_dir, "concat('PRT_', 100 * (o_custkey % 20) + 1)")
    used = materialised(lines_of(read_lines(spark, path), probes.select("code")))
    market = last_per_code(parse_market(used))
    parsed = used.agg(F.count(F.lit(1)).alias("n")).scalar()
    found = asof_join(probes, market, "code", "date", "rate")
    return found.select("o_orderkey", "code", F.expr(date_text("date")).alias("date"), "rate", parsed.alias("lines_parsed"))


def rate_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference rate per order at dates from before the first observation to after the last."""
    probes = spread(table(spark, sf_dir, "orders"), "o_orderkey").selectExpr(
        "o_orderkey",
        "if(o_orderkey % 17 = 0, 'MISSING', concat('REF_', o_orderkey % 5)) AS code",
        "add_months(cast(o_orderdate AS date), cast(6 * (o_orderkey % 20) - 12 AS int)) AS date",
    )
    found = asof_join(probes, market_table(spark, sf_dir), "code", "date", "rate")
    return found.selectExpr("o_orderkey", "code", f"{date_text('date')} AS date", "rate")


def curve_interpolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A curve rate per order at terms from zero days to twelve years."""
    probes = spread(table(spark, sf_dir, "orders"), "o_orderkey").selectExpr(
        "o_orderkey", "concat('CRV_', o_orderkey % 5) AS curve", "o_orderkey % 4380 AS days"
    )
    found = interpolate(probes, market_table(spark, sf_dir), {"curve": "code"}, "days / 365D", "rate")
    return found.selectExpr("o_orderkey", "curve", "days", f"{half_up('rate', RATE_DIGITS)} AS rate")


# The next of these is what an event asks for.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def asof_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every event the last earlier value of its user's events of the next type; keys are cut at 400 rows."""
    asked = f"element_at(array({quoted_list(EVENT_TYPES)}), cast(array_position(array({quoted_list(EVENT_TYPES)}), event_type) % 5 AS int) + 1)"
    seconds = "unix_date(cast(ts AS date)) * 86400L + hour(ts) * 3600 + minute(ts) * 60"  # of no time zone
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "event_type", "value", f"({seconds}) * 1000000 + cast(extract(SECOND FROM ts) * 1000000 AS bigint) AS micros"
    )
    probes = events.selectExpr("event_id", "user_id", "micros", f"{asked} AS asked")
    seen = events.selectExpr("user_id", "event_type AS asked", "micros", "value AS earlier_value")
    found = asof_rows(probes, seen, ["user_id", "asked"], "micros", ["earlier_value"], strict=True, hot_rows=400)
    return found.select("event_id", "user_id", "asked", "earlier_value")


def period_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interest period of each line item's order that its ship date falls into."""
    scheduled = evaluate(_short_contracts(spark, sf_dir), BEFORE_ALL)
    bounds = "concat(array(initial_exchange_date), interest_dates)"
    periods = scheduled.selectExpr(
        "cast(substring(contract_id, 3) AS bigint) AS l_orderkey",
        f"explode_outer(transform({bounds}, (d, i) -> struct(unix_date(d) AS lo, unix_date(get({bounds}, i + 1)) AS hi))) AS p",
    ).selectExpr("l_orderkey", "cast(p.lo AS bigint) AS lo", "cast(p.hi AS bigint) AS hi")
    shipped = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "cast(unix_date(cast(l_shipdate AS date)) AS bigint) AS day"
    )
    found = interval_join(shipped, periods, ["l_orderkey"], "day", "lo", "hi", width=28)

    def text(day: str) -> str:
        return f"{date_text(f'date_from_unix_date(cast({day} AS int))')}"

    return found.selectExpr(
        "l_orderkey", "l_linenumber", f"{text('day')} AS shipped", f"{text('lo')} AS period_start", f"{text('hi')} AS period_end"
    )


# --- contract evaluation ---------------------------------------------------------------------


def pam_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = event_rows(evaluate(_full_contracts(spark, sf_dir), BEFORE_ALL))
    return rows.selectExpr("contract_id", f"{date_text('date')} AS date", f"{event_name('kind')} AS type")


def pam_rate_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate from every reset on, resets without an observation included."""
    evaluated = evaluate(_full_contracts(spark, sf_dir), BEFORE_ALL, market_table(spark, sf_dir))
    resets = flat_events(evaluated, keep=("reset_status",)).where("type IN ('RR', 'RRF')")
    rate = f"{half_up('rate', RATE_DIGITS)} AS rate"
    return resets.selectExpr("contract_id", f"{date_text('date')} AS date", "type", rate, "reset_status")


def pam_events_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_table(flat_events(evaluate(_short_contracts(spark, sf_dir), BEFORE_ALL)))


def pam_events_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts seen from the middle of their lives."""
    return _event_table(flat_events(evaluate(_short_contracts(spark, sf_dir), MIDWAY)))


def pam_events_floating(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluated = evaluate(_full_contracts(spark, sf_dir), MIDWAY, market_table(spark, sf_dir))
    return _event_table(flat_events(evaluated))


def states_from_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of ``pam_events_floating`` from rows alone; contracts are cut at 30 events."""
    events = evaluate_rows(_full_contracts(spark, sf_dir), MIDWAY, market_table(spark, sf_dir), hot_rows=30)
    return _event_table(events)


def pam_purchase_termination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_table(flat_events(evaluate(_full_contracts(spark, sf_dir), BEFORE_ALL)))


def discount_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factor of every maturity date in every scenario, seen from the middle of the contracts' lives."""
    contracts = with_analysis_date(_short_contracts(spark, sf_dir), MIDWAY)
    ahead = contracts.where("maturity_date > t0").selectExpr(
        "contract_id", "t0", "maturity_date AS date", f"explode(array({quoted_list(SHIFTS)})) AS scenario"
    )
    factors = discounted(ahead, market_table(spark, sf_dir, scenarios=True), DISCOUNT_CURVE)
    factor = half_up("discount", FACTOR_DIGITS)
    return factors.selectExpr("contract_id", "scenario", f"{date_text('date')} AS date", f"{factor} AS discount")


# --- shapes and sinks ------------------------------------------------------------------------


def _floating_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluated = evaluate(_full_contracts(spark, sf_dir), BEFORE_ALL, market_table(spark, sf_dir))
    return nested_events(evaluated)


def _nested_table(nested: DataFrame) -> DataFrame:
    def amounts(name: str) -> str:
        return f"array_join(transform({name}, v -> {units('v', MONEY_DIGITS)}), '|') AS {name}"

    return nested.selectExpr(
        *[f"array_join({name}, '|') AS {name}" for name in ("id", "date", "type", "currency")],
        *[amounts(name) for name in ("value", "nominal", "accrued")],
    )


def event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states.event_counts(evaluate(_short_contracts(spark, sf_dir), MIDWAY))


def events_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nested_table(_floating_nested(spark, sf_dir))


def events_regrouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``events_nested`` out of a file of flat events, which keeps a number for each contract."""
    numbered = materialised(_full_contracts(spark, sf_dir).withColumn("contract", F.monotonically_increasing_id()))
    evaluated = evaluate(numbered, BEFORE_ALL, market_table(spark, sf_dir))
    path = new_folder(spark, "flat")
    flat_events(evaluated, keep=("contract",)).write.parquet(path)
    events = spark.read.parquet(path).withColumnRenamed("date", "on").selectExpr(
        "*", "contract_id AS id", f"{date_text('`on`')} AS date", "cast(unix_date(`on`) AS bigint) AS day"
    )
    columns = ["id", "date", "type", "currency", "value", "nominal", "accrued"]
    return _nested_table(regrouped(events, ["contract"], columns, ["day", "kind"], "day"))


def events_spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row of status for every line of a file with faults, under both fault policies."""

    def judged(policy: str) -> DataFrame:
        contracts = parse_contracts(contract_lines(spark, sf_dir, faults=True), FULL_LAYOUT, on_error=policy)
        counted = states.event_counts(evaluate(contracts, BEFORE_ALL), keep=("contract_status",))
        return counted.withColumn("policy", F.lit(policy))

    return judged(KEEP_GOOD).unionByName(judged(TRUNCATE))


def _job(spark: SparkSession, sf_dir: str, **options) -> tuple[DataFrame, DataFrame]:
    """Contracts, market data and analysis date through files, and the two tables out of them."""
    paths = {name: new_folder(spark, name) for name in ("contracts", "market", "date", "events", "statuses")}
    contract_lines(spark, sf_dir, **options).write.text(paths["contracts"])
    market = materialised(market_lines(spark, sf_dir))  # or a sort would work it out twice, for its ranges and its rows
    market.orderBy("place").select("value").write.text(paths["market"])
    days = table(spark, sf_dir, "orders").selectExpr(f"concat({quoted(MIDWAY)}, 'T00;', max(o_orderkey)) AS value")
    days.write.text(paths["date"])
    job.events_from_files(spark, **paths)
    events = spark.read.parquet(paths["events"]).withColumnRenamed("id", "contract_id")
    rounded = events.selectExpr("contract_id", "date", "type", "currency", *_money("value", "nominal", "accrued"))
    return rounded, spark.read.parquet(paths["statuses"]).withColumnRenamed("id", "contract_id")


def events_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts, market data and analysis date through files, and the events out of one."""
    return _job(spark, sf_dir)[0]


def events_from_faulty_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file with every fault: the events of the contracts without one, and a status of every line."""
    events, statuses = _job(spark, sf_dir, faults=True)
    told = statuses.select(F.lit("status").alias("record"), "contract_id", "contract_status", "n_events")
    return events.select(F.lit("event").alias("record"), "*").unionByName(told, allowMissingColumns=True)


def events_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event of every contract in every scenario, with portfolio and discount factor."""
    contracts = _full_contracts(spark, sf_dir, portfolio=True)
    market = market_table(spark, sf_dir, scenarios=True)
    records = event_records(evaluate(contracts, BEFORE_ALL, market, list(SHIFTS)), market, DISCOUNT_CURVE)
    return records.selectExpr(
        "riskScenario",
        "portfolio",
        "id",
        "date",
        "type",
        "currency",
        *_money("value", "nominal", "accrued"),
        f"{half_up('discount', FACTOR_DIGITS)} AS discount",
    )


def scenario_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and their total value, in thousands, by currency in each of 200 scenarios."""
    contracts, market = _full_contracts(spark, sf_dir), market_table(spark, sf_dir)
    totals = scenarios.scenario_values(contracts, MIDWAY, market, scenario_table(spark, sf_dir), ("currency",))
    return totals.selectExpr("scenario", "currency", "n_events", "cast(floor(total / 1000D + 0.5D) AS bigint) AS thousands")


def events_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested events written as text lines, one per contract, and read back."""
    path = new_folder(spark, "events-text")
    write_text_rows(_floating_nested(spark, sf_dir), path)
    return _nested_table(read_text_rows(spark, path, NESTED_SCHEMA))


def _csv_events(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Flat events as CSV takes them, evaluated once for all that is appended and stored in the folder."""
    events = flat_events(evaluate(_short_contracts(spark, sf_dir), BEFORE_ALL))
    named = events.selectExpr("contract_id AS id", f"{date_text('date')} AS date", "type", "currency", "value", "nominal", "accrued")
    return stored_at(named, folder)


def csv_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat events appended to one CSV folder twice, so every event comes back twice."""
    path, staged = new_folder(spark, "events-csv"), new_folder(spark, "events")
    events = _csv_events(spark, sf_dir, staged)
    for _ in range(2):
        append_csv(events, path)
    drop_folder(spark, staged)
    return read_csv(spark, path, FLAT_SCHEMA).selectExpr(
        "id", "date", "type", "currency", *_money("value", "nominal", "accrued")
    )


def csv_append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat events appended by batches of a currency each, one of them twice; what is half written is not there."""
    folder, staged = new_folder(spark, "events-batches"), new_folder(spark, "events")
    events = _csv_events(spark, sf_dir, staged)
    written(events, folder, "EUR")
    for currency in ("EUR", "USD", "CHF", "EUR"):
        append_once(events.where(F.col("currency") == currency), folder, currency)
    drop_folder(spark, staged)
    return read_batches(spark, folder, FLAT_SCHEMA).selectExpr(
        "id", "date", "type", "currency", *_money("value", "nominal", "accrued")
    )


def catalog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys and their dates as text into a catalog table, and everything out of it."""
    location = new_folder(spark, "order_days")
    name = location.rsplit("/", 1)[1].replace("-", "_")
    create_table(spark, name, "id INT, datum STRING", location)
    orders = table(spark, sf_dir, "orders")
    insert_rows(orders.selectExpr("cast(o_orderkey AS int) AS id", "date_format(o_orderdate, 'dd.MM.yyyy') AS datum"), name)
    rows = select_all(spark, name)
    drop_table(spark, name)  # the rows stay readable: they lie in the folder of this run
    return rows


def run_log_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order priority: its contracts, and the days between its first and last."""
    path = new_folder(spark, "runs")
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderpriority AS run", "unix_date(cast(o_orderdate AS date)) AS day"
    )
    runs = orders.groupBy("run").agg(
        F.count("*").alias("contracts"), F.min("day").alias("start"), F.max("day").alias("stop")
    )
    codes = market_table(spark, sf_dir).agg(F.count("*").alias("n")).scalar()
    fixed = ["'events' AS class_name", "'parquet' AS output", "'4g' AS ram", "'8' AS nodes"]
    append_runs(runs.selectExpr("*", *fixed).withColumn("risk_factors", codes), path)
    return read_runs(spark, path)


# --- small operators -------------------------------------------------------------------------


def token_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document: how many, the second, and a digest of all in order."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = token_arrays(spread(documents, "doc_id"), "text")
    return lines.selectExpr(
        "doc_id",
        "size(tokens) AS n_tokens",
        "get(tokens, 1) AS second",
        "md5(cast(array_join(tokens, '|') AS binary)) AS digest",
    )


def token_flatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(spread(documents, "doc_id"), "text")


def monte_carlo_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per line item, placed by multiples of irrational numbers."""
    x = "(l_orderkey * 8 + l_linenumber) * 0.6180339887498949D"
    y = "(l_partkey * 8 + l_linenumber) * 0.41421356237309515D"
    return hit_ratio(spread_points(table(spark, sf_dir, "lineitem"), x, y))


ALL = [
    contract_parse,
    contract_parse_b,
    contract_parse_truncating,
    analysis_date,
    cycle_parse,
    contract_sign,
    day_count,
    riskfactor_parse,
    riskfactor_by_type,
    riskfactor_dedup,
    rf_lookup_reset,
    rf_lookup_scaling,
    rf_status,
    rf_lookup_large,
    lookup_bucketed,
    lookup_filtered,
    rate_asof,
    curve_interpolate,
    asof_events,
    period_lookup,
    pam_schedule,
    pam_rate_path,
    pam_events_fixed,
    pam_events_running,
    pam_events_floating,
    states_from_rows,
    pam_purchase_termination,
    event_counts,
    events_nested,
    events_regrouped,
    events_flat,
    scenario_values,
    events_spoiled,
    events_from_files,
    events_from_faulty_files,
    discount_factor,
    events_text_lines,
    csv_append_roundtrip,
    csv_append_once,
    catalog_roundtrip,
    run_log_table,
    token_map,
    token_flatmap,
    monte_carlo_ratio,
]


def queries() -> dict[str, Query]:
    return {query.__name__: _configured(query) for query in ALL}


def _configured(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run
