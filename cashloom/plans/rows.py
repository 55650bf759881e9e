"""Contract states from rows of events: the same values as from arrays, however long a contract is.

``plans.pam`` keeps a contract in one row, which suits contracts of up to some ten thousand events. Here each
event is a row from the start. The rate that a reset observes is an as-of join of rows, the rate in force
and the last date are carried along the rows, and what accrues is a running sum that begins anew after
every payment. Contracts of more than ``hot_rows`` events are cut, so that none is one task's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashloom.functions.cycles import tenor_years
from cashloom.functions.daycount import year_fraction
from cashloom.operators.asof import with_series
from cashloom.operators.curve import interpolate
from cashloom.operators.lookup import BROADCAST_BYTES, HOT_ROWS, lookup
from cashloom.operators.schedule import RR, RRF, event_kind, event_name, given_out, with_event_dates, with_schedule
from cashloom.operators.splits import asof_rows, with_last, with_running, with_splits
from cashloom.operators.states import CLEARING, RESETTING, accrued_after, event_value, nominal_after
from cashloom.session import materialised, stored
from cashloom.sources.analysis_date import with_analysis_date
from cashloom.sources.contracts import with_full_terms
from cashloom.sources.market import REFERENCE_RATE

# Terms that a reset's rate is made of, and all that a contract's events need.
RATE_TERMS = ["next_reset_rate", "reset_code", "rate_term", "rate_multiplier", "rate_spread"]
TERMS = [
    "contract", "contract_id", "currency", "day_count", "sign", "notional", "nominal_rate", "premium_discount",
    "purchase_price", "termination_price", "since", "purchased_on", *RATE_TERMS,
]


def schedule_rows(contracts: DataFrame, t0: str | DataFrame) -> DataFrame:
    """One row per event of the schedule, hidden ones included: the terms, ``date``, ``day`` and ``kind``.

    ``contract`` numbers the contracts, equal lines too; the rows are stored, so that the number stays.
    """
    numbered = materialised(with_analysis_date(with_full_terms(contracts), t0).withColumn("contract", F.monotonically_increasing_id()))
    dated = with_event_dates(with_schedule(numbered))
    rows = dated.selectExpr(*TERMS, "kind_ends", "posexplode_outer(event_dates) AS (position, date)").where("date IS NOT NULL")
    return rows.selectExpr(*TERMS, "date", "cast(unix_date(date) AS bigint) AS day", f"{event_kind('position')} AS kind")


def with_reset_rates(rows: DataFrame, market: DataFrame, hot_rows: int = HOT_ROWS, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Add ``set_rate``: what a reset fixes or observes; null where it observes nothing, and at other events.

    What is observed is the same for all resets of a code on a day, and is looked up once for them; a curve's rate once
    for a code and term. ``rows`` are read several times.
    """
    # only of objects that read as a whole; of two observations on one day the one further on counts
    series = with_series(market, (REFERENCE_RATE,)).where("series IS NOT NULL")
    points = series.selectExpr("code AS reset_code", "posexplode(arrays_zip(series.dates, series.values)) AS (place, point)").selectExpr(
        "reset_code", "cast(unix_date(point.dates) AS bigint) AS day", "place", "point.values AS seen"
    )
    observing = rows.where(f"kind = {RR} AND reset_code IS NOT NULL")
    asked = observing.select("reset_code", "day").distinct()
    seen = stored(asof_rows(asked, points, ["reset_code"], "day", ["place", "seen"], hot_rows=hot_rows).drop("place"), "seen")
    terms = observing.where("rate_term IS NOT NULL").select("reset_code", "rate_term").distinct()
    curves = stored(interpolate(terms, market, {"reset_code": "code"}, tenor_years("rate_term"), "curve_rate", limit), "curves")
    # events that observe nothing have no key, so that they are found nothing for and stay where they are
    keyed = rows.withColumn("__code", F.expr(f"if(kind = {RR}, reset_code, NULL)"))
    found = lookup(keyed, seen.withColumnRenamed("reset_code", "__code"), ["__code", "day"], limit)
    found = lookup(found, curves.withColumnRenamed("reset_code", "__code"), ["__code", "rate_term"], limit)
    rate = "coalesce(rate_multiplier, 1D) * coalesce(curve_rate, seen) + coalesce(rate_spread, 0D)"
    rated = found.withColumn("set_rate", F.expr(f"CASE kind WHEN {RR} THEN {rate} WHEN {RRF} THEN next_reset_rate END"))
    return rated.select(*rows.columns, "set_rate")


def states_from_rows(rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The events of ``rows`` (with ``set_rate``) that are given out, with value, nominal, accrued and rate."""
    order, keys = [F.col("day"), F.col("kind")], ["contract"]
    # what a reset's rate was made of has done its part, and isn't moved
    cut = with_splits(rows.drop(*RATE_TERMS), keys, "day", hot_rows)
    last = stored(with_last(cut, keys, order, {"rate_before": "set_rate", "date_before": "date"}), "last")
    accrued = f"({year_fraction('coalesce(date_before, since)', 'date', 'day_count')}) * coalesce(rate_before, nominal_rate) * principal"
    steps = last.selectExpr("*", "sign * notional AS principal").selectExpr("*", f"{accrued} AS step", f"kind IN {CLEARING} AS clears")
    owed = with_running(steps, keys, order, "step", "clears", "due")
    rate = f"if(kind IN {RESETTING}, coalesce(set_rate, rate_before, nominal_rate), NULL)"
    return owed.where(given_out("date", "kind")).selectExpr(
        "contract",
        "contract_id",
        "date",
        "kind",
        f"{event_name('kind')} AS type",
        "currency",
        f"{event_value('kind', 'due')} AS value",
        f"{nominal_after('kind')} AS nominal",
        f"{accrued_after('kind', 'due')} AS accrued",
        f"{rate} AS rate",
    )


def evaluate_rows(
    contracts: DataFrame, t0: str | DataFrame, market: DataFrame, hot_rows: int = HOT_ROWS, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """From terms and market objects to one row per event, as ``flat_events`` of ``evaluate``."""
    # stored, because each is read several times
    rows = stored(schedule_rows(contracts, t0), "schedule")
    return states_from_rows(stored(with_reset_rates(rows, market, hot_rows, limit), "rated"), hot_rows)
