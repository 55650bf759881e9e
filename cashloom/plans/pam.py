"""From contract terms, market data and an analysis date to cash-flow events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashloom.functions import let, quoted, quoted_list
from cashloom.functions.cycles import tenor_years
from cashloom.functions.text import date_text
from cashloom.operators.asof import as_of, with_series
from cashloom.operators.curve import curve_rate, day_years, discount_factor, with_curve, years_after
from cashloom.operators.lookup import BROADCAST_BYTES, lookup, reset_status
from cashloom.operators.schedule import with_schedule
from cashloom.operators.states import flat_events, with_states
from cashloom.sources.analysis_date import with_analysis_date
from cashloom.sources.contracts import with_full_terms
from cashloom.sources.market import BASE_SCENARIO, REFERENCE_RATE

# Days from the analysis date on whose discount factors are worked out beforehand: fifty years.
FACTOR_DAYS = 18_262


def evaluate(
    contracts: DataFrame,
    t0: str | DataFrame,
    market: DataFrame | None = None,
    scenarios: Sequence[str] = (BASE_SCENARIO,),
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Contracts ready for their events, with ``contract_status`` and ``reset_status``.

    ``market`` is a table of market objects, one row per code, or per scenario and code when it has
    a ``scenario`` column; a scenario that it has no object of is an error. Without it every contract
    keeps the rates of its own terms. There is one row a contract and scenario, with ``scenario``; but
    of several scenarios, those in which a contract can't differ share a row, and ``scenarios`` lists
    them: the events come out in each.
    """
    dated = with_analysis_date(with_full_terms(contracts), t0)
    names = f"array({quoted_list(scenarios)})"
    one = len(scenarios) == 1
    if market is None:
        column = f"{quoted(scenarios[0])} AS scenario" if one else f"{names} AS scenarios"
        scheduled = with_schedule(dated).selectExpr("*", column)
        return with_states(scheduled).withColumn("reset_status", F.lit("none"))
    # the market is attached to the terms, before the schedule makes the rows wide
    priced = lookup(dated, _objects_by_code(market, scenarios), ["reset_code"], limit)
    scheduled = with_schedule(priced)
    if one:
        spread = scheduled.selectExpr("*", f"{quoted(scenarios[0])} AS scenario")
    else:
        each = f"if(size(reset_dates) > 0, transform({names}, n -> array(n)), array({names}))"
        spread = scheduled.selectExpr("*", f"explode({each}) AS scenarios").selectExpr(
            "*", "get(filter(objects, o -> o.scenario = scenarios[0]), 0) AS found"
        )
    spread = spread.selectExpr(
        "*",
        "found.kind AS reset_kind",
        "found.series AS series",
        f"{curve_rate('found.curve', tenor_years('rate_term'))} AS curve_rate",
    )
    seen = f"coalesce(__curve_rate, {as_of('__series', 'd')})"
    rates = f"transform(reset_dates, d -> coalesce(rate_multiplier, 1D) * {seen} + coalesce(rate_spread, 0D))"
    # bound, because the optimizer would put what they stand for inside, to be worked out for every reset
    rates = let("__curve_rate", "curve_rate", let("__series", "series", rates))
    status = (
        f"CASE {reset_status()} WHEN 'ok' THEN CASE WHEN found.series IS NULL AND found.curve IS NULL THEN 'unreadable'"
        f" WHEN unobserved THEN 'no_observation' ELSE 'ok' END ELSE {reset_status()} END"
    )
    rated = with_states(spread, rates=rates)
    return rated.withColumn("reset_status", F.expr(status)).drop("objects", "found", "series", "curve_rate")


def _objects_by_code(market: DataFrame, scenarios: Sequence[str]) -> DataFrame:
    """``reset_code`` and its ``objects``, one for each scenario asked for that has the code; of one scenario ``found``."""
    if "scenario" not in market.columns:
        if list(scenarios) != [BASE_SCENARIO]:
            raise ValueError(f"market data without scenarios is {BASE_SCENARIO!r}, not {list(scenarios)}")
        market = market.withColumn("scenario", F.lit(BASE_SCENARIO))
    asked = market.where(f"scenario IN ({quoted_list(scenarios)})")
    there = asked.agg(F.collect_set("scenario").alias("s")).scalar()
    unknown = F.array_except(F.expr(f"array({quoted_list(scenarios)})"), there)
    usable = with_curve(with_series(asked, (REFERENCE_RATE,)))
    one = F.struct("scenario", "kind", "series", "curve")
    if len(scenarios) == 1:
        table = usable.select(F.col("code").alias("reset_code"), one.alias("found"))
    else:
        table = usable.groupBy(F.col("code").alias("reset_code")).agg(F.collect_list(one).alias("objects"))
    return with_error_row(table, unknown)


def with_error_row(table: DataFrame, unknown: Column) -> DataFrame:
    """``table``; reading it fails if ``unknown`` scenarios are left, even if it has no row."""
    complaint = F.concat(F.lit("no market data for scenario "), F.array_join(unknown, ", "))
    checked = table.sparkSession.range(1).where(F.size(unknown) > 0).select(F.raise_error(complaint).cast("string").alias("reset_code"))
    return table.unionByName(checked, allowMissingColumns=True)


def discounted(events: DataFrame, market: DataFrame, curve: str) -> DataFrame:
    """Add ``discount``: the factor of the event date on the curve, from the analysis date on.

    ``events`` carry ``scenario``, ``t0`` and ``date``. Every scenario has the factors of the days to come, worked
    out once, in one value of the plan; only for a day beyond them the curve is searched for the event.
    """
    if "scenario" not in market.columns:
        market = market.withColumn("scenario", F.lit(BASE_SCENARIO))
    curves = with_curve(market.where(f"code = {quoted(curve)}"))

    def factor(years: str, of: str) -> str:
        return discount_factor(curve_rate(of, years), years)

    def by_scenario(value: Column) -> Column:
        return curves.agg(F.map_from_entries(F.collect_list(F.struct("scenario", value))).alias("values")).scalar()

    by_day = f"transform(sequence(0, {FACTOR_DAYS}), __day -> {factor(day_years('__day'), 'curve')})"
    # used where it stands: as a column the factors of all days would be copied into every event's row
    known = F.get(F.try_element_at(by_scenario(F.expr(by_day)), F.col("scenario")), F.datediff("date", "t0"))
    found = events.withColumn("__curve_now", F.try_element_at(by_scenario(F.col("curve")), F.col("scenario")))
    later = F.expr(factor(years_after("t0", "date"), "__curve_now"))
    return found.withColumn("discount", F.coalesce(known, later)).drop("__curve_now")


def event_records(evaluated: DataFrame, market: DataFrame, curve: str) -> DataFrame:
    """The flat event record, one row per event: scenario, portfolio, event and discount.

    ``evaluated`` carries a ``portfolio`` column.
    """
    events = flat_events(evaluated, keep=("scenario", "portfolio", "t0"))
    return discounted(events, market, curve).selectExpr(
        "scenario AS riskScenario",
        "portfolio",
        "contract_id AS id",
        f"{date_text('date')} AS date",
        "type",
        "currency",
        "value",
        "nominal",
        "accrued",
        "discount",
    )
