"""Evaluation under any number of scenarios, given as data instead of names in the plan.

A table of scenarios (``scenario``, ``shift``) is dealt into blocks. A market object has one row for each
block, with the rates of all its scenarios as an array of arrays, so that a contract meets a block in
one row: its schedule is worked out once, and the places of its resets in the series once for a block.
Only then does a row become one for each scenario. Contracts without resets can't differ: they are
evaluated once, and their totals are given to every scenario. The plan has the same operators for three
scenarios as for thousands.

Totals of values need less: no date depends on a rate, and a value is a constant plus rates times the interest
that a rate of one earns. ``scenario_values`` adds up those weights over the contracts, for each observation
that sets a rate, and only the sums meet the scenarios.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cashloom.functions import let, quoted, quoted_list
from cashloom.functions.cycles import tenor_years
from cashloom.functions.daycount import year_fraction
from cashloom.operators.asof import as_of, with_series
from cashloom.operators.curve import curve_rate, with_curve
from cashloom.operators.lookup import BROADCAST_BYTES, lookup
from cashloom.operators.schedule import OK, with_event_dates, with_schedule
from cashloom.operators.states import flat_events, number_of_events, with_states
from cashloom.session import materialised
from cashloom.sources.analysis_date import with_analysis_date
from cashloom.sources.contracts import with_full_terms
from cashloom.sources.market import RATE_KINDS, REFERENCE_RATE

# Scenarios that a contract's row carries the rates of at once.
TOGETHER = 32


def scenario_blocks(scenarios: DataFrame, together: int = TOGETHER) -> DataFrame:
    """block, names, shifts: the scenarios in order of their names, ``together`` in a row.

    A scenario given twice, or one without a name or shift, is an error: its values would be no one's.
    """
    named = scenarios.groupBy("scenario").agg(F.count(F.lit(1)).alias("n"), F.max("shift").alias("shift"))
    good = F.col("scenario").isNotNull() & F.col("shift").isNotNull() & (F.col("n") == 1)
    complaint = F.concat(F.lit("a scenario needs one name and one shift: "), F.coalesce("scenario", F.lit("null")))
    checked = named.select(F.when(good, F.col("scenario")).otherwise(F.raise_error(complaint).cast("string")).alias("scenario"), "shift")
    placed = checked.withColumn("block", F.floor((F.row_number().over(Window.orderBy("scenario")) - 1) / together).cast("int"))
    each = F.sort_array(F.collect_list(F.struct("scenario", "shift"))).alias("each")
    return placed.groupBy("block").agg(each).selectExpr("block", "each.scenario AS names", "each.shift AS shifts")


def rate_objects(market: DataFrame) -> DataFrame:
    """The rate objects with ``series``, ``curve`` and ``places``: a series of the places of the observations."""
    objects = market.where(f"kind IN ({quoted_list(RATE_KINDS)})")
    places = "if(series IS NULL, NULL, named_struct('dates', series.dates, 'values', transform(series.values, (v, i) -> i), 'counts', series.counts, 'first_month', series.first_month))"
    return with_curve(with_series(objects, (REFERENCE_RATE,))).selectExpr("*", f"{places} AS places")


def market_blocks(market: DataFrame, blocks: DataFrame) -> DataFrame:
    """reset_code, reset_kind, names, places, rates, curves: a rate object once for every block.

    ``places`` is a series whose value at a date is the place of the observation in force, ``rates`` has
    the observations of each scenario, and ``curves`` the term structure of each.
    """
    number = blocks.count()
    spread = rate_objects(market).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(1, number) - 1))))
    met = spread.join(blocks, "block")
    return met.selectExpr(
        "code AS reset_code",
        "kind AS reset_kind",
        "names",
        "places",
        "transform(shifts, s -> transform(series.values, v -> v + s)) AS rates",
        "transform(shifts, s -> transform(curve, p -> named_struct('years', p.years, 'rate', p.rate + s))) AS curves",
    )


def evaluate_scenarios(
    contracts: DataFrame,
    t0: str | DataFrame,
    market: DataFrame,
    scenarios: DataFrame,
    limit: int = BROADCAST_BYTES,
    together: int = TOGETHER,
) -> tuple[DataFrame, DataFrame]:
    """Contracts ready for their events: those without a reset cycle, and those with, in every scenario.

    The first table stands for all scenarios, the second has a row for each, with ``scenario``.
    """
    blocks = materialised(scenario_blocks(scenarios, together))
    terms = with_analysis_date(with_full_terms(contracts), t0)
    fixed = with_states(with_schedule(terms.where("reset_cycle IS NULL")))
    scheduled = with_schedule(terms.where("reset_cycle IS NOT NULL"))
    met = lookup(scheduled, materialised(market_blocks(market, blocks)), ["reset_code"], limit)
    # a code that no object has, or one of another kind, keeps the contract's rate in all scenarios
    all_names = blocks.agg(F.sort_array(F.flatten(F.collect_list("names"))).alias("names")).scalar()
    named = met.withColumn("names", F.coalesce("names", all_names))
    found = named.selectExpr(
        "*",
        f"transform(reset_dates, d -> {as_of('places', 'd')}) AS observed_places",
        f"transform(curves, c -> {curve_rate('c', tenor_years('rate_term'))}) AS curve_rates",
    )
    seen = "coalesce(get(__curve_rates, s), get(get(rates, s), p))"
    rate = f"coalesce(rate_multiplier, 1D) * {seen} + coalesce(rate_spread, 0D)"
    each = f"transform(names, (name, s) -> named_struct('scenario', name, 'scenario_rates', transform(__places, p -> {rate})))"
    # bound, because the optimizer would put what they stand for inside, to be worked out for every scenario
    each = let("__places", "observed_places", let("__curve_rates", "curve_rates", each))
    spread = found.selectExpr("* EXCEPT (names, places, rates, curves, observed_places, curve_rates)", f"inline_outer({each})")
    floating = with_states(spread.where("scenario IS NOT NULL"), rates="scenario_rates").drop("scenario_rates")
    return fixed, floating


def scenario_totals(
    contracts: DataFrame, t0: str | DataFrame, market: DataFrame, scenarios: DataFrame, by: tuple[str, ...], total: str, **options
) -> DataFrame:
    """scenario, the columns ``by``, n_events and ``total``: sums of events' values in every scenario.

    ``total`` is a sum over the columns of ``flat_events``, of whole numbers or decimals if the order of
    rows is not to show.
    """
    fixed, floating = evaluate_scenarios(contracts, t0, market, scenarios, **options)

    def summed(evaluated: DataFrame, *scenario: str) -> DataFrame:
        events = flat_events(evaluated, keep=scenario)
        return events.groupBy(*scenario, *by).agg(F.count(F.lit(1)).alias("n_events"), F.expr(total).alias("total"))

    names = scenarios.agg(F.array_sort(F.collect_set("scenario")).alias("names")).scalar()
    same = summed(fixed).withColumn("scenario", F.explode(names))
    both = summed(floating, "scenario").unionByName(same)
    return both.groupBy("scenario", *by).agg(F.sum("n_events").alias("n_events"), F.sum("total").alias("total"))


def exposures(contracts: DataFrame, t0: str | DataFrame, market: DataFrame, by: tuple[str, ...], limit: int = BROADCAST_BYTES) -> DataFrame:
    """Sums over contracts without a fault: the columns ``by``, reset_code, years, place, n_events, constant, weight.

    A row is an observation that sets rates: of a series by its ``place``, of a curve by the ``years`` of the
    term. The values that depend on it are ``weight`` times what is observed; ``reset_code`` is null in the
    row of the number of events and of what depends on no observation. Year fractions of adjoining periods add up,
    so that what all payments of a contract pay is what accrues from the purchase, or the last payment
    before the analysis, to the last day, reset by reset.
    """
    dated = with_event_dates(with_schedule(with_analysis_date(with_full_terms(contracts), t0)))
    objects = materialised(rate_objects(market).selectExpr("code AS reset_code", "places", "curve IS NOT NULL AS curved"))
    met = lookup(dated, objects, ["reset_code"], limit)
    found = met.selectExpr(
        "*",
        f"if(size(reset_dates) > 0 AND curved, {tenor_years('rate_term')}, NULL) AS years",
        "sign * notional AS principal",
        "coalesce(purchased_on, since) AS earning_from",
        "coalesce(rate_multiplier, 1D) AS multiplier",
        "coalesce(next_reset_rate, nominal_rate) AS kept_rate",
        f"transform(reset_dates, d -> {as_of('places', 'd')}) AS observed_places",
    )
    until = "greatest(coalesce(get(reset_dates, i + 1), last_day), earning_from)"
    earned = f"({year_fraction('greatest(d, earning_from)', until, 'day_count')}) * principal"
    observes = "(i > 0 OR next_reset_rate IS NULL) AND (years IS NOT NULL OR get(observed_places, i) IS NOT NULL)"
    periods = (
        f"transform(reset_dates, (d, i) -> named_struct('observes', {observes},"
        f" 'place', if(years IS NULL, get(observed_places, i), NULL), 'earned', {earned}))"
    )
    first = year_fraction("earning_from", "greatest(coalesce(get(reset_dates, 0), last_day), earning_from)", "day_count")
    exchanged = (
        "if(running OR purchased_on IS NOT NULL, 0D, -sign * (notional + coalesce(premium_discount, 0D)))"
        " + if(purchased_on IS NULL, 0D, -sign * purchase_price) + if(terminated_on IS NULL, principal, sign * termination_price)"
    )
    kept = "p.earned * if(p.observes, coalesce(rate_spread, 0D), kept_rate)"
    constant = f"{exchanged} + ({first}) * nominal_rate * principal + aggregate(periods, 0D, (total, p) -> total + {kept})"

    def record(code: str, years: str, place: str, n_events: str, constant: str, weight: str) -> str:
        fields = {"reset_code": code, "years": years, "place": place, "n_events": n_events, "constant": constant, "weight": weight}
        return f"named_struct({', '.join(f'{quoted(name)}, {value}' for name, value in fields.items())})"

    alone = record("cast(NULL AS string)", "cast(NULL AS double)", "cast(NULL AS int)", f"cast({number_of_events()} AS bigint)", constant, "0D")
    each = record("reset_code", "years", "p.place", "0L", "0D", "p.earned * multiplier")
    # not as a filter, which the optimizer would push to the scan with all that the status is made of
    counted = f"if(contract_status = '{OK}' AND NOT ended, concat(array({alone}), transform(filter(periods, p -> p.observes), p -> {each})), NULL)"
    rows = found.selectExpr("*", f"{periods} AS periods").selectExpr(*by, f"inline_outer({counted})").where("n_events IS NOT NULL")
    sums = [F.sum(c).alias(c) for c in ("n_events", "constant", "weight")]
    return rows.groupBy(*by, "reset_code", "years", "place").agg(*sums)


def faulty_contracts(contracts: DataFrame, t0: str | DataFrame) -> DataFrame:
    """The contracts with a fault, stored."""
    checked = with_schedule(with_analysis_date(with_full_terms(contracts), t0))
    marked = checked.selectExpr(*contracts.columns, f"explode_outer(if(contract_status = '{OK}', NULL, array(true))) AS __faulty")
    return materialised(marked.where("__faulty").drop("__faulty"))


def scenario_values(
    contracts: DataFrame,
    t0: str | DataFrame,
    market: DataFrame,
    scenarios: DataFrame,
    by: tuple[str, ...],
    limit: int = BROADCAST_BYTES,
    together: int = TOGETHER,
) -> DataFrame:
    """``scenario_totals`` of ``sum(value)``, with an effort that hardly grows with the number of scenarios.

    ``by`` are terms of the contracts. Contracts with a fault, some of whose events may lack a value, are
    evaluated in each scenario.
    """
    summed = materialised(exposures(contracts, t0, market, by, limit))
    names = scenarios.agg(F.array_sort(F.collect_set("scenario")).alias("names")).scalar()
    alone = summed.where("reset_code IS NULL AND n_events > 0").selectExpr(*by, "n_events", "constant AS total")
    same = alone.withColumn("scenario", F.explode(names))
    objects = materialised(market_blocks(market, materialised(scenario_blocks(scenarios, together))))
    seen = f"coalesce({curve_rate('get(curves, s)', 'years')}, get(get(rates, s), place))"
    each = f"inline(transform(names, (name, s) -> named_struct('scenario', name, 'total', weight * {seen})))"
    met = summed.where("reset_code IS NOT NULL").join(objects, "reset_code").selectExpr(*by, "0L AS n_events", each)
    faulty = scenario_totals(faulty_contracts(contracts, t0), t0, market, scenarios, by, "sum(value)", limit=limit, together=together)
    every = same.unionByName(met).unionByName(faulty)
    return every.groupBy("scenario", *by).agg(F.sum("n_events").alias("n_events"), F.sum("total").alias("total"))
