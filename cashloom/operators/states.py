"""Contract states at the events, and the event values.

The notional is constant between the initial exchange and the end, so the interest due at an
event follows from the last payment before it and the resets since. Payments and resets are regular,
so how many of either come before the other is counted from the dates, not looked up. What accrues between resets is added up from payment to payment in one running sum,
``reset_dues``; amounts and values are computed event by event, after the dates are exploded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashloom.functions import let
from cashloom.functions.cycles import steps_upto
from cashloom.functions.daycount import year_fraction
from cashloom.operators.lookup import HOT_ROWS
from cashloom.operators.schedule import (
    IED,
    IP,
    MD,
    PRD,
    RR,
    RRF,
    TD,
    event_kind,
    event_name,
    given_out,
    with_event_dates,
)
from cashloom.operators.splits import SPLIT, with_splits

CLEARING = f"({IP}, {TD}, {MD})"
CLOSING = f"({TD}, {MD})"
RESETTING = f"({RRF}, {RR})"

# What the events of an evaluated contract are made of, but for its scenario, once ``with_event_dates`` has listed them again.
EVENT_TERMS = [
    "contract_id", "currency", "day_count", "sign", "notional", "principal", "nominal_rate", "next_reset_rate", "premium_discount",
    "purchase_price", "termination_price", "initial_exchange_date", "maturity_date", "running", "ended", "since", "purchased_on",
    "terminated_on", "paid_at_purchase", "paid_at_termination", "resets_at_purchase", "resets_at_termination", "resets_at_payment",
    "interest_dates", "reset_dates", "reset_rates", "reset_dues",
]

# Steps that are summed by growing one array.
BLOCK = 64


def with_states(scheduled: DataFrame, observed: str = "CAST(NULL AS double)", rates: str | None = None) -> DataFrame:
    """Add the rates from the resets on, the interest due at them, and the event dates.

    ``observed`` is the market rate at a reset date ``d``, or ``rates`` all of them in the order of the
    dates. Where there is none the rate stays as it was. An observation once made stays available, so
    the resets without one come first, and the rate they keep is the first fixed or the contract's own.
    ``unobserved`` tells whether there are any.
    """
    fixed = "rank = 0 AND next_reset_rate IS NOT NULL"
    rate = f"if({fixed}, next_reset_rate, coalesce(seen, next_reset_rate, nominal_rate))"
    opening = "if(next_reset_rate IS NULL, 0, 1)"
    rated = (
        scheduled.selectExpr(
            "*",
            "sign * notional AS principal",
            f"{rates or f'transform(reset_dates, d -> {observed})'} AS observed_rates",
        )
        .selectExpr(
            "*",
            f"transform(observed_rates, (seen, rank) -> {rate}) AS reset_rates",
            f"get(observed_rates, {opening}) IS NULL AND size(reset_dates) > {opening} AS unobserved",
            f"if(size(reset_dates) > 0, transform(reset_dates, __day -> {_payments_upto('__day')}), NULL) AS payments_at_reset",
            *_single("purchase", "purchased_on"),
            *_single("termination", "terminated_on"),
        )
        .selectExpr("*", f"{_resets_at_payment()} AS resets_at_payment")
    )
    steps = f"transform(reset_dates, (d, rank) -> {_reset_step('rank')})"
    dues = f"if(size(reset_dates) > 0, {_running(steps)}, cast(array() AS array<double>))"
    return with_event_dates(rated.selectExpr("*", f"{dues} AS reset_dues"))


def _payments_upto(date: str) -> str:
    """How many payments there are up to a date in the contract's life; that at maturity may be off the regular dates."""
    regular = "if(last_day = maturity_date, greatest(size(interest_dates) - 1, 0), size(interest_dates))"
    gone = f"least({_regular_upto(date, 'interest')}, {regular})"
    return f"{gone} + if(last_day = maturity_date AND {date} >= maturity_date, 1, 0)"


def _resets_upto(date: str) -> str:
    """How many resets there are up to a date."""
    return f"if(size(reset_dates) > 0, least({_regular_upto(date, 'reset')}, size(reset_dates)), 0)"


def _resets_at_payment() -> str:
    """How many resets come before each payment; one reset stays the last up to the payments before the next."""
    upto = "concat(payments_at_reset, array(size(interest_dates)))"
    each = f"transform({upto}, (upto, resets) -> array_repeat(resets, upto - coalesce(get(payments_at_reset, resets - 1), 0)))"
    return f"if(size(reset_dates) > 0, flatten({each}), NULL)"


def _regular_upto(date: str, kind: str) -> str:
    return f"greatest({steps_upto(date, f'{kind}_from', f'{kind}_step')} - {kind}_gone, 0)"


def _single(name: str, date: str) -> list[str]:
    """What came before an event that a contract has at most once, that day's events included."""
    return [
        f"if({date} IS NULL, NULL, {_paid_before(_payments_upto(date))}) AS paid_at_{name}",
        f"if({date} IS NULL, 0, {_resets_upto(date)}) AS resets_at_{name}",
    ]


def _paid_before(count: str) -> str:
    """Date of the last of ``count`` payments, or where accrual began."""
    return f"coalesce(get(interest_dates, {count} - 1), since)"


def _rate_after(resets: str) -> str:
    return f"coalesce(get(reset_rates, {resets} - 1), nominal_rate)"


def _interest(start: str, end: str, rate: str) -> str:
    return f"({year_fraction(start, end, 'day_count')}) * {rate} * principal"


def _reset_step(rank: str) -> str:
    """What accrues up to a reset: since the payment before it, or the reset if that is later."""
    payments = f"get(payments_at_reset, {rank})"
    since = f"if(__first, {_paid_before(payments)}, get(reset_dates, {rank} - 1))"
    due = let("__since", since, _interest("__since", f"get(reset_dates, {rank})", _rate_after(rank)))
    first = f"{rank} = 0 OR {payments} > get(payments_at_reset, {rank} - 1)"
    return let("__first", first, f"named_struct('first', __first, 'due', {due})")


def _running(steps: str) -> str:
    """Running sums of ``steps.due``, begun anew at every ``first``.

    An array that grows by an element at a time is copied each time, so the sums are taken in
    blocks, and what a block ends with is carried into the next.
    """
    grown = (
        "array_append(sums, named_struct('first', step.first OR coalesce(get(sums, size(sums) - 1).first, false),"
        " 'due', if(step.first, step.due, coalesce(get(sums, size(sums) - 1).due, 0D) + step.due)))"
    )
    empty = "cast(array() AS array<struct<first: boolean, due: double>>)"
    summed = f"aggregate(%s, {empty}, (sums, step) -> {grown})"
    block = summed % f"slice(steps, block * {BLOCK} + 1, {BLOCK})"
    blocks = f"transform(sequence(0, (size(steps) - 1) div {BLOCK}), block -> {block})"
    end = "get(block, size(block) - 1)"
    carried = (
        f"aggregate(blocks, array(0D), (carry, block) -> concat(carry, array(if({end}.first, {end}.due,"
        f" get(carry, size(carry) - 1) + {end}.due))))"
    )
    whole = "flatten(transform(blocks, (block, i) -> transform(block, s -> if(s.first, s.due, get(carry, i) + s.due))))"
    several = let("blocks", blocks, let("carry", carried, whole))
    one = f"if(forall(steps, step -> step.first), steps.due, {summed % 'steps'}.due)"
    return let("steps", steps, f"if(size(steps) <= {BLOCK}, {one}, {several})")


def paid_before(kind: str, position: str) -> str:
    """Date of the last payment before the event, or where accrual began; null if nothing accrues."""
    return (
        f"CASE {kind} WHEN {IP} THEN {_paid_before(f'{position} - kind_ends[0]')}"
        f" WHEN {PRD} THEN paid_at_purchase WHEN {TD} THEN paid_at_termination END"
    )


def resets_before(kind: str, position: str) -> str:
    """How many resets come before the event, where that matters."""
    of_payment = f"get(resets_at_payment, {position} - kind_ends[0])"
    return (
        f"CASE {kind} WHEN {IP} THEN coalesce({of_payment}, 0)"
        f" WHEN {PRD} THEN resets_at_purchase WHEN {TD} THEN resets_at_termination ELSE 0 END"
    )


def accrual_start(paid: str, resets: str) -> str:
    """Where the accrual up to the event starts anew: the last payment or a reset after it."""
    return f"greatest({paid}, get(reset_dates, {resets} - 1))"


def event_due(date: str, kind: str, position: str, paid: str, resets: str, start: str) -> str:
    """Interest accrued up to the event, before it pays any."""
    carried = f"if({start} > {paid}, get(reset_dues, {resets} - 1), 0D)"
    return (
        f"CASE WHEN {paid} IS NOT NULL THEN {carried} + {_interest(start, date, _rate_after(resets))}"
        f" WHEN {kind} IN {RESETTING} THEN get(reset_dues, {position} - kind_ends[1]) ELSE 0D END"
    )


def event_value(kind: str, due: str) -> str:
    return (
        f"CASE {kind} WHEN {IED} THEN -sign * (notional + coalesce(premium_discount, 0D)) WHEN {IP} THEN {due}"
        f" WHEN {PRD} THEN -sign * purchase_price - {due} WHEN {TD} THEN sign * termination_price + {due}"
        f" WHEN {MD} THEN principal + {due} ELSE 0D END"
    )


def nominal_after(kind: str) -> str:
    return f"if({kind} IN {CLOSING}, 0D, principal)"


def accrued_after(kind: str, due: str) -> str:
    return f"if({kind} IN {CLEARING}, 0D, {due})"


def rate_set(kind: str, position: str) -> str:
    """Rate from a reset on; null at other events."""
    return f"if({kind} IN {RESETTING}, get(reset_rates, {position} - kind_ends[1]), NULL)"


def in_each_scenario(rows: DataFrame) -> DataFrame:
    """Rows that stand for several ``scenarios`` once for each, as ``scenario``."""
    if "scenarios" not in rows.columns:
        return rows
    others = [f"`{c}`" for c in rows.columns if c != "scenarios"]
    return rows.selectExpr(*others, "explode(scenarios) AS scenario")


def _kept(evaluated: DataFrame, keep: tuple[str, ...]) -> list[str]:
    """The columns to keep, ``scenarios`` in place of ``scenario`` where rows share them."""
    if "scenarios" not in evaluated.columns:
        return list(keep)
    return [*[c for c in keep if c != "scenario"], "scenarios"]


def _in_order(rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Rows in each scenario, with the kept columns first and ``scenario`` only if it is one."""
    if "scenarios" not in rows.columns:
        return rows
    others = [c for c in rows.columns if c != "scenarios" and c not in keep]
    return in_each_scenario(rows).select(*keep, *others)


def event_rows(evaluated: DataFrame, closing: bool = False) -> DataFrame:
    """One row per event of the schedule, contract columns kept: ``position, date, kind``.

    Contracts that share a row over ``scenarios`` still do. With ``closing`` every contract has one more
    row, of which ``date`` and ``kind`` are null, so that none is without a row.
    """
    # The outer form: from an inner one the optimizer derives a filter on the array's size and
    # pushes it to the scan, where the whole schedule would be built a second time.
    dates = "concat(event_dates, array(cast(NULL AS date)))" if closing else "event_dates"
    rows = evaluated.selectExpr("*", f"posexplode_outer({dates}) AS (position, date)")
    if closing:
        placed = rows.withColumn("kind", F.expr(f"if(date IS NULL, NULL, {event_kind('position')})"))
        return placed.where(f"date IS NULL OR {given_out('date', 'kind')}")
    placed = rows.where("date IS NOT NULL").withColumn("kind", F.expr(event_kind("position")))
    return placed.where(given_out("date", "kind"))


def flat_events(evaluated: DataFrame, keep: tuple[str, ...] = (), closing: bool = False) -> DataFrame:
    """One row per event: ``contract_id, date, kind, type, currency, value, nominal, accrued, rate``.

    With ``closing`` one more row for each contract, as in ``event_rows``.
    """
    ranked = event_rows(evaluated, closing).selectExpr(
        "*",
        f"{paid_before('kind', 'position')} AS paid",
        f"{resets_before('kind', 'position')} AS resets",
    )
    started = ranked.withColumn("start", F.expr(f"if(paid IS NULL, NULL, {accrual_start('paid', 'resets')})"))
    owed = started.withColumn("due", F.expr(event_due("date", "kind", "position", "paid", "resets", "start")))
    events = owed.selectExpr(
        *_kept(owed, keep),
        "contract_id",
        "date",
        "kind",
        f"{event_name('kind')} AS type",
        "currency",
        f"{event_value('kind', 'due')} AS value",
        f"{nominal_after('kind')} AS nominal",
        f"{accrued_after('kind', 'due')} AS accrued",
        f"{rate_set('kind', 'position')} AS rate",
    )
    return _in_order(events, keep)


def number_of_events() -> str:
    """How many events of a contract are given out; of a purchased one the purchase, what is after it, and the end."""
    dates = "size(interest_dates) + size(reset_dates)"
    before = f"{_payments_upto('purchased_on')} + {_resets_upto('purchased_on')}"
    return f"CASE WHEN ended THEN 0 WHEN purchased_on IS NULL THEN if(running, 0, 1) + {dates} + 1 ELSE {dates} - ({before}) + 2 END"


def event_counts(evaluated: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``n_events`` of every contract, without computing them."""
    counts = evaluated.selectExpr(*_kept(evaluated, keep), "contract_id", f"{number_of_events()} AS n_events")
    return _in_order(counts, keep)


def _payments() -> str:
    """Payments as events; without resets each accrues at one rate from the one before."""
    paid = "slice(concat(array(since), interest_dates), 1, size(interest_dates))"
    plain = _event("__day", IP, f"if(__paid IS NULL, 0D, 0D + {_interest('__paid', '__day', 'nominal_rate')})")
    due = let("__start", accrual_start("__paid", "__resets"), event_due("__day", f"{IP}", "__i", "__paid", "__resets", "__start"))
    due = let("__resets", "coalesce(get(resets_at_payment, __i), 0)", let("__paid", _paid_before("__i"), due))
    return (
        f"if(size(reset_dates) > 0, transform(interest_dates, (__day, __i) -> {_event('__day', IP, due)}),"
        f" zip_with(interest_dates, {paid}, (__day, __paid) -> {plain}))"
    )


def _event(date: str, kind: int | str, value: str, accrued: str = "0D") -> str:
    return f"named_struct('date', {date}, 'kind', {kind}, 'value', {value}, 'accrued', {accrued})"


def _single_event(date: str, kind: int, name: str) -> str:
    """The purchase or the termination, whose dates are null if a contract has none."""
    paid, resets = f"paid_at_{name}", f"resets_at_{name}"
    due = let("__start", accrual_start(paid, resets), event_due(date, f"{kind}", "0", paid, resets, "__start"))
    event = _event(date, kind, event_value(f"{kind}", "__due"), accrued_after(f"{kind}", "__due"))
    return let("__due", due, event)


def _listed_events() -> str:
    """The events that a contract gives out, in order: kind by kind, since a kind's values need no choice."""
    none = "cast(array() AS array<struct<date: date, kind: int, value: double, accrued: double>>)"
    fixed = f"if(__i = 0 AND next_reset_rate IS NOT NULL, {RRF}, {RR})"
    kinds = [
        f"if(running, {none}, array({_event('initial_exchange_date', IED, event_value(f'{IED}', '0D'))}))",
        _payments(),
        f"transform(reset_dates, (__day, __i) -> {_event('__day', fixed, '0D', 'get(reset_dues, __i)')})",
        f"if(purchased_on IS NULL, {none}, array({_single_event('purchased_on', PRD, 'purchase')}))",
        f"if(terminated_on IS NULL, {none}, array({_single_event('terminated_on', TD, 'termination')}))",
        f"if(terminated_on IS NULL, array({_event('maturity_date', MD, event_value(f'{MD}', '0D'))}), {none})",
    ]
    # but for resets and a purchase the kinds follow each other in time
    listed = let("__all", f"concat({', '.join(kinds)})", "if(size(reset_dates) > 0 OR purchased_on IS NOT NULL, sort_array(__all), __all)")
    given = f"filter({listed}, __e -> {given_out('__e.date', '__e.kind')})"
    return f"if(ended, {none}, if(purchased_on IS NULL, {listed}, {given}))"


def nested_events(evaluated: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per contract with parallel arrays in event order, empty ones for no events."""
    rows = evaluated.selectExpr("*", f"{_listed_events()} AS events")
    nested = rows.selectExpr(
        *_kept(rows, keep),
        "array_repeat(contract_id, size(events)) AS id",
        "cast(events.date AS array<string>) AS date",
        f"transform(events.kind, __kind -> {event_name('__kind')}) AS type",
        "array_repeat(currency, size(events)) AS currency",
        "events.value AS value",
        f"transform(events.kind, __kind -> {nominal_after('__kind')}) AS nominal",
        "events.accrued AS accrued",
    )
    return _in_order(nested, keep)


def regrouped(
    events: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str], at: str, most: int = HOT_ROWS
) -> DataFrame:
    """Event rows back to one row per contract: the ``keys``, ``part``, and an array for each of the ``columns``.

    ``keys`` tell the contracts apart, also two of one id. The arrays are parallel, in the ``order`` given.
    A contract of more than about ``most`` rows comes in parts that follow each other in the order of the
    long ``at``, which ``order`` begins with, so that no row or task holds more; others have part 0 alone.
    Rows that are equal in ``order`` and ``columns`` stay as many as they are.
    """
    cut = with_splits(events, keys, at, most)
    row = F.struct(*[F.col(c).alias(f"by{k}") for k, c in enumerate(order)], F.struct(*columns).alias("event"))
    listed = cut.groupBy(*keys, SPLIT).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    arrays = [F.col(f"rows.event.`{c}`").alias(c) for c in columns]
    return listed.select(*keys, F.col(SPLIT).alias("part"), *arrays)


def unnested(nested: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parallel arrays back to one row per event."""
    arrays = [c for c in nested.columns if c not in keep]
    rows = nested.selectExpr(*keep, f"inline_outer(arrays_zip({', '.join(arrays)}))")
    return rows.where(f"{arrays[0]} IS NOT NULL")
