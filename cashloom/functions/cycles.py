"""Cycles (``3M-``), tenors (``5Y``) and the dates they produce."""

from __future__ import annotations

from cashloom.functions import let, quoted, quoted_list

# Fixed values of the cycle text: count, unit, optional stub sign.
CYCLE_PATTERN = r"^P?([0-9]+)([DWMQHY])([+-]|L[01])?$"
CYCLE_PARTS = r"(?s)^P?([0-9]+)([DWMQHY])([+-]|L[01])?.*"  # of a text that the pattern fits
UNIT_MONTHS = {"M": 1, "Q": 3, "H": 6, "Y": 12}
UNIT_DAYS = {"D": 1, "W": 7}
LONG_STUBS = ("+", "L0")

# The years 1 to 9999: no date is so far from another.
CALENDAR_MONTHS, CALENDAR_DAYS = 120_000, 3_652_425

DAYS_PER_YEAR = 365.0
NO_DATES = "cast(array() AS array<date>)"


def parse_cycle(text: str) -> str:
    """Cycle text to ``struct(months, days, long_stub)``; null if malformed or of no length.

    Lengths are longs, so that ten digits of years still are the number they say.
    """
    return let("__parts", cycle_parts(text), cycle_step("__parts"))


def cycle_parts(text: str) -> str:
    """Count, unit and stub sign of a cycle text, or null; a column of them spares ``cycle_step`` a binding."""
    parts = f"split(regexp_replace({text}, {quoted(CYCLE_PARTS)}, '$1 $2 $3'), ' ')"
    return f"CASE WHEN {text} RLIKE {quoted(CYCLE_PATTERN)} THEN {parts} END"


def cycle_step(parts: str) -> str:
    """What ``parse_cycle`` gives, from the parts; null also if the length is beyond a long."""
    count = f"try_cast(get({parts}, 0) AS bigint)"

    def length(units: dict[str, int]) -> str:
        sizes = " ".join(f"WHEN {quoted(unit)} THEN {size}L" for unit, size in units.items())
        return f"try_multiply({count}, CASE get({parts}, 1) {sizes} ELSE 0L END)"

    months, days = length(UNIT_MONTHS), length(UNIT_DAYS)
    step = f"named_struct('months', {months}, 'days', {days}, 'long_stub', get({parts}, 2) IN ({quoted_list(LONG_STUBS)}))"
    return f"CASE WHEN {count} > 0 AND {months} IS NOT NULL AND {days} IS NOT NULL THEN {step} END"


def tenor_years(text: str) -> str:
    """Tenor text to years: months in twelfths, days over 365."""
    return let("__tenor", parse_cycle(text), f"__tenor.months / 12D + __tenor.days / {DAYS_PER_YEAR}D")


def month_number(date: str) -> str:
    return f"(year({date}) * 12 + month({date}))"


def plus_cycle(date: str, step: str) -> str:
    """The date a step later; null if that is beyond the calendar."""
    return (
        f"CASE WHEN {step}.months >= {CALENDAR_MONTHS} OR {step}.days >= {CALENDAR_DAYS} THEN NULL"
        f" WHEN {step}.months > 0 THEN add_months({date}, cast({step}.months AS int))"
        f" ELSE date_add({date}, cast({step}.days AS int)) END"
    )


def regular_dates(anchor: str, step: str, until: str) -> str:
    """The dates ``anchor + k * step`` up to ``until``, ascending.

    Each is counted from the anchor, so a month-end anchor keeps its month ends. A step as long as
    the calendar leaves the anchor alone.
    """
    months = f"cast(least({step}.months, {CALENDAR_MONTHS}) AS int)"
    days = f"cast(least({step}.days, {CALENDAR_DAYS}) AS int)"
    interval = f"make_interval(0, {months}, 0, {days})"
    return f"coalesce(CASE WHEN {step} IS NOT NULL AND {anchor} <= {until} THEN sequence({anchor}, {until}, {interval}) END, {NO_DATES})"


def without_stub(dates: str, step: str, end: str) -> str:
    """The regular dates strictly before ``end``; under a long stub the last of them goes too."""
    last = f"size({dates}) - 1"
    return (
        f"CASE WHEN size({dates}) > 0 AND (get({dates}, {last}) = {end} OR {step}.long_stub)"
        f" THEN slice({dates}, 1, {last}) ELSE {dates} END"
    )


def steps_upto(date: str, anchor: str, step: str) -> str:
    """How many of the dates ``anchor + k * step`` are not after ``date``: counted, not looked through."""
    # as many as whole steps of months lie between the two, and one more if its day is there too
    steps = f"(({month_number(date)} - {month_number(anchor)}) div {step}.months)"
    by_months = f"{steps} + if(add_months({anchor}, cast({steps} * {step}.months AS int)) <= {date}, 1, 0)"
    by_days = f"datediff({date}, {anchor}) div {step}.days + 1"
    counted = f"if({step}.months > 0, {by_months}, {by_days})"
    return f"if({date} >= {anchor} AND {step} IS NOT NULL, cast({counted} AS int), 0)"
