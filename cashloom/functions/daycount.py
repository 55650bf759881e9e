"""Year fractions by day-count convention."""

from __future__ import annotations

# Names of the conventions.
ACTUAL_365 = "A/365"
ACTUAL_360 = "A/360"
THIRTY_E_360 = "30E/360"
ACTUAL_ACTUAL = "A/A ISDA"
CONVENTIONS = (ACTUAL_365, ACTUAL_360, THIRTY_E_360, ACTUAL_ACTUAL)


def year_fraction(start: str, end: str, convention: str) -> str:
    """Years from ``start`` to ``end``; null for an unknown convention.

    Actual/actual counts whole calendar years apart from the fractions of a year at either end.
    """
    return (
        f"CASE {convention}"
        f" WHEN '{ACTUAL_365}' THEN datediff({end}, {start}) / 365D"
        f" WHEN '{ACTUAL_360}' THEN datediff({end}, {start}) / 360D"
        f" WHEN '{THIRTY_E_360}' THEN ({_thirty(end)} - {_thirty(start)}) / 360D"
        f" WHEN '{ACTUAL_ACTUAL}' THEN year({end}) - year({start}) + ({_elapsed(end)} - {_elapsed(start)}) END"
    )


def _thirty(date: str) -> str:
    """Days on a calendar of 30-day months."""
    return f"(year({date}) * 360 + month({date}) * 30 + least(day({date}), 30))"


def _elapsed(date: str) -> str:
    """Fraction of the calendar year gone by."""
    return f"(dayofyear({date}) - 1) / dayofyear(make_date(year({date}), 12, 31))"
