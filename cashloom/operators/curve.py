"""Term structures: rates between tenors and discount factors.

A curve is one array in one row, for it has as many points as there are tenors, and a rate is found
by a look along it. So a curve is joined by its code alone, and one that everything uses by nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashloom.functions import let
from cashloom.functions.cycles import DAYS_PER_YEAR, tenor_years
from cashloom.operators.lookup import BROADCAST_BYTES, lookup
from cashloom.sources.market import TERM_STRUCTURE, readable_points


def with_curve(market: DataFrame) -> DataFrame:
    """Add ``curve``: ``years`` and ``rate`` in the order of tenors; null for other kinds.

    A curve with a point or rate that does not read, or with more of one than the other, is null.
    """
    pairs = "zip_with(points, values, (p, v) -> named_struct('years', " + tenor_years("p") + ", 'rate', v))"
    curve = let("__curve", pairs, f"if({readable_points('__curve', 'years', 'rate')}, sort_array(__curve), NULL)")
    return market.withColumn("curve", F.expr(f"if(kind = '{TERM_STRUCTURE}', {curve}, NULL)"))


def curve_rate(curve: str, years: str) -> str:
    """The rate at ``years``: on a straight line between tenors, flat before the first and after the last."""
    low, high = "get(__points, __place - 1)", "get(__points, __place)"
    slope = f"coalesce(try_divide({high}.rate - {low}.rate, {high}.years - {low}.years), 0D)"
    rate = f"if(__place = 0, {high}.rate, {low}.rate + (__at - {low}.years) * {slope})"
    place = "size(filter(__points, __point -> __point.years <= __at))"
    found = let("__points", curve, let("__at", years, let("__place", place, rate)))
    return f"if({curve} IS NULL OR {years} IS NULL, NULL, {found})"


def interpolate(
    probes: DataFrame,
    market: DataFrame,
    on: dict[str, str],
    years: str,
    rate: str,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``probes`` plus the curve rate at ``years``; ``on`` maps probe columns to market columns."""
    curves = with_curve(market).selectExpr(*[f"{m} AS {p}" for p, m in on.items()], "curve AS __found_curve")
    found = lookup(probes, curves, list(on), limit)
    return found.withColumn(rate, F.expr(curve_rate("__found_curve", years))).select(*probes.columns, rate)


def years_after(t0: str, date: str) -> str:
    return day_years(f"datediff({date}, {t0})")


def day_years(days: str) -> str:
    return f"{days} / {DAYS_PER_YEAR}D"


def discount_factor(rate: str, years: str) -> str:
    """Annual compounding."""
    return f"pow(1D + {rate}, -({years}))"
