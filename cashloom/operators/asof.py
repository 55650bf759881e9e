"""Value of a dated series at a date: the last observation on or before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashloom.functions import let, quoted_list
from cashloom.functions.cycles import month_number
from cashloom.functions.text import to_date
from cashloom.operators.lookup import BROADCAST_BYTES, HOT_ROWS, lookup
from cashloom.sources.market import DATED_KINDS, readable_points


def with_series(market: DataFrame, kinds: tuple[str, ...] = DATED_KINDS) -> DataFrame:
    """Add ``series``: the object's observations in date order, indexed by month; else null.

    ``series.counts`` holds, for every month from the first observation to the last, how many
    observations lie up to the end of that month. A date therefore finds its place from its
    month number and a look at the observations of that one month. An object with a date or number
    that does not read, or with more of one than the other, has no series.
    """
    pairs = f"zip_with(points, values, (p, v) -> named_struct('date', {to_date('p')}, 'value', v))"
    ranked = f"transform({pairs}, (o, i) -> named_struct('date', o.date, 'rank', i, 'value', o.value))"
    usable = let("__all", ranked, f"if({readable_points('__all', 'date', 'value')}, sort_array(__all), NULL)")
    # An observation opens as many months as pass until the next one; the last closes its own.
    next_month = month_number("get(observations, i + 1).date")
    months = f"coalesce({next_month} - {month_number('o.date')}, 1)"
    series = (
        "named_struct('dates', observations.date, 'values', observations.value,"
        f" 'counts', flatten(transform(observations, (o, i) -> array_repeat(i + 1, {months}))),"
        f" 'first_month', {month_number('get(observations, 0).date')})"
    )
    observed = market.selectExpr(
        "*", f"if(kind IN ({quoted_list(kinds)}), {usable}, NULL) AS observations"
    )
    return observed.withColumn("series", F.expr(f"if(size(observations) > 0, {series}, NULL)")).drop("observations")


def as_of(series: str, date: str) -> str:
    """The series value in force at ``date``; null before the first observation."""
    upto = f"coalesce(get({series}.counts, __month), size({series}.dates))"
    same_month = f"slice({series}.dates, __earlier + 1, {upto} - __earlier)"
    seen = f"__earlier + size(filter({same_month}, __day -> __day <= {date}))"
    earlier = f"coalesce(get({series}.counts, least(__month, size({series}.counts)) - 1), 0)"
    value = let("__earlier", earlier, f"get({series}.values, {seen} - 1)")
    return let("__month", f"{month_number(date)} - {series}.first_month", f"if(__month >= 0, {value}, NULL)")


def asof_join(
    probes: DataFrame,
    market: DataFrame,
    code: str,
    date: str,
    value: str,
    limit: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``probes`` plus the value at ``date`` of the series named by ``code``."""
    table = with_series(market).selectExpr(f"code AS {code}", "series")
    found = lookup(probes, table, [code], limit, hot_rows)
    return found.withColumn(value, F.expr(as_of("series", date))).drop("series")
