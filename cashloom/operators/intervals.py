"""Joins of points with the intervals that hold them, without comparing all with all.

Intervals are put on a grid whose cells are as wide as they are: one of length up to ``width * 2**n`` goes to
level n, where it meets two cells at most, so that wide and narrow intervals cost the same. A point is in
one cell of each level that its key has intervals of. Cells are joined by equality and the ends are checked in it;
a point and an interval share one cell of one level, so every pair comes once.

A cell of more than ``hot_rows`` points is dealt over as many groups as that takes, with a copy of its
intervals in each. Points are long numbers; ``lo`` belongs to an interval and ``hi`` doesn't.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashloom.operators.lookup import HOT_ROWS, lookup
from cashloom.session import stored


def on_levels(points: DataFrame, given: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``points`` once for each ``__level``, 65 at most, that the intervals ``given`` of their keys have."""
    if not on:
        levels = sorted(row["__level"] for row in given.select("__level").distinct().collect())
        return points.withColumn("__level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    of_key = stored(given.groupBy(*on).agg(F.collect_set("__level").alias("__levels")), "levels")
    found = lookup(points, of_key, list(on), hot_rows=hot_rows)
    # not the inner form, of which the optimizer makes a filter on the levels
    each = found.select(*points.columns, F.explode_outer("__levels").alias("__level"))
    return each.where("__level IS NOT NULL")


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    on: Sequence[str],
    x: str,
    lo: str,
    hi: str,
    width: int = 1,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every row of ``points`` with every interval of equal ``on`` for which ``lo <= x < hi``.

    The other columns of ``intervals`` are added; points that no interval holds are left out. Intervals
    that are empty or have a null end hold nothing, and a null key or ``x`` matches nothing. ``width`` is
    about the shortest length.
    """
    if width < 1:
        raise ValueError("cells are at least one wide")
    added = [c for c in intervals.columns if c not in on]
    # decimals, for neither a length nor a point over a width may fit a long
    length = f"cast(cast(`{hi}` AS decimal(20, 0)) - `{lo}` AS double) / {width}D"
    level = f"cast(greatest(0, ceil(log2({length}))) AS int)"

    def cell(value: str) -> str:
        return f"cast(floor(cast({value} AS decimal(20, 0)) / ({width} * cast(pow(2D, __level) AS decimal(20, 0)))) AS bigint)"

    given = stored(
        intervals.where(f"`{lo}` < `{hi}`").select(*on, F.struct(*added).alias("__interval"), F.expr(level).alias("__level")), "intervals"
    )
    there = " AND ".join(f"`{c}` IS NOT NULL" for c in [*on, x])
    placed = on_levels(points.where(there), given, on, hot_rows).withColumn("__cell", F.expr(cell(f"`{x}`")))
    ends = (cell(f"__interval.`{lo}`"), cell(f"(__interval.`{hi}` - 1)"))
    gridded = given.withColumn("__cell", F.explode(F.expr(f"sequence({ends[0]}, {ends[1]})")))
    keys = [*on, "__level", "__cell"]
    # at most one cell for hot_rows rows
    hot = placed.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / hot_rows).cast("int").alias("__groups")).where("__groups > 1")
    hot = F.broadcast(hot)
    groups = F.coalesce("__groups", F.lit(1))
    content = F.xxhash64(*[c for c, kind in points.dtypes if "map" not in kind])
    dealt = placed.join(hot, keys, "left").withColumn("__group", F.pmod(content, groups).cast("int")).drop("__groups")
    copies = gridded.join(hot, keys, "left").withColumn("__group", F.explode(F.sequence(F.lit(0), groups - 1))).drop("__groups")
    met = dealt.join(copies, [*keys, "__group"])
    inside = met.where(f"`{x}` >= __interval.`{lo}` AND `{x}` < __interval.`{hi}`")
    return inside.select(*points.columns, *[F.col(f"__interval.`{c}`").alias(c) for c in added])
