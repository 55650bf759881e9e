"""Share of points of the square [-1, 1) x [-1, 1) inside the unit circle, times four."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: points per slice.
POINTS_PER_SLICE = 100_000


def random_points(spark: SparkSession, slices: int = 2, seed: int = 0) -> DataFrame:
    """``x, y`` drawn uniformly, ``slices`` partitions of equal size."""
    ids = spark.range(0, POINTS_PER_SLICE * slices, 1, slices)
    return ids.select((F.rand(seed) * 2 - 1).alias("x"), (F.rand(seed + 1) * 2 - 1).alias("y"))


def spread_points(rows: DataFrame, x: str, y: str) -> DataFrame:
    """``x, y`` from two numbers of each row, by their fractional parts; the same on every run."""
    return rows.selectExpr(f"{x} AS a", f"{y} AS b").selectExpr(
        "(a - floor(a)) * 2 - 1 AS x", "(b - floor(b)) * 2 - 1 AS y"
    )


def hit_ratio(points: DataFrame) -> DataFrame:
    """One row ``hits, n, ratio``."""
    totals = points.selectExpr("sum(if(x * x + y * y < 1, 1, 0)) AS hits", "count(*) AS n")
    return totals.selectExpr("hits", "n", "4D * hits / n AS ratio")
