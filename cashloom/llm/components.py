"""Connected components of a graph given as links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashloom.llm.storage import drop_path, new_path


def _written(frame: DataFrame, old: str | None) -> tuple[DataFrame, str]:
    """``frame`` written and read back; the table it was made from goes."""
    spark = frame.sparkSession
    path = new_path(spark, "links")
    frame.write.parquet(path)
    if old:
        drop_path(spark, old)
    return spark.read.schema(frame.schema).parquet(path), path


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours linked to the smallest one around it: the larger ones, or the others."""
    if large:
        around = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    moved = around.join(least, "a")
    if large:
        pairs = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        pairs = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return pairs.where("a <> b").distinct()


def _settled(links: DataFrame) -> bool:
    """Whether every node has one link, to a node that has none: then the links are the result."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return nodes.where("out > 1 OR (out = 1 AND into = 1)").limit(1).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node it is linked with) of every node in ``links`` (a, b).

    Nulls and links of a node with itself are left out. Every round keeps at most one link a node and
    neighbour, and is written to the shared folder; rounds grow with the logarithm of the longest path.
    """
    first = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, path = _written(first, None)
    while not _settled(now):
        now, path = _written(_stars(_stars(now, large=True), large=False), path)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
