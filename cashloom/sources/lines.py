"""Text lines with their place in the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line: ``value`` and ``place``, which sorts in reading order.

    The place holds the file, the start of the split and a counter that only grows inside a
    split, so it is the same however the splits are spread over tasks.
    """
    return spark.read.text(path).select("value", _place().alias("place"))


def _place() -> Column:
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def lines_from(spark: SparkSession, texts: list[str], partitions: int = 2) -> DataFrame:
    """Lines held by the caller, in a chosen number of partitions."""
    rows = [(text, number) for number, text in enumerate(texts)]
    return spark.createDataFrame(rows, "value string, place long").repartition(partitions)
