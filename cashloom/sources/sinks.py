"""Writers of results, and the readers that bring them back.

Text is written as gzip files, which events fill to a seventh and every reader of text takes. Such a file can't be
split, so a task begins another one after so many rows, and what it wrote is read by several.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F


# Rows of a file: flat ones, and nested ones, which hold a contract's events.
FLAT_ROWS, NESTED_ROWS = 4_000_000, 250_000


def text_writer(rows: DataFrame, most: int = FLAT_ROWS) -> DataFrameWriter:
    """A writer of compressed text, at the level that takes about as long as writing plain text."""
    options = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": most}
    return rows.write.options(**options)


def write_text_rows(rows: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON text line per row; nested columns are welcome."""
    text_writer(rows.select(F.to_json(F.struct("*")).alias("value")), NESTED_ROWS).mode(mode).text(path)


def read_text_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    lines = spark.read.text(path)
    return lines.select(F.from_json("value", schema).alias("row")).select("row.*")


def append_csv(rows: DataFrame, path: str) -> None:
    """Add flat rows to a CSV folder. Arrays have no place in CSV and are refused by Spark."""
    text_writer(rows).mode("append").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path)
