"""Catalog tables through SQL: create if absent, insert, select."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cashloom.functions import quoted


def create_table(spark: SparkSession, name: str, columns: str, location: str | None = None) -> None:
    """Create a parquet table unless there is one; ``location`` puts it outside the warehouse."""
    place = f" LOCATION {quoted(location)}" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_named(name)} ({columns}) USING parquet{place}")


def insert_rows(rows: DataFrame, name: str) -> None:
    """Append the rows by position, as ``INSERT INTO`` does."""
    rows.sparkSession.sql(f"INSERT INTO TABLE {_named(name)} SELECT * FROM {{rows}}", rows=rows)


def select_all(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {_named(name)}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Take a table out of the catalog; files at a location of its own stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_named(name)}")


def _named(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))
