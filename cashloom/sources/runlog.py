"""Run log: one comma-separated record per run, appended to a shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cashloom.sources.batches import append_once, read_batches
from cashloom.sources.sinks import append_csv, read_csv

# Fields of a record, in file order.
RUN_FIELDS = ["class_name", "output", "ram", "contracts", "risk_factors", "nodes", "run"]
RUN_SCHEMA = ", ".join(f"{name} string" for name in RUN_FIELDS) + ", elapsed bigint"


def run_records(runs: DataFrame) -> DataFrame:
    """Records of runs given with ``start`` and ``stop``."""
    texts = [f"cast({name} AS string) AS {name}" for name in RUN_FIELDS]
    return runs.selectExpr(*texts, "cast(stop AS bigint) - cast(start AS bigint) AS elapsed")


def append_runs(runs: DataFrame, path: str) -> None:
    append_csv(run_records(runs), path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, RUN_SCHEMA)


def append_runs_once(runs: DataFrame, folder: str, batch: str) -> bool:
    """The records as a batch of that name, which a job that runs again does not add twice."""
    return append_once(run_records(runs), folder, batch)


def read_runs_once(spark: SparkSession, folder: str) -> DataFrame:
    return read_batches(spark, folder, RUN_SCHEMA)
