"""Intermediate tables of the operators, in the folder that the whole cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: The white space of the text contracts: blank, and tab to carriage return.
SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or set on the context."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses; removed when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` written once and read back: its lineage is cut and its rows no longer change.

    The table outlives lost executors, which a cached frame does not.
    """
    path = new_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def hash_sample(frame: DataFrame, columns: list[str], count: int, size: int) -> DataFrame:
    """About ``size`` of the ``count`` rows, by the hash of ``columns``: the same rows in every run.

    Tasks leave out the others, so that a limit above doesn't bring ``size`` rows of each to the driver.
    """
    if count <= size:
        return frame
    return frame.where(F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) < -(-(size << 40) // count))
