"""Appending by named batches, each of which comes in once and as a whole.

A batch is written to a folder that only this attempt knows, and is there for readers from the moment
that its manifest is moved to its name: a rename that fails if the name is taken. So a job that is run
again adds nothing, of two that run at once one adds, and what a broken job has written is never read.
Readers take the folders that manifests name. They list and read one small file a batch.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashloom.sources.sinks import text_writer

MANIFESTS, DATA = "_batches", "data"
TEXT_KINDS = ("csv", "json", "text")


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _file_name(batch: str) -> str:
    if not batch:
        raise ValueError("a batch has a name")
    return "batch-" + quote(batch, safe="").replace("%", "+")


def is_published(spark: SparkSession, folder: str, batch: str) -> bool:
    target, system = _path(spark, f"{folder}/{MANIFESTS}/{_file_name(batch)}")
    return system.exists(target)


def written(rows: DataFrame, folder: str, batch: str, kind: str = "csv") -> str:
    """``rows`` in a folder of this attempt, which no reader sees; its path below ``folder``."""
    part = f"{DATA}/{_file_name(batch)}/{uuid.uuid4().hex}"
    writer = text_writer(rows) if kind in TEXT_KINDS else rows.write
    writer.format(kind).save(f"{folder}/{part}")
    return part


def published(spark: SparkSession, folder: str, batch: str, part: str) -> bool:
    """Make the attempt at ``part`` the batch; false if the batch is there already."""
    target, system = _path(spark, f"{folder}/{MANIFESTS}/{_file_name(batch)}")
    draft, _ = _path(spark, f"{folder}/{MANIFESTS}/.{uuid.uuid4().hex}")
    out = system.create(draft, False)
    out.write(part.encode())
    out.close()
    options = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, target, options)
    except Exception:
        system.delete(draft, False)
        if not system.exists(target):
            raise
        return False
    return True


def append_once(rows: DataFrame, folder: str, batch: str, kind: str = "csv") -> bool:
    """Add ``rows`` as the batch of that name; false, and nothing added, if there is one."""
    spark = rows.sparkSession
    if is_published(spark, folder, batch):
        return False
    part = written(rows, folder, batch, kind)
    if published(spark, folder, batch, part):
        return True
    target, system = _path(spark, f"{folder}/{part}")
    system.delete(target, True)
    return False


def batches(spark: SparkSession, folder: str) -> list[str]:
    """The folders of all batches, one for each."""
    target, system = _path(spark, f"{folder}/{MANIFESTS}")
    if not system.exists(target):
        return []
    manifests = spark.read.option("wholetext", True).option("pathGlobFilter", "batch-*").text(str(target.toString()))
    return sorted(f"{folder}/{row.value}" for row in manifests.select(F.trim("value").alias("value")).collect())


def read_batches(spark: SparkSession, folder: str, schema: str, kind: str = "csv") -> DataFrame:
    """The rows of all batches that are there, none if there are none."""
    paths = batches(spark, folder)
    return spark.read.schema(schema).format(kind).load(paths) if paths else spark.createDataFrame([], schema)
