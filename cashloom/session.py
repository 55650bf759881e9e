"""Shared storage of a session: where intermediate tables and written files go."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# HotSpot leaves methods of more bytecode uncompiled. A wide projection fused into one method
# beyond this size is slower than the same expressions in several, which Spark then generates.
COMPILED_METHOD_BYTES = 8000


def configure(spark: SparkSession) -> SparkSession:
    """Settings of a running session that contract evaluation profits from."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED_METHOD_BYTES)
    return spark


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows over all cores if a small input has fewer splits' worth of bytes than there are cores.

    A larger one is left where it is. The size is the optimizer's estimate of the input.
    """
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes").lower()
    )
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return rows if size >= cores * split else rows.repartition(cores, *keys)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or set on the context."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if folder is None:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def use_temporary_folder(spark: SparkSession) -> None:
    """For runs on one machine: a shared folder of this process, if none is set, gone at its end."""
    context = spark.sparkContext
    unset = spark.conf.get(CHECKPOINT_DIR, None) is None and context.getCheckpointDir() is None
    if unset and context.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="cashloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses; not created yet.

    What is written there is removed when the driver's JVM ends.
    """
    folder = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return folder


def drop_folder(spark: SparkSession, folder: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialised(frame: DataFrame) -> DataFrame:
    """``frame`` computed once and read back from shared storage, with its lineage cut."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint()


def stored(frame: DataFrame, label: str) -> DataFrame:
    """``frame`` computed once and read back from columns in shared storage, so that a reader takes those it needs."""
    return stored_at(frame, new_folder(frame.sparkSession, label))


def stored_at(frame: DataFrame, folder: str) -> DataFrame:
    """``stored`` in a folder of its own, for one who drops it when it has been read."""
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)
