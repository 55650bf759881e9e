"""Tables kept by code, so that those written alike are joined without moving either.

``store_by_code`` writes a table in buckets of its code. Two tables in as many buckets meet bucket by bucket,
each in one task, so rows of a code that many have, and those without one, would make a bucket too
large or are of no use there: they are kept in a second table beside it, which ``lookup_stored`` joins with the
few objects that it needs, by a size-checked lookup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashloom.operators.lookup import BROADCAST_BYTES, HOT_ROWS, lookup

OTHERS = "_others"


def store_by_code(rows: DataFrame, code: str, name: str, location: str, buckets: int, hot_rows: int = HOT_ROWS) -> None:
    """Write ``rows`` as the tables ``name`` and ``name_others`` below ``location``.

    Codes of more than ``hot_rows`` rows, and rows without a code, go to the second.
    """
    hot = rows.where(f"`{code}` IS NOT NULL").groupBy(code).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_rows)
    marked = rows.join(F.broadcast(hot), code, "left").withColumn("__apart", F.col("__n").isNotNull() | F.col(code).isNull())
    marked = marked.select(*rows.columns, "__apart")
    regular = marked.where("NOT __apart").drop("__apart").repartition(buckets, code)
    regular.write.bucketBy(buckets, code).sortBy(code).option("path", f"{location}/by_code").format("parquet").saveAsTable(name)
    marked.where("__apart").drop("__apart").write.option("path", f"{location}/others").format("parquet").saveAsTable(name + OTHERS)


def drop_stored(spark: SparkSession, name: str) -> None:
    for table in (name, name + OTHERS):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def lookup_stored(spark: SparkSession, rows: str, objects: str, code: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The stored table ``rows`` with the matching row of the stored table ``objects``, or nulls.

    Both were written by ``code`` in the same number of buckets; ``objects`` has one row a code.
    """
    regular = spark.table(rows).hint("merge").join(spark.table(objects), code, "left")
    others = spark.table(rows + OTHERS)
    codes = others.where(f"`{code}` IS NOT NULL").select(code).distinct()
    # as few as there are codes of many rows
    needed = spark.table(objects).join(F.broadcast(codes), code, "left_semi")
    return regular.unionByName(lookup(others, needed, [code], limit))
