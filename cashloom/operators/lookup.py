"""Left lookup joins whose small side is broadcast only when its measured size allows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashloom.functions import quoted_list
from cashloom.sources.market import RATE_KINDS, REFERENCE_INDEX

BROADCAST_BYTES = 256 * 1024 * 1024
# Rows of one key that one task joins.
HOT_ROWS = 1_000_000


def row_bytes(schema: T.StructType) -> str:
    """Bytes a row of this schema holds: text by its length, anything else in 8-byte words."""

    def size(value: str, kind: T.DataType, depth: int = 0) -> str:
        if isinstance(kind, T.StructType):
            return " + ".join(["8", *[size(f"{value}.{f.name}", f.dataType, depth) for f in kind]])
        if isinstance(kind, T.StringType):
            return f"coalesce(octet_length({value}), 0) + 16"
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StringType, T.StructType, T.ArrayType)):
            item = f"item{depth}"
            inner = size(item, kind.elementType, depth + 1)
            return f"coalesce(aggregate({value}, 0L, (total, {item}) -> total + {inner}), 0) + 24"
        if isinstance(kind, T.ArrayType):
            return f"coalesce(size({value}), 0) * 8 + 24"
        return "8"

    return " + ".join(["16L", *[size(f"`{f.name}`", f.dataType) for f in schema]])


def fits_broadcast(frame: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    if limit <= 0:
        return False  # nothing to measure
    total = frame.selectExpr(f"sum({row_bytes(frame.schema)})").first()[0]
    return (total or 0) <= limit


def lookup(
    rows: DataFrame, table: DataFrame, on: list[str], limit: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``rows`` with the matching row of ``table``, or nulls; a null key matches nothing.

    A table within ``limit`` is broadcast, so ``rows`` are not moved. A larger one is joined by
    sort-merge, and then rows without a key stay where they are, and a key of more than
    ``hot_rows`` rows is spread over as many groups as that takes, by a hash of their content,
    which is the same when a lost task is run again. The table's row goes to each of the groups.
    """
    if fits_broadcast(table, limit):
        return rows.join(F.broadcast(table), on, "left")
    here = " AND ".join(f"{key} IS NOT NULL" for key in on)
    keyed = rows.where(here)
    # at most one key for hot_rows rows, which bounds what is broadcast
    hot = keyed.groupBy(*on).agg(F.count("*").alias("__n")).where(F.col("__n") > hot_rows)
    hot = F.broadcast(hot.select(*on, F.ceil(F.col("__n") / hot_rows).cast("int").alias("__groups")))
    groups = F.coalesce("__groups", F.lit(1))
    content = F.xxhash64(*[c for c in rows.columns if "map" not in dict(rows.dtypes)[c]])
    salted = keyed.join(hot, on, "left").withColumn("__salt", F.pmod(content, groups).cast("int")).drop("__groups")
    copies = table.join(hot, on, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), groups - 1)))
    found = salted.join(copies.drop("__groups"), [*on, "__salt"], "left").drop("__salt")
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema if f.name not in on]
    return found.unionByName(rows.where(f"NOT ({here})").select("*", *added))


def with_reset_object(contracts: DataFrame, market: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The market object named by ``reset_code``: ``reset_kind, reset_points, reset_values``."""
    table = market.selectExpr(
        "code AS reset_code", "kind AS reset_kind", "points AS reset_points", "values AS reset_values"
    )
    return lookup(contracts, table, ["reset_code"], limit)


def with_scaling_object(contracts: DataFrame, market: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The market object named by ``scaling_code``, independent of the reset lookup.

    Its values are handed on only if it is an index; ``scaling_kind`` shows what was found.
    """
    is_index = f"kind = '{REFERENCE_INDEX}'"
    table = market.selectExpr(
        "code AS scaling_code",
        "kind AS scaling_kind",
        f"if({is_index}, points, NULL) AS scaling_points",
        f"if({is_index}, values, NULL) AS scaling_values",
    )
    return lookup(contracts, table, ["scaling_code"], limit)


def reset_status() -> str:
    """How the reset lookup ended, from ``reset_code`` and ``reset_kind``."""
    return _status("reset_code", "reset_kind", RATE_KINDS)


def scaling_status() -> str:
    return _status("scaling_code", "scaling_kind", (REFERENCE_INDEX,))


def _status(code: str, kind: str, usable: tuple[str, ...]) -> str:
    return (
        f"CASE WHEN {code} IS NULL THEN 'none' WHEN {kind} IS NULL THEN 'missing'"
        f" WHEN {kind} NOT IN ({quoted_list(usable)}) THEN 'unsupported_type' ELSE 'ok' END"
    )
