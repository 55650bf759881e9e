"""Ordered work within keys on tables of any skew: running sums and last values over rows.

Rows of one key are gone through in order, as by a window; but a key of more than some ``hot_rows`` rows
is cut into splits of about that many, by a sample of its order, and the window runs within each. What
a split ends with is then carried into those after it: one row a split, of the cut keys only, which is
at most some ``count / hot_rows`` rows. No task holds a key whole unless it is small, and keys that are
not cut cost one exchange.

The order is a long column ``at``, and ``order`` may list what decides between rows of one ``at``; rows that
nothing tells apart come in any order. Null keys are a key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashloom.operators.lookup import HOT_ROWS, fits_broadcast
from cashloom.session import materialised

# Rows sampled for each split that a key is cut into.
SAMPLED = 20
SPLIT, CUT = "__split", "__cut"


def with_splits(
    rows: DataFrame,
    keys: Sequence[str],
    at: str,
    hot_rows: int = HOT_ROWS,
    later: Column | None = None,
    spread: Column | None = None,
) -> DataFrame:
    """``rows`` with ``__split``, which grows with ``at`` within the ``keys``, and ``__cut``: whether there are several.

    Rows at a place where the key is cut lie before it, or after it where ``later`` is true. Where a key
    is cut several times at one place, the rows there with a true ``spread`` are dealt over the splits
    between the cuts by their content; the others of that place stay together.
    """
    each = max(1, min(SAMPLED, hot_rows))
    some = rows if each >= hot_rows else rows.where(F.rand(42) < each / hot_rows)
    places = F.sort_array(F.collect_list(at)).alias("places")
    sampled = some.groupBy(*[F.col(k).alias(f"__of_{k}") for k in keys]).agg(places).where(F.size("places") > each)
    taken = f"transform(sequence(1, cast(ceil(size(places) / {each}D) AS int) - 1), i -> places[i * {each} - 1])"
    # stored, so that every use of it cuts alike: at most one key for about hot_rows rows
    cuts = _small(materialised(sampled.withColumn("__cuts", F.expr(taken)).drop("places")))
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"__of_{key}"))
    low, high = (F.expr(cuts_before("__cuts", f"`{at}`", sign)) for sign in ("<", "<="))
    place = low if later is None else F.when(later, high).otherwise(low)
    if spread is not None:
        content = F.xxhash64(*[c for c, kind in rows.dtypes if "map" not in kind])
        place = F.when(spread, low + F.pmod(content, high - low + 1).cast("int")).otherwise(place)
    joined = rows.join(cuts, same, "left")
    split = F.when(F.col("__cuts").isNull(), 0).otherwise(place).cast("int").alias(SPLIT)
    return joined.select(*rows.columns, split, F.col("__cuts").isNotNull().alias(CUT))


def cuts_before(cuts: str, at: str, sign: str) -> str:
    """How many of the ordered ``cuts`` are ``<`` or ``<=`` a place, found by halving: a key of many rows has many cuts."""
    strides = f"transform(sequence(length(bin(size({cuts}))) - 1, 0, -1), bit -> shiftleft(1, bit))"
    passed = f"found + stride <= size({cuts}) AND get({cuts}, found + stride - 1) {sign} {at}"
    return f"aggregate({strides}, 0, (found, stride) -> if({passed}, found + stride, found))"


def _small(table: DataFrame) -> DataFrame:
    """To be broadcast if its measured size allows; with a small ``hot_rows`` as many keys as rows may be cut."""
    return F.broadcast(table) if fits_broadcast(table) else table


def _carried(rows: DataFrame, keys: Sequence[str], ends: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``name`` of ``ends``, which has a row for each split of the keys that were cut."""
    few = _small(materialised(ends.select(*[F.col(k).alias(f"__of_{k}") for k in keys], F.col(SPLIT).alias("__of_split"), name)))
    same = F.col(SPLIT) == F.col("__of_split")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"__of_{key}"))
    return rows.join(few, same, "left").select(*rows.columns, name)


def with_last(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], values: dict[str, str]) -> DataFrame:
    """Add for each name the last value of a column, nulls left out, in the rows before the row.

    ``rows`` come from ``with_splits``; ``order`` begins with its ``at``. ``values`` maps names to columns.
    """
    before = Window.partitionBy(*keys, SPLIT).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys, SPLIT).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    near = rows.select("*", *[F.last(c, True).over(before).alias(n) for n, c in values.items()])
    tails = rows.where(CUT).select(*keys, SPLIT, *[F.last(c, True).over(whole).alias(n) for n, c in values.items()])
    per_split = tails.groupBy(*keys, SPLIT).agg(*[F.first(n).alias(n) for n in values])
    earlier = Window.partitionBy(*keys).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    carry = F.struct(*[F.last(n, True).over(earlier).alias(n) for n in values])
    filled = _carried(near, keys, per_split.withColumn("__carry", carry), "__carry")
    others = [c for c in filled.columns if c not in values and c != "__carry"]
    return filled.select(*others, *[F.coalesce(n, f"__carry.{n}").alias(n) for n in values])


def with_running(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, closes: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` up to the row, begun anew after each row that ``closes``.

    ``rows`` come from ``with_splits``; null values count as zero, and a null ``closes`` as false.
    """
    within = Window.partitionBy(*keys, SPLIT).orderBy(*order)
    closing = F.coalesce(F.col(closes), F.lit(False)).cast("int")
    amount = F.coalesce(F.col(value), F.lit(0.0))
    closed = F.coalesce(F.sum(closing).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    of_stretch = Window.partitionBy(*keys, SPLIT, "__stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = rows.withColumn("__stretch", closed).withColumn(name, F.sum(amount).over(of_stretch))
    # first the rows of cut keys, then the window: a filter behind it would leave it all rows
    stretched = rows.where(CUT).withColumn("__stretch", closed)
    tails = stretched.groupBy(*keys, SPLIT, "__stretch").agg(F.sum(amount).alias("__sum"), F.max(closing).alias("__closed"))
    # a stretch that was not closed is the split's last, and goes on in the next split
    per_split = tails.groupBy(*keys, SPLIT).agg(
        F.sum(F.when(F.col("__closed") == 0, F.col("__sum")).otherwise(0.0)).alias("__tail"), F.max("__closed").alias("__closed")
    )
    along = Window.partitionBy(*keys).orderBy(SPLIT)
    grouped = per_split.withColumn("__group", F.sum("__closed").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    so_far = Window.partitionBy(*keys, "__group").orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = grouped.withColumn("__out", F.sum("__tail").over(so_far)).withColumn("__carry", F.lag("__out").over(along))
    filled = _carried(near, keys, out, "__carry")
    carried = F.when(F.col("__stretch") == 0, F.coalesce("__carry", F.lit(0.0))).otherwise(0.0)
    return filled.withColumn(name, F.col(name) + carried).drop("__stretch", "__carry")


def asof_rows(
    probes: DataFrame,
    observations: DataFrame,
    keys: Sequence[str],
    at: str,
    values: Sequence[str],
    strict: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``probes`` with the ``values`` of the last observation of their keys on or before ``at``; ``strict``: before it.

    Both tables have the ``keys`` and the long ``at``, and may be of any size: they are merged in order of
    ``at``. Of several observations at one place the one with the greatest values counts. A null key or
    place matches nothing, and a probe with one stays where it is.
    """
    there = " AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, at])
    seen = F.struct(*values)
    points = observations.where(there).groupBy(*keys, at).agg(F.max(seen).alias("__seen"))
    asked = probes.where(there).select(*keys, at, F.struct(*probes.columns).alias("__row"), F.lit(True).alias("__asks"))
    merged = asked.unionByName(points.withColumn("__asks", F.lit(False)), allowMissingColumns=True)
    cut = with_splits(merged, keys, at, hot_rows, later=~F.col("__asks") if strict else None, spread=F.col("__asks"))
    order = [F.col(at), F.col("__asks").desc() if strict else F.col("__asks").asc()]
    found = with_last(cut, keys, order, {"__found": "__seen"}).where("__asks")
    taken = [f"__found.`{v}`" for v in values]
    here = found.select("__row.*", *[F.col(t).alias(v) for t, v in zip(taken, values)])
    none = [F.lit(None).cast(observations.schema[v].dataType).alias(v) for v in values]
    return here.unionByName(probes.where(f"NOT ({there})").select("*", *none))
