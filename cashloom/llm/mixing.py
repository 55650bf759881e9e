"""Mixing sources to target weights by repeating or leaving out whole documents.

The tokens of each source are added up, targets follow from the weights, and a source's rate is its
target over its size. Every document is taken floor(rate) times, and once more if a number drawn from
a hash lies below the fraction, so that a rerun draws the same.

The number drawn is decided by the id, the MD5 of the text, and which one it is of the rows that share
these and the source: the first 13 hex digits of the MD5 of ``seed:id:md5 of the text:n``, over 16**13, a
null id written as ``null`` and a null text as the empty one. So documents without an id, or with one
that others have too, draw each for itself, and rows that are equal in all of this are numbered from
1; which of them is which makes no difference, as they are interchangeable to the mix.

Defined results: a null text has no words; a null source is a source of its own and comes last; a
source without words has target and rate zero; an empty table gives an empty one. One row a source is
brought together in a task, never the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashloom.llm.storage import WORD, stored

WEIGHTS = (3, 1, 2)
#: All targets together, over all sizes; a source's target over its size at most.
SHARE, MOST = 1.5, 2.0
SEED = "mix-1"
#: Hex digits of the hash that make the number drawn; a double holds 13 exactly.
DIGITS = 13


def words(text: Column) -> Column:
    """The number of words of a text, zero for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def drawn(doc_id: Column, text_md5: Column, number: Column, seed: str = SEED) -> Column:
    """A number of 0 to 1 that the id, the hash of the text and the number among equal rows decide."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")), text_md5, number.cast("string"))
    digits = F.substring(F.md5(F.encode(key, "UTF-8")), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(16**DIGITS))


def text_md5(text: Column) -> Column:
    return F.md5(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def numbered(docs: DataFrame, same: list[Column], name: str) -> DataFrame:
    """``docs`` with ``name``: 1, 2 and so on among the rows that agree in ``same``, 1 in all others.

    Only keys that occur again are looked at any further. Their rows are added up where they are equal
    in every column and written out as often again, so that a key of any number of equal rows is a
    few rows in the exchange, and no task numbers them one by one.
    """
    keys = [c.alias(f"__mix_same{k}") for k, c in enumerate(same)]
    names = [f"__mix_same{k}" for k in range(len(same))]
    again = stored(docs.select(*keys).groupBy(*names).count().where("count > 1").drop("count"), "repeated")
    if again.isEmpty():
        return docs.withColumn(name, F.lit(1).cast("long"))
    columns = docs.columns
    found = docs.select("*", *keys).alias("d")
    test = F.lit(True)
    for n in names:
        test = test & F.col(f"d.{n}").eqNullSafe(F.col(f"r.{n}"))
    single = found.join(again.alias("r"), test, "left_anti").select(*columns).withColumn(name, F.lit(1).cast("long"))
    equal = found.join(again.alias("r"), test, "left_semi").groupBy(*columns, *names).agg(F.count(F.lit(1)).alias("__mix_n"))
    order = Window.partitionBy(*names).orderBy(F.xxhash64(*columns), "__mix_n")
    before = F.coalesce(F.sum("__mix_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = equal.withColumn("__mix_before", before)
    each = F.explode(F.expr("sequence(__mix_before + 1, __mix_before + __mix_n)"))
    return single.unionByName(placed.withColumn(name, each).select(*columns, name))


def rates(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """source, source_size, target, rate for each source of ``sizes`` (source, size).

    Sources in code point order have the ``weights`` in turn. A target beyond ``most`` times its source
    stops there and the excess goes to the others by weight: with the sources in order of the level at
    which they stop, the first whose share of what the earlier ones leave is below its limit, and all
    after it, get that level times their weight.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    ranked = (
        totals.withColumn("weight", weight.cast("double"))
        .withColumn("limit", F.col("source_size") * F.lit(float(most)))
        .withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("level", F.col("limit") / F.col("weight"))
    )
    before = F.coalesce(F.sum("limit").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    tried = ranked.withColumn("tried", (F.col("budget") - before) / left)
    fits = F.when(F.col("tried") <= F.col("level"), F.col("tried"))
    target = F.least("limit", F.coalesce(F.max(fits).over(every) * F.col("weight"), F.col("limit")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return tried.withColumn("target", target).select("source", "source_size", "target", rate.alias("rate"))


def mixed(
    docs: DataFrame,
    size: Column | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = SEED,
    text: str = "text",
) -> DataFrame:
    """``docs`` with ``mix``: a struct of size, source_size, target, rate and copies.

    ``size`` is the number of words of ``text`` by default. The rates are stored, one row a source, so
    that their size is known where they are joined. Columns whose names begin with ``mix`` are replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.startswith("mix")])
    sized = F.coalesce(words(F.col(text)) if size is None else size, F.lit(0)).cast("long")
    found = rates(docs.select(F.col(source).alias("source"), sized.alias("size")), weights, share, most)
    known = stored(found, "rates").select(F.col("source").alias("__mix_source"), F.struct("source_size", "target", "rate").alias("__mix_rate"))
    given = numbered(docs, [F.col(doc_id), text_md5(F.col(text)), F.col(source)], "__mix_number")
    joined = given.join(known, F.col(source).eqNullSafe(F.col("__mix_source")))
    rate = F.col("__mix_rate.rate")
    draw = drawn(F.col(doc_id), text_md5(F.col(text)), F.col("__mix_number"), seed)
    copies = F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")
    mix = F.struct(
        sized.alias("size"),
        F.col("__mix_rate.source_size").alias("source_size"),
        F.col("__mix_rate.target").alias("target"),
        rate.alias("rate"),
        copies.cast("long").alias("copies"),
    )
    return joined.withColumn("mix", mix).drop("__mix_source", "__mix_rate", "__mix_number")


def copied(mix: DataFrame) -> DataFrame:
    """The documents of ``mixed`` themselves, each as often as it is taken."""
    repeated = F.explode(F.array_repeat(F.lit(0), F.col("mix.copies").cast("int"))).alias("__mix_copy")
    return mix.select("*", repeated).drop("mix", "__mix_copy")
