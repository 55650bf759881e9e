"""Exact deduplication by content-defined chunk recipes.

A text without white space is cut where its own characters say so, each chunk gets an identifier that
is verified to stand for one chunk text only, and two texts are equal if their ordered identifier
lists are. Chunk texts are moved once, to be verified, and after partial deduplication; everything
after that handles eight bytes a chunk.

Defined results: a null text counts as empty and empty texts are equal to each other; a null doc_id
sorts after every other; of repeated rows (same text and doc_id) one is kept; an empty table gives an
empty one; other columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashloom.llm.storage import SPACES, stored

#: Characters after which a chunk may end, in pairs: about one pair in two hundred of ordinary prose.
FIRST_OF_CUT, SECOND_OF_CUT = "[bdgkmvxz357的ыκ]", "[aehlnpsw246是йα]"
MIN_CHUNK, MAX_CHUNK = 512, 8192


def normalised(text: Column) -> Column:
    """The text without white space; empty for null."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACES}]+", "")


def chunks(text: Column, low: int = MIN_CHUNK, high: int = MAX_CHUNK) -> Column:
    """Consecutive chunks of ``low`` to ``high`` code points that end at a cut, where one is found.

    Without a cut up to ``high`` the chunk ends there; only the last one may be shorter than ``low``.
    """
    pattern = f"(?s).{{{low - 2},{high - 2}}}?{FIRST_OF_CUT}{SECOND_OF_CUT}|.{{1,{high}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def with_recipes(
    docs: DataFrame,
    text: str = "text",
    fingerprint: Callable[[Column], Column] = F.xxhash64,
    low: int = MIN_CHUNK,
    high: int = MAX_CHUNK,
) -> DataFrame:
    """``docs`` with ``recipe``: the fingerprints of the chunks in order, not verified yet."""
    return docs.withColumn("recipe", F.transform(chunks(normalised(F.col(text)), low, high), lambda c: fingerprint(c)))


def ambiguous_chunks(
    docs: DataFrame,
    text: str = "text",
    fingerprint: Callable[[Column], Column] = F.xxhash64,
    low: int = MIN_CHUNK,
    high: int = MAX_CHUNK,
) -> DataFrame:
    """The chunk texts whose fingerprint another chunk text has too, numbered: h, chunk, variant.

    Each different chunk text is compared with all others of its fingerprint. Two texts in a billion
    billion share one by chance, so that this is nearly always empty, but it is never assumed to be.
    """
    parts = docs.select(F.explode(chunks(normalised(F.col(text)), low, high)).alias("chunk"))
    different = parts.select(fingerprint(F.col("chunk")).alias("h"), "chunk").distinct()
    shared = different.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    shared = stored(shared, "shared-fingerprints")
    if shared.isEmpty():
        return stored(different.limit(0).withColumn("variant", F.lit(0)), "ambiguous-chunks")
    order = Window.partitionBy("h").orderBy("chunk")
    return stored(different.join(shared, "h", "left_semi").withColumn("variant", F.row_number().over(order)), "ambiguous-chunks")


def deduplicated(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    fingerprint: Callable[[Column], Column] = F.xxhash64,
    low: int = MIN_CHUNK,
    high: int = MAX_CHUNK,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, row.

    Of equal texts the one with the most code points in the original, then the smallest doc_id stays.
    ``row`` numbers the rows of ``docs`` as this run has read them.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    recipes = with_recipes(source, "text", fingerprint, low, high).select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.length(F.coalesce("text", F.lit(""))).alias("points"),
        F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256).alias("text_sha256"),
        "recipe",
    )
    recipes = stored(recipes, "recipes")
    ambiguous = ambiguous_chunks(source, "text", fingerprint, low, high)
    recipes = recipes.withColumn("variants", F.array().cast("array<int>"))
    if not ambiguous.isEmpty():
        recipes = _resolved(source, recipes, ambiguous, fingerprint, low, high)
    best = F.max(F.struct("points", F.col("doc_id").isNotNull(), F.bitwise_not("doc_id"), F.bitwise_not("row")))
    groups = recipes.groupBy("recipe", "variants").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
    groups = groups.select(
        F.col("recipe").alias("r"),
        F.col("variants").alias("v"),
        "group_size",
        F.bitwise_not("best.col3").alias("keep_id"),
        F.bitwise_not("best.col4").alias("keep_row"),
    )
    found = recipes.join(groups, (F.col("recipe") == F.col("r")) & (F.col("variants") == F.col("v")))
    return found.select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256", "row"
    )


def unique_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each group of equal texts.

    Which one is as in ``deduplicated``. A document moves once, and only if it is the best of its group
    in its own split.
    """
    ambiguous = ambiguous_chunks(docs.select(F.col(text).alias("text")))
    columns = docs.columns
    packed = docs.select(
        F.struct(*columns).alias("row"),
        F.length(F.coalesce(text, F.lit(""))).alias("points"),
        F.col(doc_id).alias("doc_id"),
        F.transform(chunks(normalised(F.col(text))), lambda c: F.xxhash64(c)).alias("recipe"),
    ).withColumn("variants", F.array().cast("array<int>"))
    if not ambiguous.isEmpty():
        digest = F.sha2(F.encode(normalised(F.col(f"row.`{text}`")), "UTF-8"), 256)
        source = docs.select(F.col(text).alias("text"))
        packed = _resolved(source, packed.withColumn("text_sha256", digest), ambiguous, F.xxhash64, MIN_CHUNK, MAX_CHUNK)
    order = F.struct("points", F.col("doc_id").isNotNull(), F.bitwise_not("doc_id"))
    best = packed.groupBy("recipe", "variants").agg(F.max_by("row", order).alias("row"))
    return best.select("row.*")


def _resolved(
    source: DataFrame,
    recipes: DataFrame,
    ambiguous: DataFrame,
    fingerprint: Callable[[Column], Column],
    low: int,
    high: int,
) -> DataFrame:
    """Recipes with position and variant of each chunk that has an ambiguous fingerprint.

    The digest only brings them from the text to its rows.
    """
    pieces = source.select(
        F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256).alias("text_sha256"),
        F.posexplode(chunks(normalised(F.col("text")), low, high)).alias("position", "chunk"),
    ).withColumn("h", fingerprint(F.col("chunk")))
    hits = pieces.join(ambiguous, ["h", "chunk"]).select("text_sha256", "position", "variant").distinct()
    variants = hits.groupBy("text_sha256").agg(F.array_sort(F.collect_list(F.struct("position", "variant"))).alias("found"))
    variants = variants.select(
        "text_sha256", F.flatten(F.transform("found", lambda x: F.array(x["position"], x["variant"]))).alias("variants")
    )
    found = recipes.withColumnRenamed("variants", "none").join(variants, "text_sha256", "left")
    return found.withColumn("variants", F.coalesce("variants", "none"))
