"""Shards of near equal bytes by a k-d tree over the metadata of documents.

Equal texts are one point with the bytes of all of them, and stay together. The tree splits at weighted
quantiles along the widest dimension until every leaf is one shard's share; where points agree in that
dimension the hash of their text decides between them, so that a split can be as even as the points
allow. A point with more bytes than a shard's share gets a shard of its own before that. The law is
``bytes``: nothing is said about shards of another number.

Quantiles come from histograms of all points of a level's nodes, narrowed step by step; a node's sums
are all that reaches the driver.

Defined results: a null text counts as empty; null metadata sorts first; of points with several
documents the smallest id, language and source count; an empty table gives an empty one; shards may be
empty where there are fewer points than shards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashloom.llm.storage import stored

SHARDS = 16
BINS = 1024
#: Steps of a dimension, and hash values that decide within a step.
STEPS, TIES = 1 << 21, 1 << 31
#: A quantile is as near as this share of a node's bytes.
TOLERANCE = 0.0002
#: Rows numbered by one task.
BUCKET_ROWS = 50_000
DIMENSIONS = ("size", "doc_id", "lang", "source")


@dataclass
class Node:
    """A region of the points that ends in ``shards`` leaves, the first of them ``first``.

    ``low`` and ``high`` close in on the key along ``dimension`` from which its second half starts,
    with ``below`` bytes before ``low``.
    """

    shards: int
    first: int
    low: int = 0
    high: int = 0
    below: int = 0
    bytes: int = 0
    dimension: str = DIMENSIONS[0]

    @property
    def width(self) -> int:
        """Keys of a bin."""
        return -(-(self.high - self.low + 1) // BINS)


def _point_table(docs: DataFrame, doc_id: str, text: str, lang: str, source: str) -> DataFrame:
    value = F.coalesce(text, F.lit(""))
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        (F.octet_length(value) + 1).cast("long").alias("size"),
        F.crc32(F.encode(value, "UTF-8")).alias("text_crc32"),
        F.xxhash64(value).alias("text_hash"),
        F.pmod(F.crc32(F.encode(F.col(lang), "UTF-8")), F.lit(STEPS)).alias("lang"),
        F.pmod(F.crc32(F.encode(F.col(source), "UTF-8")), F.lit(STEPS)).alias("source"),
    )


def _keyed(points: DataFrame) -> DataFrame:
    """``points`` with a whole number for each dimension: its step over the full range, then the hash."""
    values = {"size": F.log2(F.col("size").cast("double"))} | {d: F.col(d).cast("double") for d in DIMENSIONS[1:]}
    ends = points.agg(*[f(v).alias(f"{n}_{d}") for d, v in values.items() for n, f in (("low", F.min), ("high", F.max))]).first()
    tie = F.pmod(F.col("text_hash"), F.lit(TIES))
    columns = []
    for d, value in values.items():
        low, high = ends[f"low_{d}"] or 0.0, ends[f"high_{d}"] or 0.0
        width = (high - low) or 1.0
        step = F.floor((F.coalesce(value, F.lit(low)) - low) / width * (STEPS - 1)).cast("long")
        columns.append((step * TIES + tie).alias(f"key_{d}"))
    return points.select("text_hash", "size", "text_crc32", "weight", *columns)


def _by_node(values: dict[int, int]) -> Column:
    """The value of a row's node."""
    entries = [F.lit(x).cast("long") for pair in values.items() for x in pair]
    return F.create_map(*entries)[F.col("node").cast("long")]


def _key(nodes: dict[int, Node]) -> Column:
    """A row's key along its node's dimension."""
    key = F.lit(None).cast("long")
    for d in DIMENSIONS:
        if own := [k for k, n in nodes.items() if n.dimension == d]:
            key = F.when(F.col("node").isin(own), F.col(f"key_{d}")).otherwise(key)
    return key


def _measure(points: DataFrame, nodes: dict[int, Node]) -> dict[int, Node]:
    """The nodes that have points, with their bytes and their widest dimension."""
    sums = [F.sum("weight").alias("bytes")]
    for d in DIMENSIONS:
        sums += [F.min(f"key_{d}").alias(f"low_{d}"), F.max(f"key_{d}").alias(f"high_{d}")]
    found = {}
    for r in points.where(F.col("node").isin(list(nodes))).groupBy("node").agg(*sums).collect():
        node = found[r["node"]] = nodes[r["node"]]
        node.dimension = max(DIMENSIONS, key=lambda d: r[f"high_{d}"] - r[f"low_{d}"])
        node.bytes, node.low, node.high = r["bytes"], r[f"low_{node.dimension}"], r[f"high_{node.dimension}"]
    return found


def _narrow(points: DataFrame, nodes: dict[int, Node], tolerance: float) -> None:
    """Moves each node's ``low`` to the key from which its second half starts.

    Of ``BINS`` bins between low and high, the one that holds the quantile is the next low and high,
    until it is a single key or holds so little that its ends will do.
    """
    while nodes := {k: n for k, n in nodes.items() if n.high > n.low}:
        place = F.floor((_key(nodes) - _by_node({k: n.low for k, n in nodes.items()})) / _by_node({k: n.width for k, n in nodes.items()}))
        binned = points.where(F.col("node").isin(list(nodes))).select("node", "weight", place.alias("bin"))
        sums = binned.where(F.col("bin").between(0, BINS - 1)).groupBy("node", "bin").agg(F.sum("weight").alias("weight"))
        bins: dict[int, list[tuple[int, int]]] = {k: [] for k in nodes}
        for r in sums.collect():  # at most BINS rows for each of fewer nodes than shards
            bins[r["node"]].append((r["bin"], r["weight"]))
        for k, node in nodes.items():
            goal = node.bytes * (node.shards // 2) / node.shards
            for place_, weight in sorted(bins[k]):
                if node.below + weight > goal or place_ == max(bins[k])[0]:
                    break
                node.below += weight
            start, width = node.low + place_ * node.width, node.width
            if width == 1 or weight <= tolerance * node.bytes:
                # the nearer end of what isn't divided further
                node.low = node.high = start if goal - node.below < node.below + weight - goal else start + width
            else:
                node.low, node.high = start, start + width - 1


def _leaves(points: DataFrame, shards: int, first: int, tolerance: float) -> DataFrame:
    """``points`` with ``shard``, from a tree with ``shards`` leaves; a level's nodes are split together."""
    nodes = {1: Node(shards, first)}
    points = points.withColumn("node", F.lit(1))
    ends: dict[int, int] = {}
    while nodes:
        ends |= {k: n.first for k, n in nodes.items() if n.shards == 1}
        nodes = _measure(points, {k: n for k, n in nodes.items() if n.shards > 1})
        if not nodes:
            break
        _narrow(points, nodes, tolerance)
        second = (_key(nodes) >= _by_node({k: n.low for k, n in nodes.items()})).cast("int")
        points = stored(points.withColumn("node", F.coalesce(2 * F.col("node") + second, "node")), "nodes")
        below = {}
        for k, n in nodes.items():
            below[2 * k] = Node(n.shards // 2, n.first)
            below[2 * k + 1] = Node(n.shards - n.shards // 2, n.first + n.shards // 2)
        nodes = below
    if not ends:  # there are no points
        ends = {1: first}
    return points.withColumn("shard", _by_node(ends).cast("int"))


def sharded(
    docs: DataFrame,
    shards: int = SHARDS,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, row."""
    rows = stored(_point_table(docs, doc_id, text, lang, source), "rows")
    point = ["text_hash", "size", "text_crc32"]
    least = [F.min(d).alias(d) for d in DIMENSIONS if d not in point]
    grouped = rows.groupBy(*point).agg(F.count(F.lit(1)).alias("n"), *least).withColumn("weight", F.col("n") * F.col("size"))
    points = stored(_keyed(stored(grouped, "groups")), "points")
    left, free = points.agg(F.sum("weight")).first()[0] or 0, shards
    large = F.lit(None).cast("int")
    for r in points.orderBy(F.desc("weight"), *point).limit(shards - 1).collect():
        if free == 1 or r["weight"] * free < left:
            break
        is_point = (F.col("text_hash") == r["text_hash"]) & (F.col("size") == r["size"]) & (F.col("text_crc32") == r["text_crc32"])
        large = F.when(is_point, F.lit(shards - free)).otherwise(large)
        left, free = left - r["weight"], free - 1
    placed = _leaves(points.where(large.isNull()), free, shards - free, tolerance).select(*point, "shard")
    if free < shards:
        placed = placed.unionByName(points.where(large.isNotNull()).select(*point, large.alias("shard")))
    return _with_slots(rows.join(placed, point)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row"
    )


def _with_slots(rows: DataFrame) -> DataFrame:
    """``rows`` with ``slot``: numbers from 0 without gaps in every shard.

    Rows are numbered in buckets of bounded size, after the sums of the buckets before.
    """
    rows = stored(rows, "sharded")
    buckets = max(1, -(-rows.count() // BUCKET_ROWS))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    counts = dealt.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    place = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("row")) - 1
    numbered = dealt.withColumn("place", place).join(starts, ["shard", "bucket"])
    return numbered.withColumn("slot", (F.col("start") + F.col("place")).cast("long"))
