"""Near-duplicates by SimHash fingerprints, searched exactly with a vantage-point tree.

Defined results: a null text counts as empty; a text without words has fingerprint zero and is linked
like any other; a text of fewer words than a shingle is one shingle; repeated rows and equal texts
have one fingerprint; null ids are never the smallest of a component unless all are null; an empty
table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashloom.llm.components import components
from cashloom.llm.storage import hash_sample, stored
from cashloom.llm.vantage import Tree, close_groups, grow, route

SHINGLE_WORDS = 3
REACH = 3
HASH_SEED = 42
#: Fingerprints from which the tree is grown, and that a leaf should hold of all of them.
SAMPLE_PRINTS = 20_000
LEAF_PRINTS = 2_000
#: A leaf of more is compared in tiles of pairs of its parts, each part of about this many.
TILE_PRINTS = 200_000
#: A leaf of more gets a tree of its own, grown from so many of its fingerprints at most.
PLAIN_PRINTS, OWN_SAMPLE = 4_000, 20_000
#: Shingle hashes whose bits are counted at once.
BLOCK_HASHES = 1 << 16


def simhash(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text: bit set where over half the shingle hashes have it set."""
    found = text.lower().split()  # of bytes: A-Z only, and blank and tab to carriage return only
    if not found:
        return 0
    joined, n = b" ".join(found), max(1, len(found) - words + 1)
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    stops = ends[min(words, len(found)) - 1 :].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for k in range(0, n, BLOCK_HASHES):
        pairs = zip(starts[k : k + BLOCK_HASHES], stops[k : k + BLOCK_HASHES])
        hashes = np.array([digest(joined[s:e], HASH_SEED) for s, e in pairs], dtype=">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def with_fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``fingerprint``, a long with the bits of the SimHash."""
    source = docs.select(*keep, F.encode(F.coalesce(text, F.lit("")), "UTF-8").alias("simhash_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [simhash(t.as_py(), words) for t in batch.column(batch.num_columns - 1)]
            column = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], [*batch.schema.names[:-1], "fingerprint"])

    return source.mapInArrow(hashed, ", ".join([*fields, "fingerprint long"]))


def sampled_tree(prints: DataFrame, count: int, sample: int = SAMPLE_PRINTS, leaf: int = LEAF_PRINTS) -> Tree:
    """A tree grown from ``sample`` of the ``count`` fingerprints at most, taken by their hash."""
    some = hash_sample(prints.select("fingerprint"), ["fingerprint"], count, sample)
    rows = some.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(sample).collect()
    taken = np.array([r["fingerprint"] for r in rows], dtype=np.int64).view(np.uint64)
    return grow(taken, leaf * len(taken) // max(1, count))


def close_links(
    prints: DataFrame,
    reach: int = REACH,
    sample: int = SAMPLE_PRINTS,
    leaf: int = LEAF_PRINTS,
    tile: int = TILE_PRINTS,
    plain: int = PLAIN_PRINTS,
) -> DataFrame:
    """Links (a, b) between different fingerprints that connect just those within ``reach`` bits.

    ``prints`` has the different fingerprints, as a stored table. Each leaf of the tree gives one link
    a member of a group of close ones. A leaf of over ``plain`` is searched by a tree of its own in its
    task; one that holds more than a task should is cut into parts, and each pair of parts is a task.
    """
    tree = sampled_tree(prints, prints.count(), sample, leaf)

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            index, leaves = route(tree, batch["fingerprint"].to_numpy(np.int64).view(np.uint64), reach)
            yield pd.DataFrame({"fingerprint": batch["fingerprint"].to_numpy(np.int64)[index], "leaf": leaves})

    visited = stored(prints.select("fingerprint").mapInPandas(visits, "fingerprint long, leaf long"), "visits")
    return _linked_in_tiles(visited, reach, tile, plain)


def connecting(prints: np.ndarray, reach: int, plain: int = PLAIN_PRINTS) -> tuple[np.ndarray, np.ndarray]:
    """Links between the different ``prints`` that connect just those within ``reach`` bits.

    More than ``plain`` of them are searched by a tree of their own, so that a leaf of the whole tree may
    hold many times what it aims at without all its pairs being compared.
    """
    if len(prints) <= plain:
        parts = [np.arange(len(prints))]
    else:
        every = max(1, len(prints) // OWN_SAMPLE)
        # any members will do as a sample; the leaves of the whole tree mix them well
        tree = grow(prints[::every], plain // 4 // every)
        index, leaves = route(tree, prints, reach)
        order = np.argsort(leaves, kind="stable")
        parts = np.split(index[order], np.flatnonzero(np.diff(leaves[order])) + 1)
    links: list[tuple[np.ndarray, np.ndarray]] = [(prints[:0], prints[:0])]
    for part in parts:
        here = prints[part]
        roots = close_groups(here, reach)
        moved = np.flatnonzero(roots != np.arange(len(here)))
        links.append((here[moved], here[roots[moved]]))
    return np.concatenate([x for x, _ in links]), np.concatenate([x for _, x in links])


def _linked_in_tiles(visited: DataFrame, reach: int, tile: int, plain: int) -> DataFrame:
    """Links (a, b) that connect the close fingerprints of each ``leaf`` of ``visited``, a stored table."""

    def linked(group: pd.DataFrame) -> pd.DataFrame:
        values = np.unique(group["fingerprint"].to_numpy(np.int64))
        a, b = connecting(values.view(np.uint64), reach, plain)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return _tiles(visited, "leaf", tile).groupBy("leaf", "low", "high").applyInPandas(linked, "a long, b long")


def _tiles(rows: DataFrame, group: str, size: int) -> DataFrame:
    """``rows`` with ``low`` and ``high``: a group of over ``size`` in parts, and each pair of parts a tile.

    Rows are dealt by their ``fingerprint``; a row of a group of n parts is in n tiles.
    """
    sizes = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("parts")).where("parts > 1")
    dealt = rows.join(sizes, group, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    tiled = dealt.withColumn("part", part).withColumn("other", every)
    return tiled.select(*rows.columns, F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))


def near_duplicates(
    docs: DataFrame,
    words: int = SHINGLE_WORDS,
    reach: int = REACH,
    doc_id: str = "doc_id",
    text: str = "text",
    **tree: int,
) -> DataFrame:
    """One row per document: doc_id, text_hash, fingerprint (long), root, component_id, row.

    ``component_id`` is the smallest doc_id that links between fingerprints of ``reach`` or fewer
    different bits lead to, and ``root`` the fingerprint that names the group. ``text_hash`` is XXH64 of
    the text by Spark; ``row`` numbers the rows as this run has read them.
    """
    source = docs.select(
        F.col(doc_id).alias("doc_id"), text_hash(F.col(text)).alias("text_hash"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text")
    )
    hashed = stored(with_fingerprints(source, words, "text", ("doc_id", "text_hash", "row")), "fingerprints")
    prints = stored(hashed.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "different-fingerprints")
    groups = components(close_links(prints, reach, **tree)).withColumnsRenamed({"node": "fingerprint"})
    rooted = prints.join(groups, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = rooted.join(firsts, "root").select("fingerprint", "root", "component_id")
    return hashed.join(labels, "fingerprint").select("doc_id", "text_hash", "fingerprint", "root", "component_id", "row")


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def distinct_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, reach: int = REACH) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one document of each group of near copies.

    The smallest doc_id of a group stays, null last; a document is its id and text, so that repeated
    rows stay or go together. Only the ones that go are brought to the rows.
    """
    found = stored(near_duplicates(docs, words, reach, doc_id, text), "near-groups")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    firsts = found.groupBy("root").agg(F.min(order).alias("first"))
    going = found.join(firsts, "root").where(order != F.col("first"))
    going = stored(going.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct(), "near-copies")
    is_gone = F.col(doc_id).eqNullSafe(F.col("gone_id")) & (text_hash(F.col(text)) == F.col("gone_hash"))
    return docs.join(going, is_gone, "left_anti").select(*docs.columns)
