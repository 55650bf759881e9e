"""Exact top-k search by inner product, with the threshold algorithm over sorted lists.

Vectors are gathered in blocks of bounded size. A block keeps, for each dimension, its vectors in the
order of that component. A query goes down all lists at once, from the end that its own component
favours, scores what it meets in full, and stops as soon as no vector further down can come among its
k best: none can score more than the query's product with the components where it stands. Blocks are
exact on their own, and the best of every block's answers are the best of all. Queries come in blocks
too, and each pair of a query block and a vector block is one task.

Components are whole numbers, and scores are exact. Shorter vectors count as filled up with zeros.

Defined results: a vector that is null, or holds a null or a component that isn't finite, takes no
part; repeated rows are rows of their own, but no row answers a query of its own id; a null id sorts
last and asks nothing; ties go to the smaller id; an empty table gives an empty one. Components and
scores are longs: a component of 2**63 / ``scale`` or more either way is an error that names the vector's
id, and so is a query of which the components' sizes, added up and multiplied with the largest
component of any vector, come to 2**63 or more. Both are found before anything is ranked.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cashloom.llm.storage import stored

K, SCALE = 5, 256
BLOCK_VECTORS, BLOCK_QUERIES = 8192, 2048
#: Places of all lists read before the bound is first tried; twice as many each time after.
FIRST_DEPTH = 32
#: Whole numbers below these are exact in double and in single precision.
EXACT, EXACT_SINGLE = float(1 << 53), float(1 << 24)


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """id, row, x: the vectors that take part, with components floor(scale * component)."""
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    fits = F.forall(x, lambda c: F.abs(c * scale) < float(1 << 63))
    complaint = F.concat(F.lit("a component is too large in the vector of id "), F.coalesce(F.col(vec_id).cast("string"), F.lit("null")))
    checked = F.when(fits, whole).otherwise(F.raise_error(complaint).cast("array<bigint>"))
    rows = vectors.where(F.col(vector).isNotNull()).where(finite)
    return rows.select(F.col(vec_id).alias("id"), F.monotonically_increasing_id().alias("row"), checked.alias("x"))


def check_scores(vectors: DataFrame, queries: DataFrame) -> None:
    """An error if a score, or a sum on the way to it, could be beyond a long."""
    sizes = F.transform("x", lambda c: F.abs(c.cast("decimal(20, 0)")))
    largest = vectors.select("id", F.array_max(sizes).alias("n")).agg(F.max("n").alias("n"), F.max_by("id", "n").alias("id")).first()
    total = F.aggregate(sizes, F.lit(0).cast("decimal(38, 0)"), lambda t, c: (t + c).cast("decimal(38, 0)"))
    longest = queries.where("id IS NOT NULL").select("id", total.alias("n")).agg(F.max("n").alias("n"), F.max_by("id", "n").alias("id")).first()
    if int(largest["n"] or 0) * int(longest["n"] or 0) >= 1 << 63:
        raise ValueError(f"scores of the query of id {longest['id']} with the vector of id {largest['id']} may not fit 64 bits")


def as_matrix(vectors: list[np.ndarray]) -> np.ndarray:
    """Rows of one length; shorter vectors are filled up with zeros."""
    width = max(map(len, vectors), default=0)
    if width and min(map(len, vectors)) == width:
        return np.stack(vectors)
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class Lists:
    """A block of vectors and, for each dimension, their order from the smallest component."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.order = np.argsort(x, axis=0, kind="stable").T.astype(np.int32)
        most = float(np.abs(x).max(initial=0))
        self.size = max(1.0, most * max(1, x.shape[1]))
        self.short, self.plain = x.astype(np.float32), x.astype(np.float64)

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact products: with single or double precision where that holds every partial sum."""
        largest = float(np.abs(query).max(initial=0)) * self.size
        if largest < EXACT_SINGLE:
            return (self.short[rows] @ query.astype(np.float32)).astype(np.int64)
        if largest < EXACT:
            return (self.plain[rows] @ query.astype(np.float64)).astype(np.int64)
        return np.array([sum(int(a) * int(b) for a, b in zip(self.x[r], query)) for r in rows], dtype=object)

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[list[int], list[int], int]:
        """Rows and scores of the k best but for id ``own``, and how many vectors were scored."""
        n, width = self.x.shape
        used = np.flatnonzero(query)
        up = query[used] > 0
        seen = np.zeros(n, dtype=bool)
        rows, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        depth, done = FIRST_DEPTH, 0
        scored = 0
        while True:
            stop = min(depth, n) if len(used) else n
            if stop < n:
                met = np.zeros(n, dtype=bool)
                met[self.order[used[up], n - stop : n - done].ravel()] = True
                met[self.order[used[~up], done:stop].ravel()] = True
                fresh = np.flatnonzero(met & ~seen)
            else:
                fresh = np.flatnonzero(~seen)
            seen[fresh] = True
            scored += len(fresh)
            fresh = fresh[self.ids[fresh] != own]
            rows, scores = np.concatenate([rows, fresh]), np.concatenate([scores, self.scores(fresh, query)])
            if len(rows) > k:
                enough = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
                keep = enough[np.lexsort((self.ids[rows[enough]], -scores[enough]))[:k]]
                rows, scores = rows[keep], scores[keep]
            if stop == n or scored == n:
                break
            at = np.where(up, self.order[used, n - stop], self.order[used, stop - 1])
            bound = sum(int(a) * int(b) for a, b in zip(self.x[at, used], query[used]))
            if len(rows) == k and scores.min() > bound:
                break  # a score that equals the bound could still belong to a smaller id
            done, depth = stop, 2 * depth
        keep = np.lexsort((self.ids[rows], -scores))
        return rows[keep].tolist(), [int(s) for s in scores[keep]], scored


def _blocked(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """``rows`` with a block number each, and the number of blocks; rows must not change any more."""
    blocks = max(1, -(-rows.count() // size))
    return rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")), blocks


#: Stands for a null id in a block, where it comes last among ties.
NO_ID = int(np.iinfo(np.int64).max)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, query_row, rank, vec_id, score: for each query the ``k`` best of ``vectors``.

    Both are tables of ``whole_vectors`` (id, row, x). Only ids and vectors are dealt out, each vector
    once for a block of queries and each query once for a block of vectors.
    """
    asked, query_blocks = _blocked(queries.where("id IS NOT NULL"), BLOCK_QUERIES)
    given, vector_blocks = _blocked(vectors, BLOCK_VECTORS)
    every_vector_block = F.explode(F.sequence(F.lit(0), F.lit(vector_blocks - 1)))
    every_query_block = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    columns = [F.coalesce("id", F.lit(NO_ID)).alias("id"), F.col("id").isNull().alias("no_id"), "row", "x"]
    tiles = asked.select(*columns, every_vector_block.alias("vectors"), F.col("block").alias("queries"), F.lit(True).alias("asks"))
    tiles = tiles.unionByName(
        given.select(*columns, F.col("block").alias("vectors"), every_query_block.alias("queries"), F.lit(False).alias("asks"))
    )
    names = ["query_id", "query_row", "vec_id", "no_id", "row", "score"]
    kinds = {n: "bool" if n == "no_id" else "int64" for n in names}

    def searched(tile: pd.DataFrame) -> pd.DataFrame:
        asks = tile["asks"].to_numpy(bool)
        out: list[tuple] = []
        if asks.any() and not asks.all():
            x = as_matrix(list(tile["x"]))
            ids, rows, no_id = (tile[c].to_numpy() for c in ("id", "row", "no_id"))
            lists, own_rows, own_null = Lists(ids[~asks], x[~asks]), rows[~asks], no_id[~asks]
            for q in np.flatnonzero(asks):
                found, scores, _ = lists.best(x[q], ids[q], k)
                out += [(ids[q], rows[q], lists.ids[r], own_null[r], own_rows[r], s) for r, s in zip(found, scores)]
        return pd.DataFrame(out, columns=names).astype(kinds)

    found = tiles.groupBy("vectors", "queries").applyInPandas(
        searched, "query_id long, query_row long, vec_id long, no_id boolean, row long, score long"
    )
    found = found.withColumn("vec_id", F.when(~F.col("no_id"), F.col("vec_id")))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "query_row", "rank", "vec_id", "score")


def searched_table(
    vectors: DataFrame, every: int, k: int = K, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE
) -> DataFrame:
    """The ``k`` best of all vectors for each one whose id is divisible by ``every``."""
    whole = stored(whole_vectors(vectors, vec_id, vector, scale), "vectors")
    queries = whole.where(F.pmod(F.col("id"), F.lit(every)) == 0)
    check_scores(whole, queries)
    return top_k(whole, queries, k)
