from __future__ import annotations

import math

import numpy as np
import pytest
from compare import connect, difference

from cashloom.llm import queries, topk
from cashloom.llm.topk import Lists, searched_table


def test_lists_against_all_scores():
    rng = np.random.default_rng(3)
    for n, width, span in [(3000, 8, 200), (500, 3, 2), (40, 5, 5), (1, 4, 9), (200, 0, 1), (300, 6, 2**31)]:
        x = rng.integers(-span, span + 1, (n, width))
        ids = rng.permutation(n) if n != 500 else rng.integers(0, 100, n)
        lists = Lists(ids, x)
        for _ in range(20):
            query = rng.integers(-span, span + 1, width)
            own = int(rng.integers(0, n))
            want = sorted((-sum(int(a) * int(b) for a, b in zip(row, query)), int(i)) for row, i in zip(x, ids) if i != own)[:5]
            rows, scores, _ = lists.best(query, own, 5)
            assert [(-s, int(ids[r])) for r, s in zip(rows, scores)] == want


def test_stops_before_the_end_of_the_lists():
    rng = np.random.default_rng(4)
    x = rng.integers(-1000, 1000, (8000, 2))
    lists = Lists(np.arange(8000), x)
    scored = [lists.best(q, -1, 5)[2] for q in rng.integers(-1000, 1000, (50, 2))]
    assert np.mean(scored) < 2000


def brute(rows, k=5):
    whole = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for i, v in whole:
        if i is not None and i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), math.inf if j is None else j) for j, w in whole if j != i)[:k]
            out += [(i, r + 1, None if j == math.inf else j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out, key=str)


@pytest.mark.parametrize("small_blocks", [False, True])
def test_table_with_odd_rows(spark, monkeypatch, small_blocks):
    if small_blocks:
        monkeypatch.setattr(topk, "BLOCK_VECTORS", 20)
        monkeypatch.setattr(topk, "BLOCK_QUERIES", 2)
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.choice([-0.5, 0.0, 0.25, 1.0], 6)]) for i in range(-100, 200)]
    rows += [(250, None), (300, [None, 1.0]), (350, [float("nan")]), (400, [float("inf"), 1.0]), (450, []), (500, [1.0, 2.0]), (None, [2.0] * 6), (7, [9.0] * 6), (7, [9.0] * 6), (550, [1e6] * 8)]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, row int, x int")
    got = searched_table(frame, 50).select("query_id", "rank", "vec_id", "score").collect()
    mine, want = set(map(tuple, got)), set(brute(rows))
    assert (sorted(mine - want, key=str)[:8], sorted(want - mine, key=str)[:8]) == ([], [])
    assert len(got) == len(brute(rows))
    assert searched_table(frame.limit(0), 50).count() == 0


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_scores_up_to_a_long(spark):
    """A query of 2**30 in whole numbers and components of 2**32: 2**62 fits, and one dimension more doesn't."""
    large, query = float(1 << 24), float(1 << 22)
    rows = [(0, [query, 0.0]), (1, [large, 5.0]), (2, [-large, 0.0]), (3, [large, 0.0])]
    got = [tuple(r) for r in searched_table(table(spark, rows), 50).select("query_id", "rank", "vec_id", "score").orderBy("rank").collect()]
    assert got == [(0, 1, 1, 1 << 62), (0, 2, 3, 1 << 62), (0, 3, 2, -(1 << 62))]
    for odd in ([query, query], [query * 2, 0.0]):
        with pytest.raises(ValueError, match="query of id 0 with the vector of id"):
            searched_table(table(spark, [(0, odd), *rows[1:]]), 50)


@pytest.mark.parametrize("component", [2.0**55, -(2.0**55) - 2**10, 1e20, 2e17])
def test_components_beyond_a_long(spark, component):
    rows = [(0, [0.004]), (1, [component]), (2, [1e20])]
    with pytest.raises(Exception, match="too large in the vector of id [12]"):
        searched_table(table(spark, rows), 50)


def test_vectors_of_mixed_lengths(spark):
    rows = [(50, [1.0, 2.0, 3.0]), (1, [4.0]), (2, [0.0, -1.0]), (3, []), (4, [1.0, 1.0, 1.0, 9.0]), (100, [2.0**16] + [0.0] * 5)]
    got = searched_table(table(spark, rows), 50).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_query_agrees_with_sql(spark, middle):
    name = "op7_exact_topk"
    assert difference(spark, connect(middle), queries.queries()[name], queries.oracle_sql()[name], middle) == ""
