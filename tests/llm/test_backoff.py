from __future__ import annotations

import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cashloom.llm import queries
from cashloom.llm.backoff import ADDED, PRIOR, START, _ascending, _planes, _totals, scored


def brute_force(rows, order=2, held=lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0):
    """(doc_id, held, n_tokens, n_known, train_tokens, base, score) of (doc_id, text) rows, by plain counting."""
    tokens = [["<s>", *(t or "").encode().lower().split(), "</s>"] for _, t in rows]
    counts = Counter()
    for (i, _), words in zip(rows, tokens):
        if not held(i):
            for n in range(1, order + 1):
                counts.update(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    starts = counts.pop(("<s>",), 0)
    single = {g: c for g, c in counts.items() if len(g) == 1}
    total, kinds = sum(single.values()), len(single)
    counts[("<s>",)] = starts

    def chance(gram):
        if len(gram) == 1:
            return (single.get(gram, 0) + ADDED) / (total + ADDED * (kinds + 1))
        return (counts[gram] + PRIOR * chance(gram[1:])) / (counts[gram[:-1]] + PRIOR)

    out = []
    for (i, _), words in zip(rows, tokens):
        places = range(1, len(words))
        out.append(
            (
                i,
                held(i),
                len(words) - 1,
                sum((words[k],) in single for k in places),
                total,
                sum(math.log10(chance((words[k],))) for k in places),
                sum(math.log10(chance(tuple(words[max(0, k - order + 1) : k + 1]))) for k in places),
            )
        )
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0], r[2], r[5])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9) and a[6] == pytest.approx(b[6], rel=1e-9, abs=1e-9)


COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def test_query_against_brute_force(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    same([tuple(r[c] for c in COLUMNS) for r in queries.op12_lm_scoring(spark, small).collect()], brute_force(docs))


ODD = [(1, None), (2, ""), (3, " \t\x0b"), (4, "A b a B"), (4, "A b a B"), (5, "a b c d e f"), (None, "a b"), (30, "ü Ü a b"), (31, "start end"), (7, "x " * 300)]


@pytest.mark.parametrize("order, block_tokens", [(1, 7), (2, 1), (2, 10_000), (3, 7), (4, 30)])
def test_blocks_ranges_and_orders(spark, documents, order, block_tokens):
    kept_back = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % 10 == 0
    docs = documents(ODD).repartition(3).selectExpr("*", "1 AS block", "2 AS words", "3 AS score")
    found = scored(docs, ~kept_back, order=order, block_tokens=block_tokens, range_grams=40)
    got = [(r.doc_id, not r.learnt_from, *list(r)[2:]) for r in found.collect()]
    same(got, brute_force(ODD, order))


def test_nothing_to_learn_from(spark, documents):
    found = scored(documents([(1, "a b"), (2, None)]), F.lit(False)).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found] == [(3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)]
    assert scored(documents([]), F.lit(True)).count() == 0


def test_probabilities_add_up(spark, documents):
    """Of all words that may follow two known ones, an unknown one standing for the rest."""
    learnt = [(k, t) for k, t in enumerate(["a b c", "a b d", "b a", "c c a b"])]
    follow = ["a", "b", "c", "d", "zz"]
    # what comes after the word scores alike in a text that ends there
    asked = [(100 + k, f"a b {w}") for k, w in enumerate(follow)] + [(200, "a b")]
    found = {r.doc_id: r.score for r in scored(documents(learnt + asked), F.col("doc_id") < 100, order=3).collect()}
    same_rows = brute_force(learnt + asked, 3, lambda i: i >= 100)
    assert all(found[r[0]] == pytest.approx(r[6], rel=1e-9) for r in same_rows)
    before = {r.doc_id: r.score for r in scored(documents(learnt + [(1000, "a b")]), F.col("doc_id") < 100, order=3).collect()}[1000]
    total = 10 ** (before - _prefix(learnt, ["a", "b"]))  # the end token after "a b"
    total += sum(10 ** (_prefix(learnt, ["a", "b", w]) - _prefix(learnt, ["a", "b"])) for w in follow)
    assert total == pytest.approx(1.0)


def _prefix(learnt, words):
    """Log-probability of the words without an end token, as the text's score less that of its end."""
    full = brute_force(learnt + [(300, " ".join(words))], 3, lambda i: i >= 100)[-1][6]
    return full - _end(learnt, words)


def _end(learnt, words):
    counts = Counter()
    for _, t in learnt:
        row = ["<s>", *t.split(), "</s>"]
        for n in (1, 2, 3):
            counts.update(tuple(row[i : i + n]) for i in range(len(row) - n + 1))
    single = {g: c for g, c in counts.items() if len(g) == 1 and g != ("<s>",)}
    size = sum(single.values()) + ADDED * (len(single) + 1)

    def chance(g):
        if len(g) == 1:
            return (single.get(g, 0) + ADDED) / size
        return (counts[g] + PRIOR * chance(g[1:])) / (counts[g[:-1]] + PRIOR)

    return math.log10(chance(tuple([*words, "</s>"][-3:])))


def test_better_than_single_words_on_held_out(spark, small):
    rows = [r for r in queries.op12_lm_scoring(spark, small).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_counts_of_a_range_take_few_arrays():
    draw = np.random.default_rng(1)
    keys = [np.unique(np.append(draw.integers(0, 400_000, 30_000).astype(np.uint64) << np.uint64(40), np.uint64(START))) for _ in range(10)]
    own = [draw.integers(0, 3, len(k)).astype(np.uint32) for k in keys]
    columns = [pa.chunked_array([pa.array([pack(v) for v in values], pa.binary())]) for pack, values in ((_ascending, keys), (_planes, own))]
    tracemalloc.start()
    cuts, totals, kinds = _totals(*columns)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    different, number = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(number, np.concatenate(own)).astype(np.int64)
    assert (totals == sums[number]).all() and cuts == [0, *np.cumsum([len(k) for k in keys]).tolist()]
    assert kinds == ((sums > 0) & (different != START)).sum()
    assert peak < 48 * len(totals)  # grouping by unique() took 88 bytes for each n-gram
