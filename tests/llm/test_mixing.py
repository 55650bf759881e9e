from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from cashloom.llm import queries
from cashloom.llm.mixing import copied, mixed, numbered, rates, text_md5


def refilled(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by giving the excess to the others again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, target = {}, {}
    while True:
        rest = [s for s in names if s not in full]
        left = share * sum(sizes.values()) - sum(full.values())
        target = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = {s: most * sizes[s] for s in rest if target[s] > most * sizes[s]}
        if not over:
            return full | target
        full |= over


@pytest.mark.parametrize("seed", range(6))
def test_targets_against_refilling(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": int(rng.lognormvariate(6, 2)) for i in range(rng.randint(1, 30))} | {None: 50, "": 0, "é": 70, "\U0001f600": 9, "￮": 8}
    frame = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r for r in rates(frame).collect()}
    want = refilled(sizes)
    assert got.keys() == want.keys()
    for s, r in got.items():
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], rel=1e-9, abs=1e-9)
        assert r.rate <= 2 and r.rate == (r.target / sizes[s] if sizes[s] else 0)


def draw(doc_id, text, n=1):
    digest = hashlib.md5((text or "").encode()).hexdigest()
    key = f"mix-1:{'null' if doc_id is None else doc_id}:{digest}:{n}"
    return int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 16**13


def test_taken_words_come_near_the_targets(spark, documents):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randint(1, 40))) for i in range(6000)]
    docs = documents(rows).withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("doc_id") % 7)))
    taken, target = defaultdict(int), {}
    for r in mixed(docs).select("source", "doc_id", "mix.*").collect():
        assert r.size == len(rows[r.doc_id][1].split()) and r.copies <= 2
        u = draw(r.doc_id, rows[r.doc_id][1])
        assert r.copies == int(r.rate) + (u < r.rate - int(r.rate))
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) < 0.1 * target[s] for s in target)


def test_odd_rows_and_copies(spark):
    rows = [(1, None, None, 7), (1, "a b", None, 7), (None, "a\tb c", "x", 7), (2, "", "empty", 7), (2, "", "empty", 7), (3, "w " * 100_000, "y", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, rate long")
    got = mixed(docs)
    assert sorted((r.size for r in got.select("mix.size").collect())) == [0, 0, 0, 2, 2, 100_000]
    assert {r.target for r in got.where("source = 'empty'").select("mix.target").collect()} == {0.0}
    out = copied(got)
    assert out.columns == docs.columns and out.count() == got.agg(F.sum("mix.copies")).first()[0]
    assert mixed(docs.limit(0)).count() == 0


def test_query_agrees_with_sql(spark, middle):
    name = "op6_mixing"
    assert difference(spark, connect(middle), queries.queries()[name], queries.oracle_sql()[name], middle) == ""
    for r in queries.queries()[name](spark, middle).collect():
        assert r.taken <= 2 * r.size


@pytest.mark.parametrize("block", ["null", "one id", "equal rows"])
def test_targets_with_a_third_of_the_rows_in_one_block(spark, block):
    """Without an id, under one id, or all the same: the block draws row by row and its source comes near."""
    rng = random.Random(2)
    rows = []
    for k in range(6000):
        i, text = k, f"w{k} " + "w " * rng.randint(0, 30)
        if k % 3 == 0:
            i, text = {"null": (None, text), "one id": (5, text), "equal rows": (None, "same words in all")}[block]
        rows.append((i, text, f"s{k % 3 if k % 7 else 1}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixed(docs).select("doc_id", "text", "source", "mix.*").collect()
    taken, target, seen, want = defaultdict(int), {}, Counter(), Counter()
    for r in got:
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
        seen[r.doc_id, r.text, r.source] += 1
        n = seen[r.doc_id, r.text, r.source]
        want[r.doc_id, r.text, r.source] += int(r.rate) + (draw(r.doc_id, r.text, n) < r.rate - int(r.rate))
    assert all(abs(taken[s] - target[s]) < 0.03 * target[s] for s in target)
    copies = Counter()
    for r in got:
        copies[r.doc_id, r.text, r.source] += r.copies
    assert +copies == +want and len(got) == len(rows)
    again = mixed(docs.repartition(7)).select("doc_id", "text", "source", "mix.*").collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_equal_rows_are_numbered(spark):
    rows = [(1, "a", "x", 1), (1, "a", "x", 1), (1, "a", "x", 2), (1, "a", "y", 1), (None, None, None, None), (None, None, None, None), (2, "b", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, other int")
    got = Counter(map(tuple, numbered(docs, [F.col("doc_id"), text_md5(F.col("text")), F.col("source")], "n").select("doc_id", "source", "n").collect()))
    assert got == Counter([(1, "x", 1), (1, "x", 2), (1, "x", 3), (1, "y", 1), (None, None, 1), (None, None, 2), (2, "x", 1)])
