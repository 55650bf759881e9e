from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from cashloom.llm import queries, runs
from cashloom.llm.runs import periodic_stretches, with_runs


def plain_stretches(x):
    """Every lag on its own, from the shortest on."""
    found = {}
    for p in range(1, len(x) // 3 + 1):
        i = 0
        while i + p < len(x):
            j = i
            while j + p < len(x) and x[j] == x[j + p]:
                j += 1
            if j - i >= 2 * p:
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted((s, n, p) for (s, n), p in found.items())


def planted(rng, n, kinds):
    x = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randint(0, 4)):
        p, s = rng.randint(1, max(1, n // 3)), rng.randrange(n)
        unit = [rng.randrange(kinds) for _ in range(p)]
        if rng.random() < 0.4:  # a period that holds runs itself
            unit = (unit[: max(1, p // 3)] * 3 + unit)[:p]
        for i in range(s, min(n, s + int(p * rng.uniform(2, 6)))):
            x[i] = unit[(i - s) % p]
    return x


@pytest.mark.parametrize("seed", range(8))
def test_stretches_against_all_lags(seed):
    rng = random.Random(seed)
    for _ in range(120):
        x = planted(rng, rng.randint(1, 300), rng.choice([1, 2, 3, 5, 50]))
        assert periodic_stretches(np.array(x, np.int64)) == plain_stretches(x)


def test_periods_of_every_scale():
    rng = np.random.default_rng(3)
    for period in (1, 7, 8, 15, 16, 31, 32, 33, 500, 4097):
        unit = np.arange(period) + 10
        x = np.concatenate([rng.integers(10**6, 10**7, 50), np.tile(unit, 4)[: 3 * period + period // 2], [-5, -6]])
        assert (50, 3 * period + period // 2, period) in periodic_stretches(x)


def test_work_grows_with_the_words(monkeypatch):
    compared = []
    for name in ("_equal_until", "_equal_from"):
        plain = getattr(runs, name)
        monkeypatch.setattr(runs, name, lambda x, at, lag, plain=plain: (compared.append(1), plain(x, at, lag))[1])
    counts = []
    for n in (20_000, 80_000):
        compared.clear()
        line = np.arange(10)
        periodic_stretches(np.tile(np.concatenate([np.tile(line, 30), np.arange(100, 140)]), n // 340))
        counts.append(len(compared))
    assert counts[1] <= 6 * counts[0]


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = [r for r in plain_stretches(words) if r[1] >= 24]
    found.sort(key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    digests = (hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
    return (len(found), *(top or (None, None, None)), top and 1000 * top[1] // top[2], *digests)


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_against_brute_force(spark, small, monkeypatch):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.op11_periodic_runs(spark, small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    few = [r for r in rows if len((docs[r.doc_id] or "").split()) < 3000]
    assert len(few) > 0.9 * len(rows)
    for r in few:
        assert tuple(r[c] for c in COLUMNS) == expected(r.doc_id, docs[r.doc_id])
    assert sum(r.n_runs > 0 for r in rows) >= 10


def test_odd_documents(spark, tmp_path, documents):
    line = " ".join(f"w{i}" for i in range(9))
    texts = [None, "", " \t\r\n", "one", "x " * 23, "x " * 24, "A a " * 12, (line + "\x0b") * 4, "a b " * 30, line + " " + "é ü " * 15 + line]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "x " * 40), (3, "one"), (5, "x " * 24)]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    key = lambda r: tuple(str(v) for v in r)
    assert sorted([(r.doc_id, *[r[c] for c in COLUMNS]) for r in got], key=key) == sorted([(i, *expected(i, t)) for i, t in rows], key=key)
    assert [r.n_runs for r in got if r.doc_id == 4] == [0] and [r.n_runs for r in got if r.doc_id == 5] == [1, 1]


def test_operator_keeps_its_columns(spark, documents):
    docs = documents([(1, "b " * 30), (2, "c d e")]).selectExpr("*", "1 AS runs", "text AS run_text", "2 AS collapsed", "3 AS n_words")
    rows = {r.doc_id: r for r in with_runs(docs, keep=("doc_id", "lang"), block_words=1).collect()}
    assert rows[1].asDict(True) == {"doc_id": 1, "lang": "en", "n_words": 30, "runs": [{"start": 0, "length": 30, "period": 1}], "collapsed": "b"}
    assert rows[2].runs == [] and rows[2].collapsed == "c d e"
    assert with_runs(docs.limit(0)).count() == 0


def test_a_long_text(spark, documents):
    unit = " ".join(f"u{i}" for i in range(7001))
    text = f"start {' '.join([unit] * 12)} u0 u1 end"
    row = with_runs(documents([(1, text)])).first()
    assert [tuple(r) for r in row.runs] == [(1, 12 * 7001 + 2, 7001)]
    assert row.collapsed == f"start {unit} end"
