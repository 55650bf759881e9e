from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

from cashloom.llm import queries
from cashloom.llm.sharding import sharded


def checked(rows, given, shards):
    """One row a document, equal texts together, slots without gaps; gives the bytes of each shard."""
    assert len(rows) == len(given)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in given)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots, texts, total = defaultdict(list), defaultdict(set), Counter()
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        texts[r.size, r.text_crc32].add(r.shard)
        total[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in texts.values())
    return total


def texts(n, seed=3):
    rng = random.Random(seed)
    return [(i, "".join(rng.choice("ab cé") for _ in range(int(rng.lognormvariate(4, 1))))) for i in range(n)]


def test_even_bytes(documents):
    given = texts(4000)
    total = checked(sharded(documents(given)).collect(), given, 16)
    mean = sum(total.values()) / 16
    largest = max(len(t.encode()) + 1 for _, t in given)
    assert len(total) == 16 and all(abs(b - mean) <= 0.003 * mean + 2 * largest for b in total.values())


def test_one_text_with_a_third_of_all_bytes(documents):
    given = texts(3000)
    hot = "h" * 200
    given += [(10_000 + i, hot) for i in range(sum(len(t) for _, t in given) // 400)]
    rows = sharded(documents(given)).collect()
    total = checked(rows, given, 16)
    alone = {r.shard for r in rows if r.size == 201 and r.text_crc32 == zlib.crc32(hot.encode())}
    assert len(alone) == 1 and len({r.text_crc32 for r in rows if r.shard in alone}) == 1
    others = [b for s, b in total.items() if s not in alone]
    assert len(others) == 15 and max(others) - min(others) < 0.1 * max(others)


def test_splits_follow_the_widest_dimension(spark):
    # only doc_id differs much: the shards are ranges of it
    docs = spark.createDataFrame([(i, f"{i:05d}", "en", "s", 5) for i in range(1600)], "doc_id long, text string, lang string, source string, n_chars long")
    rows = sharded(docs).collect()
    spans = defaultdict(list)
    for r in rows:
        spans[r.shard].append(r.doc_id)
    assert all(abs(len(s) - 100) <= 2 and max(s) - min(s) == len(s) - 1 for s in spans.values())


def test_odd_rows(spark, documents):
    given = [(None, None), (None, ""), (1, "a"), (1, "a"), (2, "é" * 70_000), (-5, "\x00")]
    checked(sharded(documents(given)).collect(), given, 16)
    assert sharded(documents([])).count() == 0
    extra = documents(given).selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang", "CAST(NULL AS STRING) AS source", "1 AS row", "2 AS shard", "3 AS size", "4 AS weight")
    checked(sharded(extra, shards=3).collect(), given, 3)
    checked(sharded(documents([(1, "x")] * 7)).collect(), [(1, "x")] * 7, 16)


def test_query_reads_all_documents(spark, middle):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{middle}/documents.parquet").collect()]
    total = checked(queries.op8_sharding(spark, middle).collect(), given, 16)
    largest = max(len((t or "").encode()) for _, t in given)
    assert len(total) == 16 and max(total.values()) - min(total.values()) < largest
