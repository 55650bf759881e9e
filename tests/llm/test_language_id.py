from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cashloom.llm import queries
from cashloom.llm.bigru import fresh, loss_and_gradients, probabilities
from cashloom.llm.language_id import as_windows, held_out, identified, pooled, sampled_windows, trained


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    net = fresh(3, 4, 6, rng)
    for p in net.parameters():
        p += rng.normal(0, 0.2, p.shape).astype(np.float32)
    x = rng.integers(0, 5, (6, 7))
    weight = (rng.random((6, 7)) < 0.8).astype(np.float32)
    label = rng.integers(0, 3, 7)
    _, gradients = loss_and_gradients(net, x, weight, label)
    for p, g in zip(net.parameters(), gradients):
        for _ in range(12):
            at = tuple(rng.integers(0, n) if n != 256 else rng.integers(0, 5) for n in p.shape)
            old, step = p[at], 1e-2
            p[at] = old + step
            high, _ = loss_and_gradients(net, x, weight, label)
            p[at] = old - step
            low, _ = loss_and_gradients(net, x, weight, label)
            p[at] = old
            assert (high - low) / (2 * step) == pytest.approx(g[at], abs=2e-3, rel=0.05)


def test_pooling_against_one_text_at_a_time():
    net = fresh(3, 4, 64, np.random.default_rng(1))
    texts = [b"a", b"x" * 64, b"y" * 65, bytes(range(256)) * 40, b"z" * 200_000]
    together = pooled(net, texts)
    for text, got in zip(texts, together):
        rows = as_windows(text, 64)
        chance = np.concatenate([probabilities(net, row[:, None])[:, :, 0] for row in rows[:400]])
        if len(rows) <= 400:
            assert got == pytest.approx(chance[: len(text)].mean(axis=0), abs=1e-5)
        assert got.sum() == pytest.approx(1, abs=1e-4)


def test_held_out_accuracy(spark, middle):
    rows = queries.op10_language_id(spark, middle).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{middle}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark, middle):
    docs = spark.read.parquet(f"{middle}/documents.parquet").select("doc_id", "text", "lang")
    model = trained(docs.where(~held_out(F.col("doc_id"))))
    rows = [(1, None), (2, ""), (3, "123 !? \n"), (None, "The and of that with"), (5, "é"), (6, "The thing of " * 100_000), (7, "The and of that with")]
    given = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, n_chars int")
    out = identified(given, model)
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == ["doc_id", "text", "n_chars", "lang_pred", "score"]
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3))
    assert got[6].lang_pred == "en" and got[5].lang_pred in model.languages
    assert (got[None].lang_pred, got[None].score) == (got[7].lang_pred, got[7].score)
    assert identified(given.limit(0), model).count() == 0
    none = trained(docs.limit(0))
    assert {r.lang_pred for r in identified(given, none).collect()} == {"und"}


def test_sample_is_bounded_and_learns_only_from_text_and_lang(spark, middle):
    docs = spark.read.parquet(f"{middle}/documents.parquet")
    many = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 10_000)).unionByName(docs.withColumn("lang", F.lit(None).cast("string")))
    counts = sampled_windows(many, "text", "lang", "doc_id").groupBy("lang").agg(F.max("n").alias("n")).collect()
    assert {r.lang for r in counts} == {"de", "en", "es", "fr"} and max(r.n for r in counts) == 400


def test_one_language_of_nearly_all_documents(spark):
    """Each language has its sample, and little more than that of the large one is brought together."""
    hot = spark.range(20_000).selectExpr("id AS doc_id", "concat('the words of ', id) AS text", "'en' AS lang")
    few = spark.range(300).selectExpr("id + 90000 AS doc_id", "concat('die Worte von ', id) AS text", "'de' AS lang")
    nobody = spark.range(9000).selectExpr("CAST(NULL AS long) AS doc_id", "concat('les mots de ', id) AS text", "'fr' AS lang")
    docs = hot.unionByName(few).unionByName(nobody)
    sample = sampled_windows(docs, "text", "lang", "doc_id")
    counts = {r.lang: r.n for r in sample.groupBy("lang").agg(F.max("n").alias("n")).collect()}
    assert counts == {"en": 400, "de": 300, "fr": 400}
    again = sampled_windows(docs.repartition(9), "text", "lang", "doc_id")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, sample.collect()))


def test_query_against_one_text_at_a_time(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    model = trained(docs.where(~held_out(F.col("doc_id"))))
    got = {r.doc_id: (r.lang_pred, r.score) for r in queries.op10_language_id(spark, small).collect()}
    for r in docs.collect():
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert got[r.doc_id] == ("und", 0.0)
            continue
        chance = pooled(model.network, [r.text.encode()])[0]
        assert got[r.doc_id][0] == model.languages[int(chance.argmax())] or sorted(chance)[-1] - sorted(chance)[-2] < 1e-4
        assert got[r.doc_id][1] == pytest.approx(float(chance.max()), abs=2e-4)
