from __future__ import annotations

import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_exact_dedup import expected as exact_groups
from test_mixing import draw, refilled
from test_packing import check_places, ids_of
from test_simhash import expected as near_groups

import corpus_pipeline
from cashloom.llm.language_id import held_out, pooled, trained
from cashloom.llm.simhash import distinct_documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What every stage is given and returns, on the smallest tables and some odd rows."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = [(9001, None), (9002, ""), (9003, "1 2 3"), (9004, "The and of"), (9005, "The  and\tof"), (None, "The thing with that")]
    docs = docs.unionByName(spark.createDataFrame([(i, t, "en", None, 0) for i, t in odd], docs.schema))
    out = []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, sf_dir).write.parquet(path)
        result = spark.read.parquet(path)
        out.append((docs.collect(), result.collect(), result.columns))
        docs = result
    return out


def test_language_stage_drops_only_what_has_no_language(steps):
    given, got, columns = steps[0]
    assert columns == COLUMNS
    kept = Counter(map(tuple, got))
    assert not kept - Counter(map(tuple, given))
    gone = [r for r in given if not kept[tuple(r)]]
    assert all(not re.search(r"[^\W\d_]", r.text or "") for r in gone) and {9001, 9002, 9003} <= {r.doc_id for r in gone}


def test_exact_stage(steps):
    given, got, columns = steps[1]
    assert columns == COLUMNS
    keep = {k for _, k, _, _ in exact_groups([(r.doc_id, r.text) for r in given])}
    assert Counter(r.doc_id for r in got) == Counter(keep)
    assert not Counter(map(tuple, got)) - Counter(map(tuple, given))


def test_near_stage(steps):
    given, got, columns = steps[2]
    assert columns == COLUMNS
    heads = {c for _, _, c in near_groups([(r.doc_id, r.text) for r in given])}
    assert Counter(r.doc_id for r in got) == Counter(heads)
    assert not Counter(map(tuple, got)) - Counter(map(tuple, given))


def test_near_copies_go_and_others_stay(spark, documents):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for family in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(150, 400))]
        for every in (1000, 200, 120, 8):
            copy = [rng.choice(vocabulary) if k % every == every // 2 else w for k, w in enumerate(base)]
            rows.append((len(rows), " ".join(copy)))
    got = {r.doc_id for r in distinct_documents(documents(rows)).collect()}
    assert got == {c for _, _, c in near_groups(rows)}
    assert {i for i, _ in rows if i % 4 == 0} <= got and {i for i, _ in rows if i % 4 == 3} <= got


def test_one_document_stays_of_rows_with_one_id(spark, documents):
    """A group's rows may share an id, or have none; equal rows are one document."""
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(5, text), (5, text + " x"), (None, text + " y"), (None, text), (7, "alone here"), (7, "alone here"), (7, "another one")]
    assert len({p for _, p, _ in near_groups(rows[:4])}) > 1
    out = distinct_documents(documents(rows)).collect()
    assert Counter(r.text for r in out if r.doc_id == 7) == Counter({"alone here": 2, "another one": 1})
    assert [r.doc_id for r in out if r.doc_id != 7] == [5]


def test_mixing_stage(steps):
    given, got, columns = steps[3]
    assert columns == COLUMNS
    sizes = defaultdict(int)
    for r in given:
        sizes[r.source] += len((r.text or "").split())
    target = refilled(dict(sizes))
    want = Counter()
    for r in given:
        rate = target[r.source] / sizes[r.source] if sizes[r.source] else 0
        want[r.doc_id] += int(rate) + (draw(r.doc_id, r.text) < rate - int(rate))
    assert Counter(r.doc_id for r in got) == +want


def test_packing_stage(steps):
    given, got, _ = steps[4]
    check_places(got, 4096)
    lengths = Counter()
    for r in got:
        lengths[r.doc_id] += r.length
    want = Counter()
    for r in given:
        want[r.doc_id] += len(ids_of(r.text)) + 1
    assert lengths == want


def test_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "piece", "start", "length", "sequence_id", "offset"} <= set(rows.columns) and rows.count() > 50
    assert [f for _, f in corpus_pipeline.STAGES][-1] is corpus_pipeline.packing


def test_whole_run_against_plain_stages(spark):
    """All pieces of a whole run, from each stage's brute-force version one after the other."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = trained(docs.where(~held_out(F.col("doc_id"))))
    rows = []
    for r in docs.collect():
        if re.search(r"[^\W\d_]", r.text or "") and pooled(model.network, [r.text.encode()])[0].max() >= corpus_pipeline.LEAST_SCORE:
            rows.append(r)
    keep = {k for _, k, _, _ in exact_groups([(r.doc_id, r.text) for r in rows])}
    rows = [r for r in rows if r.doc_id in keep]
    heads = {c for _, _, c in near_groups([(r.doc_id, r.text) for r in rows])}
    rows = [r for r in rows if r.doc_id in heads]
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += len(r.text.split())
    target = refilled(dict(sizes))
    want = Counter()
    for r in rows:
        rate = target[r.source] / sizes[r.source]
        ids = ids_of(r.text) + [1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            crc = zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            want[r.doc_id, piece, start, len(part), crc] += int(rate) + (draw(r.doc_id, r.text) < rate - int(rate))
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == +want
    check_places(got, 4096)


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0


def test_extra_columns_of_clashing_names(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20).coalesce(1)
    names = ["score", "lang_pred", "row", "recipe", "points", "variants", "fingerprint", "root", "key", "first", "mix", "copies", "weight", "rate", "size"]
    extra = docs.withColumns({n: F.lit(1) for n in names})
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, extra, "/root/testdata/sf0.001")
        assert result.count() > 0, name
        assert name == "packing" or result.columns == extra.columns, name
        assert name == "packing" or result.agg(*[F.max(n).alias(n) for n in names]).first().asDict() == {n: 1 for n in names}, name


def test_unlabelled_documents_with_a_letter_stay(spark, documents):
    rows = [(1, "The thing with that"), (2, "é"), (3, None), (4, ""), (5, "1 2 3"), (None, "a")]
    docs = documents(rows).withColumn("lang", F.lit(None).cast("string"))
    out = corpus_pipeline.language_id(spark, docs, "")
    assert out.columns == COLUMNS and Counter(r.doc_id for r in out.collect()) == Counter([1, 2, None])


def test_documents_without_an_id_draw_by_their_texts(spark, documents):
    """Weights 3, 1 and 2 over equal sources: the second gets less than its words, so some documents stay out."""
    rows = [(None if k % 3 == 1 else k, f"w{k} " * 5) for k in range(900)]
    out = corpus_pipeline.mixing(spark, documents(rows), "")
    taken = Counter(r.text for r in out.where("source = 's1'").collect())
    # a budget of 4.5 sources: the first stops at 2, the others share 2.5 by weight, so 250 of its 300 documents
    assert set(taken.values()) == {1} and 215 < len(taken) < 285
    again = corpus_pipeline.mixing(spark, documents(rows), "")
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, out.collect()))
