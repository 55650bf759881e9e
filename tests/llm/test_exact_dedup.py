from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cashloom.llm.exact_dedup import chunks, deduplicated


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, text or ""))
    out = []
    for text, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(doc_id, best, len(members), digest) for doc_id, _ in members]
    return sorted(out, key=str)


def found(frame):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in frame.collect()), key=str)


def rows():
    rng = random.Random(5)
    words = ["ab", "cé", "d\U0001f600", "xz", "m a", "\t"]
    long = " ".join(rng.choice(words) for _ in range(40_000))
    texts = ["", None, " \n", "a b", "ab", "a b", long, long.replace(" ", "\n"), long + "x", "y" * 50_000]
    return [(i, t) for i, t in enumerate(texts * 2)] + [(None, "ab"), (-5, "ab"), (3, "a b")]


@pytest.mark.parametrize("weak", [False, True])
def test_against_brute_force(spark, documents, weak):
    """Also with a fingerprint that nearly all chunks share, so that identifiers need their variants."""
    options = {"fingerprint": lambda c: F.pmod(F.length(c), F.lit(3)).cast("long"), "low": 4, "high": 40} if weak else {}
    given = [r for r in rows() if not weak or len(r[1] or "") < 1000]
    given += [(100, "abcdefgh1234"), (101, "abcdefgh1243"), (102, "abcd efgh1234"), (103, "hgfedcba1234")]
    assert found(deduplicated(documents(given), **options)) == expected(given)


def test_one_of_repeated_rows_stays(documents):
    kept = deduplicated(documents([(7, "a b")] * 5 + [(None, "c")] * 2)).where("kept")
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["7", "None"]


def test_chunks_cover_the_text(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abdeklmnéx\U0001f600") for _ in range(30_000))
    frame = spark.createDataFrame([(text,), ("z" * 20_000,), ("",)], "t string")
    for row in frame.select("t", chunks(F.col("t"), 16, 256).alias("c")).collect():
        assert "".join(row.c) == row.t
        assert all(16 <= len(c) <= 256 for c in row.c[:-1])
    shifted = frame.select(chunks(F.concat(F.lit("qq"), "t"), 16, 256).alias("c"), chunks(F.col("t"), 16, 256).alias("d")).first()
    assert len(set(shifted.c) & set(shifted.d)) > 0.9 * len(shifted.d)


def test_empty_table_and_clashing_columns(spark, documents):
    assert deduplicated(documents([])).count() == 0
    other = documents([(1, "a"), (2, "a")]).selectExpr("doc_id", "text", "1 AS recipe", "2 AS row", "3 AS h", "4 AS best")
    assert found(deduplicated(other)) == expected([(1, "a"), (2, "a")])


def test_no_python_in_the_plan(documents):
    plan = deduplicated(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
