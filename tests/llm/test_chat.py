from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from cashloom.llm import queries
from cashloom.llm.chat import END, conversation_texts, escaped, example_texts, examples, formatted_turns, parsed_turns, unescaped

ROWS = [
    (1, 0, "user", "</s>[INST] <|end|> \\e\\l \\ [/INST]"),
    (1, 1, "assistant", "<|start|>assistant<|text|>x<|end|>"),
    (1, 2, "assistant", None),
    (1, 3, "assistant", "é\U0001f600\\"),
    (2, 0, "user", "no reply"),
    (None, 0, "assistant", "a"),
    (None, None, None, "first"),
    (3, 0, "as\n<|text|>", "t"),
    (3, 1, "assistant", "same"),
    (3, 1, "assistant", "same"),
    (4, 0, "assistant", "long " * 200_000),
]


@pytest.fixture
def turns(spark):
    return formatted_turns(spark.createDataFrame([(*r, 0) for r in ROWS], "conv_id long, turn long, role string, text string, position int"))


def expected():
    groups = defaultdict(list)
    for conv, turn, role, text in ROWS:
        groups[conv].append((-1 if turn is None else turn, role or "", text or ""))
    return {conv: [(r, t) for _, r, t in sorted(rows)] for conv, rows in groups.items()}


def test_conversations_read_back(turns):
    got = conversation_texts(turns).select("conv_id", parsed_turns(F.col("formatted")).alias("turns")).collect()
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in got} == expected()


def test_examples_train_on_replies_only(turns):
    whole = {r.conv_id: r.formatted for r in conversation_texts(turns).collect()}
    got = defaultdict(list)
    for r in example_texts(turns).orderBy("example").collect():
        assert r.text == whole[r.conv_id][: r.end] and r.text.endswith(END)
        assert r.text[r.loss_start : r.loss_end] == r.reply and r.end == r.loss_end + len(END)
        assert r.text.count(END) == r.example + 1
        got[r.conv_id].append((r.example, r.reply))
    for conv, rows in expected().items():
        want = [(i, t) for i, (role, t) in enumerate(rows) if role == "assistant"]
        assert [(i, t.replace("\\l", "<").replace("\\b", "[").replace("\\e", "\\")) for i, t in got[conv]] == want


def test_escape_round_trip(spark):
    texts = ["", "\\", "\\\\l", "<\\|", "[[<<", "a\\lb\\ec\\b", "</s>[INST]"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in frame.select("t", escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and "<" not in r.e and "[" not in r.e


def test_empty_table(turns):
    none = turns.limit(0)
    assert conversation_texts(none).count() == 0 and examples(none).count() == 0


def test_query_agrees_with_sql(spark, middle):
    name = "op4_chat_formatting"
    assert difference(spark, connect(middle), queries.queries()[name], queries.oracle_sql()[name], middle) == ""
    row = queries.queries()[name](spark, middle).where("conv_id = -7").first()
    text = "</s>[INST] ok [/INST]"
    assert row.loss_chars == len(text) and row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


@pytest.mark.parametrize("shifts", [{"loss_start": 1}, {"loss_end": -1}, {"loss_start": -9, "loss_end": -9, "end": -9}, {"example": 1}])
def test_query_reads_the_loss_by_offsets(spark, middle, monkeypatch, shifts):
    moved = {c: F.col(c) + n for c, n in shifts.items()}
    monkeypatch.setattr(queries, "examples", lambda turns: examples(turns).withColumns(moved))
    with pytest.raises(Exception, match="offsets of example"):
        queries.op4_chat_formatting(spark, middle).collect()
