"""Conversations as training examples: one example an assistant turn, with all turns before it as context.

A turn is written as ``<|start|>role<|text|>text<|end|>``, and the formatted conversation is its turns
in order. ``examples`` gives each assistant turn as an example: its text is the formatted conversation
up to ``end``, and only ``loss_start`` to ``loss_end`` is trained on. Contexts are stored once, as
offsets into the conversation, so that a conversation of many turns doesn't grow with their square;
``example_texts`` writes them out.

In roles and texts ``\\``, ``<`` and ``[`` become ``\\e``, ``\\l`` and ``\\b``, which leaves no control
string of this template, nor any other that starts with ``<`` or ``[``, and can be undone.

Defined results: a null role or text counts as empty; turns are ordered by turn (null first), then role
and text, and repeated rows are repeated turns; rows without conv_id are one conversation; a
conversation without an assistant turn has no example; an empty table gives empty ones. Offsets count
code points. A formatted conversation is one value in one row, as it is in the training file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, TEXT, END = "<|start|>", "<|text|>", "<|end|>"
TARGET_ROLE = "assistant"


def _replaced(value: Column, old: str, new: str) -> Column:
    return F.replace(value, F.lit(old), F.lit(new))


def escaped(text: Column) -> Column:
    """Without any ``<`` and ``[``; each backslash is followed by e, l or b."""
    return _replaced(_replaced(_replaced(text, "\\", "\\e"), "<", "\\l"), "[", "\\b")


def unescaped(text: Column) -> Column:
    return _replaced(_replaced(_replaced(text, "\\l", "<"), "\\b", "["), "\\e", "\\")


def formatted_turns(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    target_role: str = TARGET_ROLE,
) -> DataFrame:
    """conv_id, position (from 0), segment, start, text_start, text_end, trained: one row a turn."""
    rows = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    head = F.concat(F.lit(START), escaped(F.col("role")), F.lit(TEXT))
    written = rows.select(
        "*", head.alias("head"), escaped(F.col("text")).alias("body"), (F.col("role") == target_role).alias("trained")
    ).withColumn("segment", F.concat("head", "body", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    end = F.sum(F.length("segment").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = written.withColumn("position", F.row_number().over(order) - 1).withColumn("start", end - F.length("segment"))
    text_start = F.col("start") + F.length("head")
    return placed.select(
        "conv_id", "position", "segment", "start", text_start.alias("text_start"), (text_start + F.length("body")).alias("text_end"), "trained", "body"
    )


def conversation_texts(turns: DataFrame) -> DataFrame:
    """conv_id, formatted: the whole conversation in the template."""
    parts = F.array_sort(F.collect_list(F.struct("position", "segment")))
    joined = F.array_join(F.transform(parts, lambda p: p["segment"]), "")
    return turns.groupBy("conv_id").agg(joined.alias("formatted"))


def examples(turns: DataFrame) -> DataFrame:
    """conv_id, example (its turn's position), loss_start, loss_end, end, reply: one row an example."""
    return turns.where("trained").select(
        "conv_id",
        F.col("position").alias("example"),
        F.col("text_start").alias("loss_start"),
        F.col("text_end").alias("loss_end"),
        (F.col("text_end") + len(END)).alias("end"),
        F.col("body").alias("reply"),
    )


def trained_texts(formatted: Column, found: Column) -> Column:
    """The texts under the loss mask of a conversation's examples, cut out of ``formatted``.

    ``found`` is the array of its examples (example, loss_start, loss_end, end) in order. It is an error if
    the formatted conversation up to ``end`` doesn't hold just the turns up to the example's, or the loss
    doesn't lie between its last TEXT and END. Each example is checked from the end of the one before.
    """

    def cut(x: Column, i: Column) -> Column:
        before = F.get(found, i - 1)
        since, turn = F.coalesce(before["end"], F.lit(0)), F.coalesce(before["example"], F.lit(-1))

        def text(start: Column, end: Column) -> Column:
            return F.substring(formatted, (start + 1).cast("int"), (end - start).cast("int"))

        holds = (
            (F.size(F.split(text(since, x["end"]), "<\\|end\\|>", -1)) - 1 == x["example"] - turn)
            & (text(x["loss_start"] - len(TEXT), x["loss_start"]) == TEXT)
            & (text(x["loss_end"], x["end"]) == END)
            & ~F.contains(text(x["loss_start"], x["loss_end"]), F.lit("<"))
        )
        wrong = F.raise_error(F.concat(F.lit("offsets of example "), x["example"].cast("string"), F.lit(" don't fit its conversation")))
        return F.when(holds, unescaped(text(x["loss_start"], x["loss_end"]))).otherwise(wrong.cast("string"))

    return F.transform(found, cut)


def example_texts(turns: DataFrame) -> DataFrame:
    """Examples with ``text``, context included: as many characters as all contexts together have."""
    whole = conversation_texts(turns).withColumnRenamed("conv_id", "of")
    found = examples(turns).join(whole, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    return found.withColumn("text", F.expr("substring(formatted, 1, cast(end AS int))")).drop("formatted")


def parsed_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, as they were."""
    segments = F.split(formatted, "<\\|end\\|>", -1)
    return F.transform(
        F.slice(segments, 1, F.size(segments) - 1),
        lambda s: F.struct(
            unescaped(F.replace(F.substring_index(s, TEXT, 1), F.lit(START), F.lit(""))).alias("role"),
            unescaped(F.substring_index(s, TEXT, -1)).alias("text"),
        ),
    )
