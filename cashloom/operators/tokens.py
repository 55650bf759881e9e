"""Lines to tokens: one array per line, or one row per token."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashloom.functions.text import WORD_SEPARATOR, split_trimmed


def token_arrays(lines: DataFrame, text: str, separator: str = WORD_SEPARATOR) -> DataFrame:
    """Every line with its ``tokens``."""
    return lines.withColumn("tokens", F.expr(split_trimmed(text, separator)))


def token_rows(lines: DataFrame, text: str, separator: str = WORD_SEPARATOR) -> DataFrame:
    """One row ``token`` per token; a line of separators only gives none."""
    # The outer form keeps the optimizer from splitting every text a second time in a filter.
    tokens = lines.selectExpr(f"explode_outer({split_trimmed(text, separator)}) AS token")
    return tokens.where("token IS NOT NULL")


def token_counts(lines: DataFrame, text: str, separator: str = WORD_SEPARATOR) -> DataFrame:
    """How often each token occurs; tasks count their own lines before anything is shuffled."""
    return token_rows(lines, text, separator).groupBy("token").agg(F.count("*").alias("n"))
