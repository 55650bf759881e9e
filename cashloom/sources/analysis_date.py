"""The analysis date: first token of the first line of a file, or a text constant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashloom.functions import quoted
from cashloom.functions.text import FIELD_SEPARATOR, split_trimmed, to_date


def first_date(lines: DataFrame) -> DataFrame:
    """One row ``t0``: the date that opens the first line; fails if it is not a date."""
    first = lines.orderBy("place").limit(1).selectExpr(f"get({split_trimmed('value', FIELD_SEPARATOR)}, 0) AS token")
    return first.selectExpr(f"{checked_date('token')} AS t0")


def checked_date(text: str) -> str:
    complaint = f"concat('not an analysis date: ', coalesce({text}, 'nothing'))"
    return f"coalesce({to_date(text)}, cast(raise_error({complaint}) AS date))"


def with_analysis_date(contracts: DataFrame, t0: str | DataFrame) -> DataFrame:
    """Attach the analysis date: a constant, or the single row of ``first_date``.

    A file without a line has no such row, which is an error like any other text that is no date.
    """
    none = F.raise_error("not an analysis date: the file is empty").cast("date")
    value = F.expr(checked_date(quoted(t0))) if isinstance(t0, str) else F.coalesce(t0.scalar(), none)
    return contracts.withColumn("t0", value)
