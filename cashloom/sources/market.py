"""Market-data lines to one typed row per market object."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashloom.functions import quoted, quoted_list
from cashloom.functions.cycles import tenor_years
from cashloom.functions.text import FIELD_SEPARATOR, LIST_SEPARATOR, doubles, split_trimmed, to_date

# Fixed values of the input format: kinds of market object.
TERM_STRUCTURE = "TermStructure"
REFERENCE_RATE = "ReferenceRate"
REFERENCE_INDEX = "ReferenceIndex"
EXCHANGE_RATE = "ForeignExchangeRate"
DATED_KINDS = (REFERENCE_RATE, REFERENCE_INDEX, EXCHANGE_RATE)
RATE_KINDS = (TERM_STRUCTURE, REFERENCE_RATE)

BASE_SCENARIO = "base"


def parse_market(lines: DataFrame) -> DataFrame:
    """``code, kind, points, values, place``; points stay text, for they are dates or tenors."""
    tokens = lines.selectExpr(f"{split_trimmed('value', FIELD_SEPARATOR)} AS token", "place")
    return tokens.selectExpr(
        "get(token, 0) AS code",
        "get(token, 2) AS kind",
        f"{split_trimmed('get(token, 3)', LIST_SEPARATOR)} AS points",
        f"{doubles('get(token, 4)')} AS values",
        "place",
    )


def lines_of(lines: DataFrame, codes: DataFrame, limit: int = 64 * 1024 * 1024, code_bytes: int = 64) -> DataFrame:
    """The market lines, still text, of the codes that are used; ``codes`` has the column ``code``.

    A line is parsed into series only after that. The used codes are broadcast if they are few enough
    for ``limit``, and otherwise joined with the lines' own codes.
    """
    used = codes.where("code IS NOT NULL").distinct()
    few = used.limit(limit // code_bytes + 1).count() <= limit // code_bytes
    first = f"substring_index(value, {quoted(FIELD_SEPARATOR)}, 1)"
    wanted = used.withColumnRenamed("code", "__code")
    found = lines.withColumn("__of", F.expr(first))
    joined = found.join(F.broadcast(wanted) if few else wanted, F.col("__of") == F.col("__code"), "left_semi")
    return joined.select(*lines.columns)


def readable_points(pairs: str, place: str, number: str) -> str:
    """Whether an object has points, every one reads, and every number is finite; ``pairs`` come from points and values."""
    bad = f"__pair.{place} IS NULL OR __pair.{number} IS NULL OR __pair.{number} - __pair.{number} <> 0D"
    return f"coalesce(size({pairs}) > 0 AND NOT exists({pairs}, __pair -> {bad}), false)"


def last_per_code(market: DataFrame) -> DataFrame:
    """One row per code: the one furthest down the input."""
    fields = [c for c in market.columns if c not in ("code", "place")]
    last = F.max_by(F.struct(*fields), "place").alias("last")
    return market.groupBy("code").agg(last).select("code", "last.*")


def dated_points(market: DataFrame, *kinds: str) -> DataFrame:
    """``code, kind, date, value`` of the dated kinds asked for; all three by default."""
    return _points(market, kinds or DATED_KINDS).selectExpr("code", "kind", f"{to_date('point')} AS date", "value")


def curve_points(market: DataFrame) -> DataFrame:
    """``code, kind, tenor, years, value`` of the term structures."""
    return _points(market, (TERM_STRUCTURE,)).selectExpr(
        "code", "kind", "point AS tenor", f"{tenor_years('point')} AS years", "value"
    )


def _points(market: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    wanted = market.where(f"kind IN ({quoted_list(kinds)})")
    # The outer form: from an inner one the optimizer derives a filter on the array's size and
    # pushes it down, where the arrays would be built a second time.
    pairs = wanted.selectExpr("code", "kind", "inline_outer(arrays_zip(points, values)) AS (point, value)")
    return pairs.where("point IS NOT NULL")


def in_scenarios(market: DataFrame, shifts: Mapping[str, float]) -> DataFrame:
    """The market once per scenario, with the scenario's shift added to every rate."""
    named = ", ".join(f"struct({quoted(name)}, {float(shift)}D)" for name, shift in shifts.items())
    spread = market.selectExpr("*", f"inline(array({named})) AS (scenario, shift)")
    moved = f"if(kind IN ({quoted_list(RATE_KINDS)}), transform(values, v -> v + shift), values)"
    return spread.withColumn("values", F.expr(moved)).drop("shift")
