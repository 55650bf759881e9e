"""Contracts and market data derived from the order and line-item tables.

The rules are those of ``FIXTURES.md``; ``k`` is the order key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashloom.functions import quoted, quoted_list
from cashloom.functions.text import FIELD_SEPARATOR, LIST_SEPARATOR, NULL_MARKER
from cashloom.session import materialised, spread
from cashloom.sources.layouts import FULL_LAYOUT, SHORT_LAYOUT, Term
from cashloom.sources.market import (
    EXCHANGE_RATE,
    REFERENCE_INDEX,
    REFERENCE_RATE,
    TERM_STRUCTURE,
    in_scenarios,
    last_per_code,
    parse_market,
)

BEFORE_ALL = "1994-12-31"
MIDWAY = "1998-01-01"
SHIFTS = {"base": 0.0, "up": 0.01, "down": -0.01}
DISCOUNT_CURVE = "CRV_0"
TENORS = ["1M", "3M", "6M", "1Y", "2Y", "5Y", "10Y"]

MICRO = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Texts planted in the lines with faults: term, every how many contracts, text; none is the marker.
FAULTS = [
    ("maturity_date", 103, "2016-13-01"),
    ("interest_cycle", 107, "quarterly"),
    ("interest_cycle", 127, "3 X -"),
    ("day_count", 109, "ACT/360"),
    ("role", 113, "BUY"),
    ("reset_cycle", 131, "200000000M"),
    ("currency", 137, None),
    ("contract_id", 139, None),
    ("purchase_price", 149, None),
    ("termination_price", 151, None),
    ("notional", 157, "NaN"),
    ("premium_discount", 163, "Infinity"),
]


def contract_terms(spoiled: bool = False, faults: bool = False) -> dict[str, str]:
    """Each term as the text of a contract line, null where the term is absent.

    ``spoiled`` plants an unreadable purchase price in every 101st contract, ``faults`` the texts of
    ``FAULTS`` as well.
    """
    terms = _plain_terms(spoiled or faults)
    for term, every, text in FAULTS if faults else []:
        planted = "NULL" if text is None else quoted(text)
        terms[term] = f"if(o_orderkey % {every} = 0, {planted}, {terms[term]})"
    return terms


def _plain_terms(spoiled: bool) -> dict[str, str]:
    k, priority, start = "o_orderkey", "left(o_orderpriority, 1)", "cast(o_orderdate AS date)"
    resets = f"({k} % 17 = 0 OR {k} % 2 = 1)"
    price = f"if({k} % 11 = 0, cast(0.99D * o_totalprice AS string), NULL)"

    def day(date: str) -> str:
        return f"concat(cast({date} AS string), 'T00')"

    return {
        "status_date": day(start),
        "role": "if(o_orderstatus = 'P', 'RPL', 'RPA')",
        "contract_id": f"concat('CT', {k})",
        "interest_anchor": day(
            f"add_months({start}, CASE {priority} WHEN '1' THEN 1 WHEN '2' THEN 3 WHEN '3' THEN 6 WHEN '4' THEN 12 END)"
        ),
        "interest_cycle": f"CASE {priority} WHEN '1' THEN '1M-' WHEN '2' THEN '1Q-' WHEN '3' THEN '6M-'"
        " WHEN '4' THEN '1Y-' END",
        "nominal_rate": f"cast((10 + 5 * ({k} % 8)) / 1000 AS string)",
        "day_count": _choice(k, ["A/365", "A/360", "30E/360", "A/A ISDA"]),
        "currency": _choice(k, ["EUR", "USD", "CHF"]),
        "deal_date": day(start),
        "initial_exchange_date": day(start),
        "maturity_date": day(f"add_months({start}, cast(12 + 6 * ({k} % 9) AS int))"),
        "notional": "cast(o_totalprice AS string)",
        "purchase_date": f"if({k} % 11 = 0, {day(f'add_months({start}, 5)')}, NULL)",
        "purchase_price": f"if({k} % 101 = 0, 'n/a', {price})" if spoiled else price,
        "termination_date": f"if({k} % 13 = 0, {day(f'add_months({start}, 9)')}, NULL)",
        "termination_price": f"if({k} % 13 = 0, cast(1.01D * o_totalprice AS string), NULL)",
        "scaling_code": f"if({k} % 7 = 0, concat('IDX_', {k} % 5), NULL)",
        "scaling_index": f"if({k} % 7 = 0, '100.0', NULL)",
        "reset_anchor": f"if({resets}, {day(f'add_months({start}, 6)')}, NULL)",
        "reset_cycle": f"if({resets}, '6M-', NULL)",
        "rate_spread": f"cast(5 * ({k} % 3) / 1000 AS string)",
        "reset_code": f"CASE WHEN {k} % 17 = 0 THEN 'MISSING' WHEN {k} % 6 = 1 THEN concat('CRV_', {k} % 5)"
        f" WHEN {k} % 2 = 1 THEN concat('REF_', {k} % 5) END",
        "reset_cycle_point": "'B'",
        "fixing_days": "'2D'",
        "next_reset_rate": f"if({k} % 4 = 1, '0.03', NULL)",
        "rate_multiplier": "'1.0'",
        "rate_term": "'6M'",
        "premium_discount": f"if({k} % 10 = 0, '-100.0', '0.0')",
    }


def _choice(key: str, names: list[str]) -> str:
    return f"element_at(array({quoted_list(names)}), cast({key} % {len(names)} AS int) + 1)"


def rendered(terms: dict[str, str], layout: Sequence[Term]) -> str:
    """One ``;`` line; positions the layout does not read stay empty."""
    tokens = ["''"] * (max(t.position for t in layout) + 1)
    for term in layout:
        tokens[term.position] = f"coalesce({terms[term.name]}, {quoted(NULL_MARKER)})"
    return f"concat_ws({quoted(FIELD_SEPARATOR)}, {', '.join(tokens)})"


def contract_lines(
    spark: SparkSession,
    sf_dir: str,
    layout: Sequence[Term] = FULL_LAYOUT,
    spoiled: bool = False,
    portfolio: bool = False,
    faults: bool = False,
) -> DataFrame:
    """Contract lines as ``value``, on request with the customer's segment as ``portfolio``."""
    orders = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    kept = []
    if portfolio:
        customer = table(spark, sf_dir, "customer")
        orders = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
        kept = ["c_mktsegment AS portfolio"]
    return orders.selectExpr(f"{rendered(contract_terms(spoiled, faults), layout)} AS value", *kept)


def short_contract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_lines(spark, sf_dir, SHORT_LAYOUT)


def monthly_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per region and ship month: discount, quantity and tax averages, in millionths.

    Line items are summed per supplier and month before anything is joined, so a supplier with a
    large share of the lines leaves every scan task as one row a month. Sums are over whole
    numbers (the columns have at most two decimals) and so do not depend on row order.
    """
    items = table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey",
        "trunc(cast(l_shipdate AS date), 'MM') AS month",
        "cast(round(l_discount * 100) AS bigint) AS discount",
        "cast(l_quantity AS bigint) AS quantity",
        "cast(round(l_tax * 100) AS bigint) AS tax",
    )
    columns = ["discount", "quantity", "tax"]
    per_supplier = items.groupBy("l_suppkey", "month").agg(
        F.count("*").alias("n"), *[F.sum(c).alias(c) for c in columns]
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    placed = per_supplier.join(supplier, per_supplier.l_suppkey == supplier.s_suppkey).join(
        nation, supplier.s_nationkey == nation.n_nationkey
    )
    totals = placed.groupBy(F.col("n_regionkey").alias("region"), "month").agg(
        *[F.sum(c).alias(c) for c in ["n", *columns]]
    )
    return totals.selectExpr(
        "region",
        "month",
        f"(2 * discount * {MICRO // 100} + n) div (2 * n) AS discount",
        f"(2 * quantity * {MICRO} + n) div (2 * n) AS quantity",
        f"(2 * tax * {MICRO // 100} + n) div (2 * n) AS tax",
    )


def market_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market lines as ``value`` with ``place``; each rate series comes first as zeros, then right.

    A line holds one point per calendar month, whatever the number of line items.
    """
    months = F.sort_array(F.collect_list(F.struct("month", "discount", "quantity", "tax"))).alias("m")
    series = monthly_averages(spark, sf_dir).groupBy("region").agg(months)
    points = f"array_join(transform(m, p -> concat(cast(p.month AS string), 'T00')), {quoted(LIST_SEPARATOR)})"

    def record(place: int, prefix: str, kind: str, micros: str) -> str:
        values = f"array_join(transform(m, p -> cast({micros} / {MICRO} AS string)), {quoted(LIST_SEPARATOR)})"
        line = f"concat_ws({quoted(FIELD_SEPARATOR)}, concat('{prefix}', region), 'x', '{kind}', {points}, {values})"
        return f"struct(cast(region * 8 + {place} AS bigint), {line})"

    records = [
        record(0, "REF_", REFERENCE_RATE, "0"),
        record(1, "IDX_", REFERENCE_INDEX, f"(p.quantity + {100 * MICRO})"),
        record(2, "FX_", EXCHANGE_RATE, f"(p.tax + {MICRO})"),
        record(3, "REF_", REFERENCE_RATE, "p.discount"),
    ]
    dated = series.selectExpr(f"inline(array({', '.join(records)})) AS (place, value)")
    region = table(spark, sf_dir, "region").selectExpr("r_regionkey AS region")
    rates = ", ".join(f"cast((5 + region + {2 * i}) / 1000 AS string)" for i in range(len(TENORS)))
    curve = f"concat_ws({quoted(LIST_SEPARATOR)}, {rates})"
    curves = region.selectExpr(
        "cast(region * 8 + 4 AS bigint) AS place",
        f"concat_ws({quoted(FIELD_SEPARATOR)}, concat('CRV_', region), 'x', '{TERM_STRUCTURE}',"
        f" {quoted(LIST_SEPARATOR.join(TENORS))}, {curve}) AS value",
    )
    return dated.unionByName(curves)


def scenario_table(spark: SparkSession, sf_dir: str, steps: int = 8) -> DataFrame:
    """Scenarios as data: ``steps`` shifts for each nation, ``scenario`` and ``shift``."""
    nations = table(spark, sf_dir, "nation").selectExpr("n_nationkey", "n_name", f"explode(sequence(0, {steps - 1})) AS step")
    return nations.selectExpr("concat(n_name, '_', step) AS scenario", f"(n_nationkey * {steps} + step - 100) / 10000D AS shift")


def market_table(spark: SparkSession, sf_dir: str, scenarios: bool = False) -> DataFrame:
    """One row per market object, kept in shared storage: it is small and read more than once."""
    market = last_per_code(parse_market(market_lines(spark, sf_dir)))
    return materialised(in_scenarios(market, SHIFTS) if scenarios else market)


def part_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reference rate for every part: its average discount by ship month, in millionths.

    As many objects as parts, each with at most a point for every calendar month.
    """
    items = table(spark, sf_dir, "lineitem").selectExpr(
        "l_partkey", "trunc(cast(l_shipdate AS date), 'MM') AS month", "cast(round(l_discount * 100) AS bigint) AS discount"
    )
    months = items.groupBy("l_partkey", "month").agg(F.count("*").alias("n"), F.sum("discount").alias("discount"))
    rates = months.selectExpr("l_partkey", "month", f"(2 * discount * {MICRO // 100} + n) div (2 * n) AS micros")
    series = rates.groupBy("l_partkey").agg(F.sort_array(F.collect_list(F.struct("month", "micros"))).alias("m"))
    return series.selectExpr(
        "concat('PRT_', l_partkey) AS code",
        f"{quoted(REFERENCE_RATE)} AS kind",
        "transform(m, p -> concat(cast(p.month AS string), 'T00')) AS points",
        f"transform(m, p -> p.micros / {MICRO}) AS values",
    )


def part_market_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The objects of ``part_market`` as lines, ``value``."""
    lists = [f"array_join({texts}, {quoted(LIST_SEPARATOR)})" for texts in ("points", "transform(values, v -> cast(v AS string))")]
    return part_market(spark, sf_dir).selectExpr(f"concat_ws({quoted(FIELD_SEPARATOR)}, code, 'x', kind, {', '.join(lists)}) AS value")
