"""Positions of the contract terms in a ``;`` line."""

from __future__ import annotations

from typing import NamedTuple

TEXT, DATE, DOUBLE = "string", "date", "double"


class Term(NamedTuple):
    name: str
    position: int
    kind: str


# Fixed values of the input format: term, position in the line, type.
FULL_LAYOUT = [
    Term("status_date", 4, DATE),
    Term("role", 5, TEXT),
    Term("contract_id", 7, TEXT),
    Term("interest_anchor", 9, DATE),
    Term("interest_cycle", 10, TEXT),
    Term("nominal_rate", 11, DOUBLE),
    Term("day_count", 12, TEXT),
    Term("currency", 16, TEXT),
    Term("deal_date", 17, DATE),
    Term("initial_exchange_date", 18, DATE),
    Term("maturity_date", 19, DATE),
    Term("notional", 20, DOUBLE),
    Term("purchase_date", 21, DATE),
    Term("purchase_price", 22, DOUBLE),
    Term("termination_date", 23, DATE),
    Term("termination_price", 24, DOUBLE),
    Term("scaling_code", 25, TEXT),
    Term("scaling_index", 26, DOUBLE),
    Term("reset_anchor", 30, DATE),
    Term("reset_cycle", 31, TEXT),
    Term("rate_spread", 32, DOUBLE),
    Term("reset_code", 33, TEXT),
    Term("reset_cycle_point", 34, TEXT),
    Term("fixing_days", 35, TEXT),
    Term("next_reset_rate", 36, DOUBLE),
    Term("rate_multiplier", 37, DOUBLE),
    Term("rate_term", 38, TEXT),
    Term("premium_discount", 39, DOUBLE),
]

# Fixed values of the input format: the short layout, without market data.
SHORT_LAYOUT = [
    Term("status_date", 4, DATE),
    Term("role", 5, TEXT),
    Term("contract_id", 7, TEXT),
    Term("interest_anchor", 9, DATE),
    Term("interest_cycle", 10, TEXT),
    Term("nominal_rate", 11, DOUBLE),
    Term("day_count", 12, TEXT),
    Term("currency", 17, TEXT),
    Term("deal_date", 18, DATE),
    Term("initial_exchange_date", 19, DATE),
    Term("maturity_date", 20, DATE),
    Term("notional", 21, DOUBLE),
]
