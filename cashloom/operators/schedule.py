"""Event dates of a principal-at-maturity contract, held in the contract's own row.

Interest and reset dates are regular and come from ``sequence``. Nothing is joined or shuffled,
and two lines with one contract id stay two contracts, as they are in the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cashloom.functions import quoted_list
from cashloom.functions.cycles import (
    NO_DATES,
    cycle_parts,
    cycle_step,
    plus_cycle,
    regular_dates,
    steps_upto,
    without_stub,
)
from cashloom.functions.daycount import CONVENTIONS

# Order of events on one day.
IED, IP, RRF, RR, PRD, TD, MD = range(1, 8)
EVENT_NAMES = ["IED", "IP", "RRF", "RR", "PRD", "TD", "MD"]

# Contract status without a fault.
OK = "ok"

# Terms without which an event would lack something, whatever the contract.
NEEDED = ["contract_id", "currency", "initial_exchange_date", "maturity_date", "notional", "nominal_rate"]
# Prices that a date asks for.
PRICED = {"purchase_date": "purchase_price", "termination_date": "termination_price"}
NUMBERS = [
    "notional",
    "nominal_rate",
    "purchase_price",
    "termination_price",
    "rate_spread",
    "next_reset_rate",
    "rate_multiplier",
    "premium_discount",
]

# Contract roles.
ASSET, LIABILITY = "RPA", "RPL"


def role_sign(role: str) -> str:
    """+1 for an asset, -1 for a liability, null for anything else."""
    return f"CASE {role} WHEN '{ASSET}' THEN 1D WHEN '{LIABILITY}' THEN -1D END"


def event_name(kind: str) -> str:
    return f"element_at(array({quoted_list(EVENT_NAMES)}), {kind})"


def contract_status() -> str:
    """What is wrong with the terms, comma-separated, or ``ok``: nothing is evaluated in silence.

    Names the terms whose text did not read, those that every contract needs and this one lacks, a
    price that its date asks for, numbers that are infinite or none, and texts that stand for no cycle,
    day count or role. A contract without a fault has events without nulls.
    """

    def missing(term: str, asked: str = "true") -> str:
        return f"if({asked} AND {term} IS NULL AND NOT array_contains(term_errors, '{term}'), 'missing {term}', NULL)"

    faults = [missing(t) for t in NEEDED]
    faults += [missing(price, f"{date} IS NOT NULL") for date, price in PRICED.items()]
    faults += [f"if({n} - {n} = 0D, NULL, if({n} IS NULL, NULL, 'not finite {n}'))" for n in NUMBERS]
    for cycle, step in (("interest_cycle", "interest_step"), ("reset_cycle", "reset_step")):
        faults.append(f"if({cycle} IS NOT NULL AND {step} IS NULL, 'unknown {cycle}', NULL)")
    faults.append(f"if(coalesce(day_count IN ({quoted_list(CONVENTIONS)}), false), NULL, 'unknown day_count')")
    faults.append("if(sign IS NULL, 'unknown role', NULL)")
    faults.append("if(maturity_date < initial_exchange_date, 'matures before its exchange', NULL)")
    # texts, no arrays gone through by a lambda: such expressions are interpreted, with all that they are given
    unread = "if(size(term_errors) > 0, concat('unreadable ', array_join(term_errors, ', unreadable ')), NULL)"
    return f"coalesce(nullif(concat_ws(', ', {unread}, {', '.join(faults)}), ''), '{OK}')"


def with_schedule(contracts: DataFrame) -> DataFrame:
    """Add the future interest and reset dates and the facts of the contract's life.

    Needs the terms of the full layout and ``t0``; ``term_errors`` are taken into ``contract_status``,
    which tells what is wrong with a contract and stays with it to its events. Events lie after the analysis date and not
    after the last day, which is the termination or the maturity. ``running`` contracts are past
    their initial exchange at the analysis date; interest accrues from ``since``, their last
    payment up to then.
    """
    ied, md = "initial_exchange_date", "maturity_date"
    stop = f"if(termination_date >= {ied} AND termination_date <= {md}, termination_date, NULL)"
    if "term_errors" not in contracts.columns:
        contracts = contracts.selectExpr("*", "cast(array() AS array<string>) AS term_errors")
    life = contracts.selectExpr(
        "*",
        f"{role_sign('role')} AS sign",
        f"t0 >= {ied} AS running",
        f"greatest({ied}, t0) AS begin",
        f"{stop} AS terminated_on",
        f"coalesce({stop}, {md}) AS last_day",
        f"{cycle_parts('interest_cycle')} AS interest_parts",
        f"{cycle_parts('reset_cycle')} AS reset_parts",
    ).selectExpr(
        "* EXCEPT (interest_parts, reset_parts)",
        f"{cycle_step('interest_parts')} AS interest_step",
        f"{cycle_step('reset_parts')} AS reset_step",
    ).selectExpr(
        "*",
        f"{contract_status()} AS contract_status",
        f"coalesce(last_day <= t0 OR {md} < {ied}, true) AS ended",
        f"if(purchase_date > t0 AND purchase_date >= {ied} AND purchase_date <= last_day, purchase_date, NULL)"
        " AS purchased_on",
        f"coalesce(interest_anchor, {plus_cycle(ied, 'interest_step')}) AS interest_from",
        f"coalesce(reset_anchor, {plus_cycle(ied, 'reset_step')}) AS reset_from",
    )
    gridded = life.selectExpr(
        "*",
        f"{regular_dates('interest_from', 'interest_step', md)} AS interest_all",
        f"{regular_dates('reset_from', 'reset_step', md)} AS reset_all",
    ).selectExpr(
        "*",
        f"{without_stub('interest_all', 'interest_step', md)} AS interest_grid",
        f"{without_stub('reset_all', 'reset_step', md)} AS reset_grid",
    )

    def upto(date: str, kind: str) -> str:
        return f"least({steps_upto(date, f'{kind}_from', f'{kind}_step')}, size({kind}_grid))"

    counted = gridded.selectExpr(
        "*",
        f"{upto('begin', 'interest')} AS interest_gone",
        f"{upto('begin', 'reset')} AS reset_gone",
        f"{upto('last_day', 'interest')} AS interest_ahead",
        f"{upto('last_day', 'reset')} AS reset_ahead",
    )

    def within(kind: str) -> str:
        """The dates after ``begin`` and up to the last day."""
        gone, ahead = f"{kind}_gone", f"{kind}_ahead"
        return f"if(begin <= last_day AND {ahead} > {gone}, slice({kind}_grid, {gone} + 1, {ahead} - {gone}), {NO_DATES})"

    listed = counted.selectExpr(
        "*",
        f"{within('interest')} AS regular_payments",
        f"{within('reset')} AS reset_dates",
        "if(running, get(interest_grid, interest_gone - 1), NULL) AS last_paid",
    )
    return listed.selectExpr(
        "*",
        f"if(last_day = {md}, concat(regular_payments, array({md})), regular_payments) AS interest_dates",
        f"if(last_paid > {ied}, last_paid, {ied}) AS since",
    ).drop(
        "interest_all", "reset_all", "interest_grid", "reset_grid", "interest_ahead", "reset_ahead", "regular_payments", "last_paid"
    )


def with_event_dates(scheduled: DataFrame) -> DataFrame:
    """Add ``event_dates``, all of them by kind, and ``kind_ends``, where each kind ends in it."""

    def single(date: str, there: str) -> str:
        return f"if({there}, array({date}), {NO_DATES})"

    groups = [
        single("initial_exchange_date", "NOT running"),
        "interest_dates",
        "reset_dates",
        single("purchased_on", "purchased_on IS NOT NULL"),
        single("terminated_on", "terminated_on IS NOT NULL"),
    ]
    ends = [" + ".join(f"size({g})" for g in groups[: n + 1]) for n in range(len(groups))]
    maturity = single("maturity_date", "terminated_on IS NULL")
    return scheduled.selectExpr(
        "*",
        f"if(ended, {NO_DATES}, concat({', '.join(groups)}, {maturity})) AS event_dates",
        f"array({', '.join(ends)}) AS kind_ends",
    )


def event_kind(position: str) -> str:
    """Kind of the event at a position of ``event_dates``."""
    fixed = f"next_reset_rate IS NOT NULL AND {position} = kind_ends[1]"
    return (
        f"CASE WHEN {position} < kind_ends[0] THEN {IED} WHEN {position} < kind_ends[1] THEN {IP}"
        f" WHEN {position} < kind_ends[2] THEN if({fixed}, {RRF}, {RR})"
        f" WHEN {position} < kind_ends[3] THEN {PRD} WHEN {position} < kind_ends[4] THEN {TD} ELSE {MD} END"
    )


def given_out(date: str, kind: str) -> str:
    """Whether an event is in the result: a buyer sees nothing from before the purchase."""
    return f"purchased_on IS NULL OR {date} > purchased_on OR ({date} = purchased_on AND {kind} >= {PRD})"
