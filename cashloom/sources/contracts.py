"""Contract lines to typed contract terms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cashloom.functions import quoted, quoted_list
from cashloom.functions.text import FIELD_SEPARATOR, NO_TEXTS, split_trimmed, to_date, to_double, unmarked
from cashloom.sources.layouts import DATE, DOUBLE, FULL_LAYOUT, TEXT, Term

KEEP_GOOD, TRUNCATE = "keep_good", "truncate"

_READERS = {TEXT: unmarked, DATE: to_date, DOUBLE: to_double}


def parse_contracts(
    lines: DataFrame,
    layout: Sequence[Term] = FULL_LAYOUT,
    on_error: str = KEEP_GOOD,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per line, one typed column per term, plus ``term_errors``.

    ``term_errors`` names the terms whose text is there but does not read as their type.
    With ``on_error=TRUNCATE`` a term that fails takes all terms after it with it; there an
    absent token and an absent number count as failures too, and ``term_errors`` holds only
    the first.
    """
    if on_error not in (KEEP_GOOD, TRUNCATE):
        raise ValueError(f"unknown fault policy {on_error!r}")
    tokens = lines.selectExpr(*keep, f"{split_trimmed('value', FIELD_SEPARATOR)} AS tokens")
    typed = tokens.selectExpr(*keep, "tokens", *[f"{_READERS[t.kind](_token(t))} AS {t.name}" for t in layout])
    if on_error == KEEP_GOOD:
        errors = ", ".join(f"if({_unreadable(t)}, {quoted(t.name)}, NULL)" for t in layout if t.kind != TEXT)
        # as text, which generated code puts together; a filter of an array would be interpreted
        named = f"concat_ws(',', {errors})"
        listed = f"if({named} = '', {NO_TEXTS}, split({named}, ',')) AS term_errors"
        return typed.selectExpr(*keep, *[t.name for t in layout], listed)
    failed = ", ".join(f"if({_fails(t)}, {rank}, NULL)" for rank, t in enumerate(layout))
    ranked = typed.selectExpr("*", f"coalesce(least({failed}), {len(layout)}) AS cut")
    names = quoted_list(t.name for t in layout)
    return ranked.selectExpr(
        *keep,
        *[f"if(cut > {rank}, {t.name}, NULL) AS {t.name}" for rank, t in enumerate(layout)],
        f"if(cut < {len(layout)}, array(get(array({names}), cut)), {NO_TEXTS}) AS term_errors",
    )


def with_full_terms(contracts: DataFrame) -> DataFrame:
    """Add the terms of the full layout that a shorter one lacks, as nulls."""
    missing = [t for t in FULL_LAYOUT if t.name not in contracts.columns]
    return contracts.selectExpr("*", *[f"cast(NULL AS {t.kind}) AS {t.name}" for t in missing])


def _token(term: Term) -> str:
    return f"get(tokens, {term.position})"


def _unreadable(term: Term) -> str:
    return f"{unmarked(_token(term))} IS NOT NULL AND {term.name} IS NULL"


def _fails(term: Term) -> str:
    """An absent token, an absent number, or a text that does not read as a date."""
    absent = f"{_token(term)} IS NULL"
    return {TEXT: absent, DOUBLE: f"{term.name} IS NULL", DATE: f"{absent} OR ({_unreadable(term)})"}[term.kind]
