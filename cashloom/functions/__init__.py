"""Builders of SQL expressions: text to typed values, dates, day counts, rounding.

Each takes expressions as text (a column name is one) and returns one. An evaluation uses some
thousand operators; as text they reach the JVM in one call per column instead of one each. Where
a builder binds a variable around an expression it was given, the name starts with two underscores
so that it cannot hide a column.
"""

from __future__ import annotations


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is thus evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted_list(texts) -> str:
    return ", ".join(quoted(t) for t in texts)
