"""Rounding that any engine with IEEE doubles repeats bit by bit."""

from __future__ import annotations

# From here on every double is a whole number.
WHOLE_DOUBLES = float(1 << 52)


def half_up(value: str, digits: int, nudge: float = 0.0) -> str:
    """``value`` rounded half up to ``digits`` decimals; never negative zero.

    A value too large to have that many digits, an infinite one and NaN stay as they are. What lies
    less than ``nudge`` units of the last digit below a half counts as one.
    """
    scale = f"1e{digits}D"
    rounded = f"floor(({value}) * {scale} + {0.5 + nudge!r}D) / {scale}"
    return f"CASE WHEN abs({value}) < {WHOLE_DOUBLES / 10**digits!r}D THEN {rounded} ELSE {value} END"
