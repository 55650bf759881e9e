"""Delimited text to typed values."""

from __future__ import annotations

from cashloom.functions import quoted

# Fixed values of the input format.
FIELD_SEPARATOR = ";"
LIST_SEPARATOR = "!"
WORD_SEPARATOR = " "
NULL_MARKER = "NULL"
DATE_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}(T([01][0-9]|2[0-4]))?$"

NO_TEXTS = "cast(array() AS array<string>)"
PATTERN_CHARACTERS = "\\^$.|?*+()[]{}"


def split_trimmed(text: str, separator: str) -> str:
    """Tokens of ``text`` without the empty ones at its end.

    Inner and leading empty tokens stay. An empty text is one empty token, a text of
    separators only has none. The separator is a text of one or more characters, not a pattern.
    """
    if not separator:
        raise ValueError("a separator has at least one character")
    # a character that is none of a pattern stands as it is: Java splits at a single one without a pattern
    mark = "".join(f"\\{c}" if c in PATTERN_CHARACTERS else c for c in separator)
    single = f"rtrim({quoted(separator)}, {text})"
    trimmed = single if len(separator) == 1 else f"regexp_replace({text}, {quoted(f'({mark})+$')}, '')"
    return (
        f"CASE WHEN {text} = '' THEN array('') WHEN NOT endswith({text}, {quoted(separator)}) THEN split({text}, {quoted(mark)})"
        f" WHEN {trimmed} = '' THEN {NO_TEXTS} ELSE split({trimmed}, {quoted(mark)}) END"
    )


def unmarked(text: str) -> str:
    """The text, or null where it is the marker of an absent value."""
    return f"nullif({text}, {quoted(NULL_MARKER)})"


def to_double(text: str) -> str:
    """A number; null for the marker and for anything that does not read as one."""
    return f"try_cast({unmarked(text)} AS double)"


def to_date(text: str) -> str:
    """``yyyy-MM-dd`` or ``yyyy-MM-ddTHH`` to a date, anything else to null.

    Hours are dropped, but hour 24 is the midnight that opens the next day.
    """
    day = f"try_cast(left({text}, 10) AS date)"
    return f"CASE WHEN {text} RLIKE {quoted(DATE_PATTERN)} THEN if({text} LIKE '%T24', date_add({day}, 1), {day}) END"


def doubles(text: str) -> str:
    """A ``!`` list of numbers to an array."""
    return f"transform({split_trimmed(text, LIST_SEPARATOR)}, __number -> {to_double('__number')})"


def date_text(date: str) -> str:
    return f"cast({date} AS string)"
