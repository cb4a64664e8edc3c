"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace set a word tokenizer splits on (blank, tab,
# newline, carriage return, form feed) as a regular-expression class.
WHITESPACE = r"[ \t\n\r\f]+"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def part(col: Column | str, sep: str, index: int) -> Column:
    """Element ``index`` (0-based) of ``col`` split on the literal ``sep``.

    Null when the string has fewer parts; ``getItem`` would raise under ANSI.
    """
    return F.get(F.split(_c(col), _regex_literal(sep)), index)


def _regex_literal(sep: str) -> str:
    special = set(r"\^$.|?*+()[]{}")
    return "".join("\\" + ch if ch in special else ch for ch in sep)


def split_literal(col: Column | str, sep: str) -> Column:
    return F.split(_c(col), _regex_literal(sep))


def join_name(last: Column | str, first: Column | str, sep: str = ", ") -> Column:
    """``last + sep + first``; null when either side is null (``concat``)."""
    return F.concat(_c(last).cast("string"), F.lit(sep), _c(first).cast("string"))


def normalized(col: Column | str) -> Column:
    """Trimmed and lower-cased."""
    return F.lower(F.trim(_c(col)))


def tokens(col: Column | str) -> Column:
    """Array of whitespace-separated pieces of the whole text.

    Leading or trailing blanks give empty pieces; drop them after ``explode``
    (a plain filter stays in generated code, a lambda filter would not).
    """
    return F.split(_c(col), WHITESPACE)


# How text on one line writes a backslash and line breaks.
BREAKS = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))


def join_breaks(c: Column) -> Column:
    """The text on one line: a backslash and line breaks are written as two characters."""
    for plain, code in BREAKS:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def restore_breaks(c: Column) -> Column:
    """Inverse of ``join_breaks``."""
    for plain, code in reversed(BREAKS):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c
