"""Date parsing and calendar keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two date layouts the inputs use.
ISO_DAY = "yyyy-MM-dd"
MONTH_NAME_DAY = "MMM dd, yyyy"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_date(col: Column | str, fmt: str = ISO_DAY, strict: bool = False) -> Column:
    """String to date. ``strict`` raises on a bad value (ANSI), otherwise null."""
    c = _c(col)
    return F.to_date(c, fmt) if strict else F.try_to_date(c, fmt)


def format_date(col: Column | str, fmt: str) -> Column:
    return F.date_format(_c(col), fmt)


def day_of(col: Column | str) -> Column:
    """Calendar day of a date, timestamp or timestamp_ntz column."""
    return F.to_date(_c(col))


def year_of(col: Column | str) -> Column:
    return F.year(_c(col))


def month_of(col: Column | str) -> Column:
    return F.month(_c(col))
