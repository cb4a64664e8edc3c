"""Daily price questions and currency conversion by date.

A price table is ``(date, open, high, low, close, volume)``; a rate table is
``(date, open_rate, high_rate, low_rate)``. Every question is one function
parameterised by column names, so the converted table answers the same
questions as the original.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.dates import month_of, year_of
from quarry.functions.money import exact_mean, round_half_up
from quarry.functions.rounding import round_half_even
from quarry.operators.relational import count_rows, rows_at_extreme, share_where


def day_of_extreme(p: DataFrame, col: str, how: str, out: str, rounded: bool = True) -> DataFrame:
    """(date, out): every day at the max/min of ``col``; compared unrounded, shown rounded.

    Date and value are projected first, so a price table that summarises facts
    is aggregated for this one column, once: both uses read the same exchange.
    """
    val = round_half_up(col) if rounded else F.col(col)
    return rows_at_extreme(p.select("date", col), col, how).select("date", val.alias(out))


def mean_of(p: DataFrame, col: str, out: str) -> DataFrame:
    """One-row table: exact mean of ``col`` rounded to cents."""
    return p.agg(exact_mean(col).alias(out))


def days_above(p: DataFrame, col: str, threshold: float) -> DataFrame:
    """The rows (not a count) with ``col > threshold``."""
    return p.filter(F.col(col) > F.lit(threshold))


def days_above_count(p: DataFrame, col: str, threshold: float) -> DataFrame:
    return count_rows(days_above(p, col, threshold), "days")


def pct_above(p: DataFrame, col: str, threshold: float, out: str) -> DataFrame:
    """Share of **all** days (null ``col`` included) with ``col > threshold``."""
    return share_where(p, F.col(col) > F.lit(threshold), out)


def pct_above_half_even(p: DataFrame, col: str, threshold: float, out: str) -> DataFrame:
    """The same share as a quotient of doubles times 100, rounded as Python rounds it: by its binary value, ties to even."""
    share = F.count_if(F.col(col) > F.lit(threshold)).cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0)).cast("double") * F.lit(100.0)
    return p.agg(share.alias("share")).select(round_half_even("share").alias(out))


def extreme_by_year(p: DataFrame, col: str, how: str, out: str) -> DataFrame:
    """(year, out): rounded max/min of ``col`` per calendar year."""
    agg = {"max": F.max, "min": F.min}[how]
    return p.groupBy(year_of("date").alias("year")).agg(round_half_up(agg(col)).alias(out))


def mean_by_month(p: DataFrame, col: str, out: str) -> DataFrame:
    """(year, month, out): exact rounded mean per calendar month, in calendar order."""
    return (
        p.groupBy(year_of("date").alias("year"), month_of("date").alias("month"))
        .agg(exact_mean(col).alias(out))
        .orderBy("year", "month")
    )


def convert(p: DataFrame, r: DataFrame) -> DataFrame:
    """Prices times the same day's rate of the same kind; close uses the open rate.

    Inner join on the date: days without a rate drop out. Both sides are
    aggregates keyed by date, so the join needs no further shuffle of either.
    Volume is not converted.
    """
    return p.join(r, "date", "inner").withColumns(
        {
            "open_eur": F.col("open") * F.col("open_rate"),
            "high_eur": F.col("high") * F.col("high_rate"),
            "low_eur": F.col("low") * F.col("low_rate"),
            "close_eur": F.col("close") * F.col("open_rate"),
        }
    )
