"""Facts in one folder per month: questions about some months list and read only those folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.money import exact_state, state_rounded, state_sum
from quarry.operators.relational import top_n
from quarry.plans.roundtrip import scratch
from quarry.sinks import write_parquet


def by_month(spark: SparkSession, facts: DataFrame, date: str, month: str, columns: list[str], path: str | None = None) -> DataFrame:
    """``columns`` of the facts written in a folder per calendar month of ``date``, named ``month`` (``1995-03``), and read from there."""
    rows = facts.select(*columns, F.date_format(date, "yyyy-MM").alias(month))
    return write_parquet(rows, path or scratch(spark, "months"), partition_by=(month,))


def month_sales(facts: DataFrame, month: str, quantity: str, price: str, low: str, high: str) -> DataFrame:
    """(month, lines, quantity, sales) of the months from ``low`` to ``high``; other folders are not listed."""
    some = facts.filter(F.col(month).between(low, high))
    return _sums(some, month, quantity, price)


def busiest_month_sales(facts: DataFrame, month: str, quantity: str, price: str, orders: DataFrame, ordered: str, n: int) -> DataFrame:
    """The same of the ``n`` months with most orders (ties: the earlier).

    Which months that are is known only when the orders are counted: the join hands them to the scan of the facts, which
    reads their folders alone (dynamic partition pruning).
    """
    counts = orders.groupBy(F.date_format(ordered, "yyyy-MM").alias("__month")).agg(F.count(F.lit(1)).alias("orders"))
    # at most n rows; the planner hands keys to a scan only from a side that a comparison filters
    busiest = top_n(counts.filter(F.col("__month").isNotNull()), n, [F.desc("orders")], ["__month"]).filter(F.col("orders") > 0)
    return _sums(facts.join(F.broadcast(busiest), F.col(month) == F.col("__month"), "left_semi"), month, quantity, price)


def _sums(facts: DataFrame, month: str, quantity: str, price: str) -> DataFrame:
    sums = facts.groupBy(month).agg(F.count(F.lit(1)).alias("lines"), exact_state(quantity).alias("__q"), exact_state(price).alias("__p"))
    return sums.select(month, "lines", state_sum("__q").alias("quantity"), state_rounded("__p").alias("sales"))
