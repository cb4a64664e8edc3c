"""Relational building blocks: top-n, rows at an extreme, unmatched rows, shares.

Every function takes and returns DataFrames and adds only built-in operators.
Broadcast hints are given only where the broadcast side has a size bound that
holds by construction (a global aggregate is one row, a top-n is n rows); every
other join is left to Spark, which broadcasts by measured size
(``spark.sql.autoBroadcastJoinThreshold``, re-checked at run time by adaptive
execution) and otherwise shuffles.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.money import share_pct


def _cols(cols: Iterable[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_n(df: DataFrame, n: int, order: Sequence[Column | str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows by ``order``, ties broken by ``tiebreak`` ascending.

    Planned as ``TakeOrderedAndProject``: each task keeps its own n best rows
    and only those reach the final merge, so no full sort and no shuffle of the
    input.
    """
    return df.orderBy(*_cols(order), *_cols(tiebreak)).limit(n)


def rows_at_extreme(df: DataFrame, col: str, how: str = "max") -> DataFrame:
    """All rows whose ``col`` equals the global max (or min); ties kept.

    The extreme is a one-row global aggregate (partial per task, one final
    row), broadcast to the scan of ``df``; no window over the whole table, so
    nothing funnels into a single task. ``df`` is used twice; where it is an
    aggregate and holds only its keys and ``col``, both uses read one exchange.
    """
    agg = {"max": F.max, "min": F.min}[how]
    ext = df.agg(agg(col).alias("__extreme"))
    return df.join(F.broadcast(ext), F.col(col) == F.col("__extreme"), "inner").drop("__extreme")


def without_value(left: DataFrame, right: DataFrame, on: str | list[str], value_col: str) -> DataFrame:
    """Left rows whose right-side ``value_col`` is null: no match **or** a match holding null.

    This is a left outer join plus a null test, not an anti join: a key that
    matches a row with a null value is kept too.
    """
    return left.join(right, on=on, how="left").filter(F.col(value_col).isNull())


def never_matched(left: DataFrame, right: DataFrame, cond: Column | str | list[str]) -> DataFrame:
    """Left rows with no partner on the right (left anti join)."""
    return left.join(right, on=cond, how="left_anti")


def never_matched_outer(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Same rows as ``never_matched`` written as outer join + null test.

    The right side is reduced to its distinct keys first (partial aggregation
    before the shuffle), so the outer join never multiplies left rows by the
    number of their partners.
    """
    keys = right.select(F.col(right_key).alias("__k")).distinct().withColumn("__hit", F.lit(True))
    return (
        left.join(keys, F.col(left_key) == F.col("__k"), "left")
        .filter(F.col("__hit").isNull())
        .drop("__k", "__hit")
    )


def facts_of_top_n(
    facts: DataFrame,
    fact_key: str,
    dim: DataFrame,
    dim_key: str,
    n: int,
    order: Sequence[Column | str],
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Fact rows whose key is among the top ``n`` dimension rows.

    A left semi join, so fact rows are never duplicated. The top-n side holds at
    most ``n`` keys; Spark broadcasts it by its measured size.
    """
    top = top_n(dim, n, order, tiebreak or [dim_key]).select(F.col(dim_key).alias("__top_key"))
    return facts.join(top, F.col(fact_key) == F.col("__top_key"), "left_semi")


def in_list(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose ``col`` is one of a short literal list; pushed to the scan as ``In``."""
    return df.filter(F.col(col).isin(list(values)))


def share_where(df: DataFrame, cond: Column, name: str, digits: int = 2) -> DataFrame:
    """One-row table: percentage of all rows meeting ``cond`` (one aggregate)."""
    return df.agg(share_pct(cond, digits).alias(name))


def count_rows(df: DataFrame, name: str = "rows") -> DataFrame:
    """Row count as a one-row table, inside the plan (no driver round trip)."""
    return df.agg(F.count(F.lit(1)).alias(name))
