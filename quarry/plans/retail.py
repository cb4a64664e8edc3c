"""Shop questions: who spent most, what sold, what never sold, sales of top stock.

Sales facts ``sales(customer, product, items, amount)`` and products
``products(product, title, price, stock)`` are column mappings over any pair of
tables; the test-table mapping is in ``plans.catalog``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.money import exact_state, exact_sum, state_order, state_rounded, state_sum
from quarry.operators.relational import facts_of_top_n, never_matched, never_matched_outer, top_n


def top_spender(facts: DataFrame, who: str, amount: str, n: int = 1, digits: int | None = 2) -> DataFrame:
    """(who, total_spent) of the ``n`` biggest spenders, ties by ``who``.

    Sums are exact, so the biggest spender does not depend on the order of the rows.
    They are compared unrounded and shown rounded to ``digits`` places, or as they are with None.
    """
    totals = facts.groupBy(who).agg(exact_state(amount).alias("__total"))
    shown = state_sum("__total") if digits is None else state_rounded("__total", digits)
    ordered = totals.withColumn("__order", state_order("__total"))
    return top_n(ordered, n, [F.desc_nulls_last("__order")], [who]).select(who, shown.alias("total_spent"))


def sold_report(
    facts: DataFrame,
    fact_key: str,
    products: DataFrame,
    product_key: str,
    title: str,
    items: str,
    amount: str | None,
) -> DataFrame:
    """(product, title, items_sold[, amount_sold]) of products with at least one sale.

    Facts are aggregated per product first (partial + final), then joined; a
    product that sells a third of all lines is one row per task before the shuffle.
    """
    integral = dict(facts.dtypes).get(items) in ("tinyint", "smallint", "int", "bigint")
    # counts of items stay integers; fractional quantities get the exact money sum
    aggs = [(F.sum(items) if integral else exact_sum(items)).alias("items_sold")]
    if amount is not None:
        aggs.append(exact_state(amount).alias("__amount"))
    sold = facts.groupBy(F.col(fact_key).alias("__key")).agg(*aggs)
    if amount is not None:
        sold = sold.withColumn("amount_sold", state_rounded("__amount"))
    cols = [product_key, title, "items_sold"] + (["amount_sold"] if amount is not None else [])
    return products.join(sold, F.col(product_key) == F.col("__key"), "inner").select(*cols)


def never_sold(left: DataFrame, left_key: str, facts: DataFrame, fact_key: str, cols: Sequence[str]) -> DataFrame:
    """Rows of ``left`` that no fact refers to (anti join).

    The facts are reduced to their distinct keys first: the partial aggregate
    runs before the shuffle, so a key that holds a third of all facts leaves
    each task as one row (adaptive skew splitting only covers the left side
    of an anti join), and the shuffle carries keys, not fact rows.
    """
    keys = facts.select(F.col(fact_key).alias("__fk")).distinct()
    return never_matched(left, keys, F.col(left_key) == F.col("__fk")).select(*cols)


def never_sold_outer(
    left: DataFrame, left_key: str, facts: DataFrame, fact_key: str, cols: Sequence[str]
) -> DataFrame:
    """Same rows as ``never_sold`` by outer join and a null test."""
    return never_matched_outer(left, left_key, facts, fact_key).select(*cols)


def facts_of_top_stock(
    facts: DataFrame, fact_key: str, products: DataFrame, product_key: str, stock: str, n: int = 10
) -> DataFrame:
    """Every fact row of the ``n`` products with most stock (ties by key)."""
    return facts_of_top_n(facts, fact_key, products, product_key, n, [F.desc_nulls_last(stock)], [product_key])


def facts_in_top_stock_list(
    facts: DataFrame, fact_key: str, products: DataFrame, product_key: str, stock: str, n: int = 10
) -> DataFrame:
    """Same rows, as SQL membership: the key is IN the top ``n``; a left semi join, no job before the query itself."""
    top = top_n(products.select(product_key, stock), n, [F.desc_nulls_last(stock)], [product_key]).select(product_key)
    return facts.sparkSession.sql(f"SELECT * FROM {{facts}} WHERE `{fact_key}` IN (SELECT * FROM {{top}})", facts=facts, top=top)
