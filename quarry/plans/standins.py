"""The relations the questions are asked of, derived from the test tables.

The questions were written for hotel, shop, stock-price and movie-rating
files. On the test tables each input gets a stand-in of the same shape:

=========  ===================================================  ======================
relation   built from                                           key
=========  ===================================================  ======================
stays      orders x customer x nation                           id = o_orderkey
income     lineitem per order: sum of returned line prices      id = l_orderkey
prices     orders per day: open/high/low/close/volume           date
rates      lineitem per ship day: open/high/low factors         date
ratings    events: user, item from the JSON ``props``, value    (user_id, item_id)
users      customer, ``c_mktsegment`` as the group              user_id = c_custkey
items      part                                                 item_id = p_partkey
=========  ===================================================  ======================

Two joined forms serve the revenue questions: ``stays_with_income`` (one row
per stay, orders joined to their income first) and ``customer_income``
(income summed per customer before the customer join, for questions that
group by customer attributes).

Partial aggregation happens before every shuffle: ``income``, ``prices`` and
``rates`` are grouped aggregates whose map side emits one row per key and
task, so a day or an order holding a third of all rows is no hot partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.dates import day_of
from quarry.functions.money import exact_sum
from quarry.sources.tables import table

# The schema of the JSON ``props`` of events.
PROPS_SCHEMA = "k INT"
# The return flag marking a line whose price counts as revenue.
RETURNED = "R"


def people(spark: SparkSession, d: str) -> DataFrame:
    """(c_custkey, name, city): customers with their nation. Facts join this once, on the customer key,
    and never meet the few nation keys."""
    c = table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("name"), "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "name", "city")


def stays(spark: SparkSession, d: str) -> DataFrame:
    """(id, name, city, cc): one row per order with its customer and nation."""
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), "o_custkey", F.col("o_orderstatus").alias("cc")
    )
    return o.join(people(spark, d), F.col("o_custkey") == F.col("c_custkey")).select("id", "name", "city", "cc")


def income(spark: SparkSession, d: str, lineitem: DataFrame | None = None, drop_null: bool = False) -> DataFrame:
    """(id, revenue): one row per order that has lines; null revenue when none was returned.

    ``drop_null`` leaves the orders of null revenue out; the scan then reads only lines that count.
    """
    li = lineitem if lineitem is not None else table(spark, d, "lineitem")
    if drop_null:
        li = li.filter((F.col("l_returnflag") == RETURNED) & F.col("l_extendedprice").isNotNull())
    revenue = F.when(F.col("l_returnflag") == RETURNED, F.col("l_extendedprice"))
    return li.select(F.col("l_orderkey").alias("id"), revenue.alias("revenue")).groupBy("id").agg(exact_sum("revenue").alias("revenue"))


def stays_with_income(
    spark: SparkSession, d: str, orders: DataFrame | None = None, lineitem: DataFrame | None = None, drop_null: bool = False
) -> DataFrame:
    """(id, name, city, cc, revenue, has_income): every stay with its income, if any.

    The same rows as ``revenue.stays_with_income(stays(...), income(...))``,
    joined orders-first: orders meet their income on the order key (both
    sides keyed by order, so tables bucketed by order key join without a
    shuffle), then customers with their nation. ``has_income`` is null when the order
    has no lines.
    """
    o = orders if orders is not None else table(spark, d, "orders")
    o = o.select(F.col("o_orderkey").alias("id"), "o_custkey", F.col("o_orderstatus").alias("cc"))
    inc = income(spark, d, lineitem, drop_null).withColumn("has_income", F.lit(True))
    return (
        o.join(inc, "id", "left")
        .join(people(spark, d), F.col("o_custkey") == F.col("c_custkey"))
        .select("id", "name", "city", "cc", "revenue", "has_income")
    )


def customer_income(
    spark: SparkSession, d: str, orders: DataFrame | None = None, lineitem: DataFrame | None = None, drop_null: bool = False
) -> DataFrame:
    """(name, city, revenue, has_income): income summed per customer before the customer join.

    For questions that group stays by customer attributes (name, nation):
    orders with income are reduced to one exact partial sum per customer
    key (partial aggregate first, so a customer with a third of all orders
    is one row per task), and only those sums meet customer and nation. A
    per-customer sum is null only when all its revenues are null, so summing
    the partial sums per group equals summing the stays' revenues, nulls
    included; ``revenue.revenue_by`` applies unchanged.
    """
    o = orders if orders is not None else table(spark, d, "orders")
    o = o.select(F.col("o_orderkey").alias("id"), "o_custkey")
    per_customer = (
        o.join(income(spark, d, lineitem, drop_null), "id", "inner")
        .groupBy("o_custkey")
        .agg(exact_sum("revenue").alias("revenue"))
    )
    return (
        per_customer.join(people(spark, d), F.col("o_custkey") == F.col("c_custkey"))
        .select("name", "city", "revenue", F.lit(True).alias("has_income"))
    )


def prices(spark: SparkSession, d: str) -> DataFrame:
    """(date, open, high, low, close, volume) of order prices per order day.

    open/close are the prices of the first/last order key of the day
    (``min_by``/``max_by``, both partial aggregates); volume counts orders.
    """
    o = table(spark, d, "orders")
    p, k = F.col("o_totalprice"), F.col("o_orderkey")
    return o.groupBy(day_of("o_orderdate").alias("date")).agg(
        F.min_by(p, k).alias("open"),
        F.max(p).alias("high"),
        F.min(p).alias("low"),
        F.max_by(p, k).alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )


def rates(spark: SparkSession, d: str) -> DataFrame:
    """(date, open_rate, high_rate, low_rate): conversion factors per ship day."""
    li = table(spark, d, "lineitem")
    factor = F.lit(1.0) - F.col("l_discount")
    return li.groupBy(day_of("l_shipdate").alias("date")).agg(
        (F.lit(1.0) - F.max("l_tax")).alias("open_rate"),
        F.max(factor).alias("high_rate"),
        F.min(factor).alias("low_rate"),
    )


def ratings(spark: SparkSession, d: str) -> DataFrame:
    """(user_id, item_id, rating): the item is field ``k`` of the JSON ``props``."""
    ev = table(spark, d, "events")
    return ev.select(
        F.col("user_id"),
        F.from_json("props", PROPS_SCHEMA)["k"].alias("item_id"),
        F.col("value").alias("rating"),
    )


def users(spark: SparkSession, d: str) -> DataFrame:
    """(user_id, segment)."""
    return table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))


def items(spark: SparkSession, d: str) -> DataFrame:
    """(item_id, title)."""
    return table(spark, d, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))
