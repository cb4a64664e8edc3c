"""Plan tests: the physical plan has the shape the design relies on."""

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from quarry.functions.money import share_pct
from quarry.operators.relational import facts_of_top_n, rows_at_extreme, top_n
from quarry.plans import catalog


def plan(df) -> str:
    """The final adaptive plan (the text also repeats the initial plan; drop it)."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("\n+- == Initial Plan ==")[0]  # the outer marker, not a cached plan's


def test_share_is_one_aggregate_pass(spark):
    df = spark.range(1000).withColumn("h", F.col("id") * 1.0)
    p = plan(df.agg(share_pct(F.col("h") > 500).alias("p")))
    assert p.count("Exchange") == 1  # partial per task, one final row
    assert "ShuffleQueryStage" in p
    assert "Join" not in p


def test_extreme_rows_broadcast_the_one_row_aggregate(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    p = plan(rows_at_extreme(df, "v"))
    assert "BroadcastHashJoin" in p
    assert "Window" not in p


def test_top_n_is_take_ordered(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    p = top_n(df, 10, [F.desc("v")], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in p


def test_facts_of_top_n_semi_join_is_broadcast(spark):
    facts = spark.range(1000).withColumn("k", F.col("id") % 50)
    dim = spark.range(50).withColumnRenamed("id", "k2").withColumn("stock", F.col("k2") % 9)
    p = plan(facts_of_top_n(facts, "k", dim, "k2", 10, [F.desc("stock")], ["k2"]))
    assert "BroadcastHashJoin" in p and "LeftSemi" in p


def test_filters_and_columns_reach_the_scan(spark):
    df = catalog.q_revenue_by_country(spark, SMOKE_DIR)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_returnflag:string>" in p


def test_in_list_is_a_semi_join(spark):
    p = plan(catalog.q_lines_in_list(spark, SMOKE_DIR))
    assert "LeftSemi" in p and "TakeOrderedAndProject" in p


@pytest.mark.parametrize("name", ["revenue_by_country_normalized", "top200_name_revenue", "top100_present_revenue"])
def test_dropped_revenue_is_never_read(spark, name):
    p = catalog.QUERIES[name](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in p


@pytest.mark.parametrize("name", ["city_revenue", "top100_revenue", "no_revenue"])
def test_facts_never_meet_the_nation_keys(spark, name):
    """Customers get their nation before the facts join: of the two join keys only the customer's has facts on a side."""
    p = catalog.QUERIES[name](spark, SMOKE_DIR)._jdf.queryExecution().optimizedPlan().toString()
    lines = p.splitlines()
    at = next(i for i, line in enumerate(lines) if "Join" in line and "nationkey" in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    below = [line for line in lines[at + 1 :]]
    own = []
    for line in below:
        if len(line) - len(line.lstrip(" :+-")) <= depth:
            break
        own.append(line)
    assert any("c_nationkey" in line for line in own) and not any("orderkey" in line for line in own)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_in_any_registered_plan(spark, name):
    df = catalog.QUERIES[name](spark, SMOKE_DIR)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in p and "PythonUDF" not in p and "FlatMapGroupsInPandas" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_ratings_aggregate_before_join(spark):
    p = plan(catalog.q_mean_by_user(spark, SMOKE_DIR))
    # the partial aggregate of ratings sits below the join
    agg_pos = p.find("HashAggregate")
    join_pos = p.find("Join")
    assert 0 <= join_pos < agg_pos


def test_daily_prices_are_aggregated_once_for_their_extreme(spark):
    df = catalog.q_day_of_max_high(spark, SMOKE_DIR)
    p = plan(df)
    # both branches (the one-row extreme and the rows joined to it) read one exchange of the daily aggregate
    assert "BroadcastHashJoin" in p and "InMemoryTableScan" not in p
    assert p.count("ReusedExchange") >= 1 and p.count("FileScan") == 1


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if "day_of_" in n])
def test_extremes_scan_each_fact_table_once_and_keep_nothing(spark, name):
    p = plan(catalog.QUERIES[name](spark, SMOKE_DIR))
    assert p.count("FileScan") == (2 if name.startswith("eur_") else 1) and "ReusedExchange" in p
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_marker_filter_turns_the_income_join_inner(spark):
    inner = catalog.q_revenue_by_country(spark, SMOKE_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in inner
    outer = catalog.q_no_revenue(spark, SMOKE_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" in outer


def test_anti_join_side_is_deduplicated_before_its_shuffle(spark):
    import re

    p = plan(catalog.q_never_sold(spark, SMOKE_DIR))
    # the lineitem keys pass a partial aggregate inside the map stage, before any exchange
    assert re.search(r"Exchange hashpartitioning\(__fk.*\n\s*\+- \*\(\d+\) HashAggregate\(keys=\[__fk", p), p
