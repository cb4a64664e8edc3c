"""A key that holds a third of all rows must not funnel raw rows into one task."""

from pyspark.sql import functions as F

from quarry.functions import limbs
from quarry.functions.money import exact_state, exact_sum
from quarry.plans import revenue
from quarry.session import cluster_conf


def _final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_customer_join_is_split_by_adaptive_execution(spark):
    n = 60_000
    # one customer places a third of all orders
    orders = spark.range(n).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("o_custkey"),
        F.lit("F").alias("o_orderstatus"),
    )
    customers = spark.range(5000).select(F.col("id").alias("c_custkey"), F.concat(F.lit("c"), F.col("id")).alias("c_name"))
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        plan = _final_plan(joined)
        assert "SortMergeJoin(skew=true)" in plan
        assert "AQEShuffleRead skewed" in plan
        assert joined.count() == n
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_group_is_combined_before_the_shuffle(spark):
    # a third of the rows share one key; the partial aggregate leaves one row per task
    df = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.lit(1.25).alias("v")
    ).repartition(6)
    agg = df.groupBy("k").agg(exact_sum("v").alias("s"))
    plan = _final_plan(agg)
    assert "partial_try_sum" in plan and "partial_count" in plan
    assert dict(agg.filter("k = 0").collect())[0] == 30_000 * 1.25


def test_every_part_of_an_exact_sum_is_combined_before_the_shuffle(spark):
    df = spark.range(90_000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id / 7D AS v").repartition(6)
    plan = df.groupBy("k").agg(exact_state("v").alias("s"))._jdf.queryExecution().sparkPlan()
    partial = [n for n in str(plan.toString()).split("HashAggregate(") if "functions=[partial_" in n]
    assert len(partial) == 1 and partial[0].count("partial_sum(") == len(limbs.FIELDS)


def test_group_revenue_with_a_hot_city(spark):
    stays = spark.range(3000).select(
        F.col("id"), F.concat(F.lit("n"), F.col("id") % 7).alias("name"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.lit("COLD")).alias("city"), F.lit("F").alias("cc"),
    )
    income = spark.range(3000).select(F.col("id"), F.lit(0.01).alias("revenue"))
    got = dict(revenue.revenue_by(revenue.stays_with_income(stays, income), ("city",), n=None).collect())
    assert got == {"HOT": 10.0, "COLD": 20.0}


def test_cluster_conf_sizes_partitions():
    conf = cluster_conf(100 * 1024**4, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 524288  # 100 TiB / 200 MiB
    assert int(cluster_conf(1024, 8)["spark.sql.shuffle.partitions"]) == 24
