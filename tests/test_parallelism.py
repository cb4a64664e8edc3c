from quarry.operators.parallelism import spread


def test_spread_deals_rows_over_the_tasks(spark):
    assert spread(spark.range(100).coalesce(1), 5).rdd.getNumPartitions() == 5
