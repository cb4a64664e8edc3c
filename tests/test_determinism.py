"""Results do not depend on how the rows are partitioned (exact arithmetic)."""

import pytest

import __spark_entry__ as entry
from conftest import SMOKE_DIR
from quarry.plans.catalog import QUERIES


def _collect(spark, name):
    df = entry.queries()[name](spark, SMOKE_DIR)
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result_under_different_partitionings(spark, name):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        results = []
        for parts in ("1", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            results.append(_collect(spark, name))
        assert results[0] == results[1]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
