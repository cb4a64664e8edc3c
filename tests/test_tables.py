import os

import pytest

from quarry.sources.tables import TABLES, table

DIRS = [d for d in ("/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1") if os.path.isdir(d)]


@pytest.mark.parametrize("data_dir", DIRS)
def test_declared_schemas_equal_the_files(spark, data_dir):
    for name in TABLES:
        declared = table(spark, data_dir, name).schema
        inferred = table(spark, data_dir, name, declared=False).schema
        assert [(f.name, f.dataType.simpleString()) for f in declared] == [
            (f.name, f.dataType.simpleString()) for f in inferred
        ], name


def test_unknown_table(spark):
    with pytest.raises(KeyError):
        table(spark, "/nowhere", "hotels")


def test_data_dir_may_be_a_path_object(spark):
    import pathlib

    import __spark_entry__ as entry

    df = entry.queries()["mean_close"](spark, pathlib.Path(DIRS[0]))
    assert df.count() == 1


def test_files_that_arrive_later_are_read(spark, scratch):
    nation = table(spark, DIRS[0], "nation")
    nation.write.parquet(f"{scratch}/nation.parquet")
    n = table(spark, scratch, "nation").count()
    nation.write.mode("append").parquet(f"{scratch}/nation.parquet")
    assert table(spark, scratch, "nation").count() == 2 * n


def test_no_job_runs_while_a_query_is_built(spark):
    """But for the questions about files, which write them first."""
    from quarry.plans.catalog import QUERIES

    tracker = spark.sparkContext.statusTracker()
    for name, query in QUERIES.items():
        if not name.startswith(("roundtrip_", "inferred_", "headed_", "stored_", "month_", "busiest_")):
            spark.sparkContext.setJobGroup(f"build-{name}", name)
            query(spark, DIRS[0])
            assert not tracker.getJobIdsForGroup(f"build-{name}"), name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not [t for t in spark.catalog.listTables() if t.isTemporary and t.name.startswith("mean_by_user_")]
