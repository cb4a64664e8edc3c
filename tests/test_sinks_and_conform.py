import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarry.operators.conform import composite_id, conform, unite
from quarry.operators.replicate import midpoint, replicate
from quarry.sinks import layout, write_csv, write_tuple_text
from quarry.sources import read_delimited


def _parts(path):
    return sorted(glob.glob(os.path.join(path, "part-*")))


def test_write_csv_coalesced_with_header(spark, scratch):
    df = spark.range(100).withColumn("v", F.col("id") * 2).repartition(5)
    out = os.path.join(scratch, "out")
    write_csv(df, out, files=2)
    assert len(_parts(out)) <= 2
    back = read_delimited(spark, out, header=True, schema="id LONG, v LONG")
    assert back.count() == 100
    # overwrite replaces
    write_csv(df.limit(3), out, files=1)
    assert read_delimited(spark, out, header=True, schema="id LONG, v LONG").count() == 3


def test_layout_by_column_keeps_keys_together(spark):
    df = spark.createDataFrame([(k % 3, i) for i, k in enumerate(range(60))], "k int, i int")
    laid = layout(df, files=4, by=["k"])
    assert laid.rdd.getNumPartitions() == 4
    per_part = laid.rdd.mapPartitions(lambda it: [sorted({r[0] for r in it})]).collect()
    seen = [k for keys in per_part for k in keys]
    assert sorted(seen) == [0, 1, 2]  # each key in exactly one partition


def test_tuple_text_fails_when_path_exists(spark, scratch):
    out = os.path.join(scratch, "t")
    df = spark.createDataFrame([("7", 10.5)], "client string, total double")
    write_tuple_text(df, out, files=1)
    text = open(_parts(out)[0]).read().strip()
    assert text == "('7', 10.5)"  # as Python writes the tuple
    other = os.path.join(scratch, "t2")
    samples = ["O'Neil", 'say "hi"', "both ' and \"", "back\\slash"]
    write_tuple_text(spark.createDataFrame([(x, None) for x in samples], "n string, v double").coalesce(1), other)
    lines = sorted(open(_parts(other)[0]).read().splitlines())
    assert lines == sorted(repr((x, None)) for x in samples)
    with pytest.raises(Exception):
        write_tuple_text(df, out)


def test_conform_renames_constants_typed_nulls(spark):
    df = spark.createDataFrame([(1, "North Cafe", "NC")], "HSISID int, NAME string, STATE string")
    out = conform(df, {"datasetId": "HSISID", "name": "NAME", "state": "STATE", "county": F.lit("North"), "dateEnd": None})
    assert out.columns == ["datasetId", "name", "state", "county", "dateEnd"]
    assert dict(out.dtypes)["dateEnd"] == "string"
    withid = out.withColumn("id", composite_id(["state", "county", "datasetId"]))
    assert withid.select("id").first()[0] == "NC_North_1"


def test_composite_id_null_in_null_out(spark):
    df = spark.createDataFrame([("NC", None)], "state string, ds string")
    assert df.select(composite_id(["state", "ds"])).first()[0] is None


def test_unite_by_name_with_string_ids(spark):
    a = spark.createDataFrame([(1, "x")], "id int, name string").select(F.col("id").cast("string").alias("id"), "name")
    b = spark.createDataFrame([("n", "x1")], "name string, id string")
    assert rows(unite([a, b])) == [("1", "x"), ("x1", "n")]
    c = spark.createDataFrame([("z",)], "name string")
    assert unite([a, c], allow_missing=True).count() == 2


def test_replicate_and_midpoint_modes(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, None)], "lcl double, ucl double")
    big = replicate(df, 61)
    assert big.count() == 122
    assert big.columns == ["lcl", "ucl"]
    col = midpoint(big, mode="col")
    assert col.columns == ["lcl", "ucl", "avg", "lcl2", "ucl2"]
    assert rows(col.filter("lcl = 1.0").limit(1), "avg") == [(2.0,)]
    assert midpoint(big, mode="noop").columns == ["lcl", "ucl"]
    assert midpoint(big, mode="full").columns == ["lcl", "ucl"]
    with pytest.raises(ValueError):
        midpoint(big, mode="other")


def test_replicate_is_one_stage_without_join(spark):
    plan = replicate(spark.range(10), 61)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan
    assert "Join" not in plan and "Exchange" not in plan and "Union" not in plan


def test_partitioned_writes_make_one_folder_per_value(spark, scratch):
    from quarry.sinks import write_parquet

    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, k string")
    out = os.path.join(scratch, "pq")
    write_parquet(df, out, partition_by=["k"])
    assert sorted(d for d in os.listdir(out) if d.startswith("k=")) == ["k=a", "k=b"]
    assert spark.read.parquet(out).filter("k = 'a'").count() == 2
    out2 = os.path.join(scratch, "csv")
    write_csv(df, out2, partition_by=["k"])
    assert sorted(d for d in os.listdir(out2) if d.startswith("k=")) == ["k=a", "k=b"]


def test_checkpoint_dir_is_required_on_a_cluster():
    from unittest import mock

    from quarry.session import ensure_checkpoint_dir

    sc = mock.Mock()
    sc.getCheckpointDir.return_value = None
    sc.master = "spark://cluster:7077"
    sc.getConf.return_value.get.return_value = None
    spark = mock.Mock(sparkContext=sc)
    spark.conf.get.return_value = None
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(spark)


def test_file_bound_shuffles_only_the_result(spark):
    df = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    wide = layout(df, files=1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange SinglePartition, REPARTITION_BY_NUM" in wide and "Coalesce" not in wide
    narrow = layout(df, files=1, narrow=True)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce 1" in narrow
