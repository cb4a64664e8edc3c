"""Files as jobs leave and find them: split text, tuple lines, inferred types, header lines, stored schemas, folders per value."""

import glob
import os
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from quarry.plans import catalog, partitioned
from quarry.sinks import write_csv, write_parquet, write_tuple_text
from quarry.sources.delimited import read_delimited, read_headed_lines
from quarry.sources.inferred import infer_types, read_inferred, widest
from quarry.sources.schemas import SchemaDrift, drift, read_with_schema, schema_path, stored_schema, write_with_schema
from quarry.sources.tables import table
from quarry.sources.tuples import parse_tuples, read_tuple_text

AWKWARD = [None, "", " ", "a\nb", "a\r\nb", "\r", "\\", "\\n", "\\\\n", "'", '"', "'\"", "it's", "(1, 2)", "None", ", ", "tab\t.", "été", "a\\'b", "x\\"]


# ---- text with line breaks, split between tasks ------------------------------

def test_one_large_file_is_read_by_several_tasks(spark, scratch):
    n = 40_000
    df = spark.range(n).select("id", F.concat(F.lit("line\none "), F.repeat(F.lit("x\r\n\\"), 400), F.col("id")).alias("v"))
    write_csv(df, scratch + "/t", files=1, sep="#", header=False, null="\\N", escaped=True)
    (file,) = glob.glob(scratch + "/t/part-*")
    assert os.path.getsize(file) > 64 << 20
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(8 << 20))
    try:
        back = read_delimited(spark, scratch + "/t", sep="#", schema=df.schema, null="\\N", escaped=True)
        tasks = back.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(tasks) >= 8 and sum(r["count"] for r in tasks) == n
        assert back.exceptAll(df).isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_no_round_trip_reads_a_file_whole(spark):
    for name in [n for n in catalog.QUERIES if n.startswith("roundtrip_")]:
        plan = catalog.QUERIES[name](spark, SMOKE_DIR)._jdf.queryExecution().toString()
        assert "multiline" not in plan.lower()


# ---- tuple lines ----------------------------------------------------------------

def test_tuple_lines_come_back(spark, scratch):
    rows = [(i, v, None if i % 3 else i / 4) for i, v in enumerate(AWKWARD)]
    df = spark.createDataFrame(rows, "id long, v string, x double")
    write_tuple_text(df, scratch + "/t")
    assert sorted(tuple(r) for r in read_tuple_text(spark, scratch + "/t", df.schema).collect()) == rows
    with open(glob.glob(scratch + "/t/part-*")[0], encoding="utf-8") as fh:
        for line in fh:
            assert isinstance(eval(line), tuple)  # what was written is Python's own tuple text


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab\\'\",() \n\r\tNone", max_size=8)), min_size=1, max_size=15))
def test_any_string_comes_back_from_python_tuples(spark, values):
    lines = spark.createDataFrame([(repr((i, v)),) for i, v in enumerate(values)], "value string")
    got = sorted(tuple(r) for r in parse_tuples(lines, "value", "id long, v string").collect())
    assert got == list(enumerate(values))


def test_tuple_lines_of_other_types_and_lengths(spark):
    line = spark.createDataFrame([("('7', 10.5, None, True, '2020-01-02 03:04:05', 'only')",)], "value string")
    row = parse_tuples(line, "value", "a int, b double, c string, d boolean, e timestamp_ntz, f string").first()
    assert tuple(row)[:4] == (7, 10.5, None, True) and str(row["e"]) == "2020-01-02 03:04:05" and row["f"] == "only"
    long = "x'\\" * 500_000
    got = parse_tuples(spark.createDataFrame([(repr((long,)),)], "value string"), "value", "v string").first()
    assert got["v"] == long
    for bad in ("('1', '2')", "()", None):
        with pytest.raises(Exception, match="must have 1 fields"):
            parse_tuples(spark.createDataFrame([(bad,)], "value string"), "value", "v string").collect()


# ---- inferred types -----------------------------------------------------------------

def _csv(spark, path, header, lines):
    spark.createDataFrame([(x,) for x in [header, *lines]], "value string").coalesce(1).write.text(path)
    return path


def test_inferred_types_equal_the_declared_ones(spark):
    got = catalog.q_inferred_comma_separated(spark, SMOKE_DIR)
    assert got.dtypes == table(spark, SMOKE_DIR, "orders").dtypes


def test_types_widen_where_the_rest_does_not_fit(spark, scratch):
    lines = [f"{i},{i},{i},2020-01-01,true,," for i in range(2000)]
    lines += ["7,2.5,x,2020-01-01 10:00:00,false,,", ",,,,,,", "99999999999999999999,1e3,,,maybe,,"]
    path = _csv(spark, scratch + "/c", "a,b,c,d,e,f,g", lines)
    df = read_inferred(spark, path, sample=0.01)
    assert dict(df.dtypes) == {"a": "double", "b": "double", "c": "string", "d": "timestamp_ntz", "e": "string", "f": "string", "g": "string"}
    assert df.count() == 2003 and df.where("b = 2.5 AND c = 'x'").count() == 1 and df.where("a IS NULL").count() == 1


def test_kinds_of_single_values(spark):
    values = {"12": "bigint", "+1": "bigint", "007": "bigint", "9223372036854775808": "double", "1.": "double", ".5": "double", "1e5": "double", "NaN": "double", "1d": "string",
              "2020-01-31": "date", "2020-02-30": "string", "2020-01-31T10:11:12.5": "timestamp_ntz", "2020": "bigint", "TRUE": "boolean", "no": "string", "0x1F": "string", " 3 ": "bigint"}
    for text, want in values.items():
        assert infer_types(spark.createDataFrame([(text,), (None,), ("  ",)], "v string"), sample=1.0) == {"v": want}, text
    assert infer_types(spark.createDataFrame([], "v string")) == {"v": "string"}
    assert widest({"bigint", "double"}) == "double" and widest({"date", "bigint"}) == "string" and widest([]) == "string"
    with pytest.raises(ValueError):
        infer_types(spark.createDataFrame([], "v string"), sample=0)


# ---- header lines over many files -----------------------------------------------------

def test_every_file_loses_its_header_line(spark, scratch):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i / 2, None if i % 7 == 0 else f"n{i}") for i in range(200)], "id long, revenue double, name string")
    write_csv(df, scratch + "/t", files=6, sep=";")
    assert len(glob.glob(scratch + "/t/part-*")) == 6
    back = read_headed_lines(spark, scratch + "/t", "id;", ";", df.schema)
    assert back.exceptAll(df).isEmpty() and back.count() == 200
    assert "StringStartsWith(value,id;)" in back._jdf.queryExecution().executedPlan().toString().replace("(id;)", "id;")


def test_a_bad_number_raises_but_a_blank_is_null(spark, scratch):
    path = _csv(spark, scratch + "/h", "id;revenue", ["1;", "2;  ", "3;4.5"])
    got = read_headed_lines(spark, path, "id;revenue", ";", "id long, revenue double")
    assert sorted(tuple(r) for r in got.collect()) == [(1, None), (2, None), (3, 4.5)]
    with pytest.raises(Exception):
        read_headed_lines(spark, _csv(spark, scratch + "/b", "id;revenue", ["x;1"]), "id;", ";", "id long, revenue double").collect()


# ---- schema beside the data ------------------------------------------------------------

def test_stored_schema_is_checked_on_read(spark, scratch):
    path = scratch + "/t"
    df = spark.createDataFrame([(1, "a", 2.5)], "id long, name string, x double")
    write_with_schema(df, path)
    assert stored_schema(spark, path) == df.schema and schema_path(path + "/") == path + ".schema"
    assert read_with_schema(spark, path).collect() == df.collect()
    changed = df.select(F.col("id").cast("string").alias("id"), "name", "x")
    changed.write.mode("overwrite").parquet(path)
    with pytest.raises(SchemaDrift, match="id was bigint, is string"):
        read_with_schema(spark, path)
    df.drop("name").withColumn("more", F.lit(1)).write.mode("overwrite").parquet(path)
    with pytest.raises(SchemaDrift, match="name string is gone; more int is new"):
        read_with_schema(spark, path)


def test_one_file_of_another_type_among_many_is_found(spark, scratch):
    path = scratch + "/t"
    df = spark.range(10).select("id", F.lit("a").alias("name"))
    write_with_schema(df, path)
    df.withColumn("late", F.lit(True)).write.mode("append").parquet(path)
    with pytest.raises(SchemaDrift, match="late boolean is new"):
        read_with_schema(spark, path)
    df.select(F.col("id").cast("string").alias("id"), "name").write.mode("append").parquet(path)
    with pytest.raises(SchemaDrift):
        read_with_schema(spark, path)
    assert drift(df.schema, df.schema) == []


# ---- folders per value ----------------------------------------------------------------

def _files_read(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan


def test_months_are_pruned_by_a_filter(spark, scratch):
    facts = partitioned.by_month(spark, table(spark, SMOKE_DIR, "lineitem"), "l_shipdate", "ship_month", ["l_quantity", "l_extendedprice"], scratch + "/m")
    some = partitioned.month_sales(facts, "ship_month", "l_quantity", "l_extendedprice", "1995-01", "1995-03")
    assert some.count() == 3
    plan = _files_read(some)
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan, re.S).group(1)
    assert "1995-01" in filters and "1995-03" in filters
    read = facts.where("ship_month BETWEEN '1995-01' AND '1995-03'").select(F.input_file_name().alias("f")).distinct().collect()
    assert {re.search(r"ship_month=([0-9-]+)", r["f"]).group(1) for r in read} == {"1995-01", "1995-02", "1995-03"}


def test_months_are_pruned_by_a_join(spark, scratch):
    orders = table(spark, SMOKE_DIR, "orders")
    facts = partitioned.by_month(spark, table(spark, SMOKE_DIR, "lineitem"), "l_shipdate", "ship_month", ["l_quantity", "l_extendedprice"], scratch + "/m")
    best = partitioned.busiest_month_sales(facts, "ship_month", "l_quantity", "l_extendedprice", orders, "o_orderdate", 3)
    plan = _files_read(best)
    assert "dynamicpruningexpression(ship_month" in plan


def test_a_hot_value_is_several_files_and_small_ones_are_not(spark, scratch):
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 4)).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        back = write_parquet(df.repartition(12), scratch + "/p", partition_by=("k",))
        write_csv(df.repartition(12), scratch + "/c", rebalance=("k",))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {d: len(glob.glob(f"{scratch}/p/k={d}/part-*")) for d in ("hot", "v0", "v1")}
    assert files["hot"] >= 3 and back.count() == 200_000
    assert sum(len(glob.glob(f"{d}/part-*")) for d in glob.glob(scratch + "/p/k=*")) < 12 * 5
    sizes = [os.path.getsize(f) for f in glob.glob(scratch + "/c/part-*")]
    assert len(sizes) >= 4 and max(sizes) < sum(sizes) / 3


def test_files_are_bounded_by_records(spark, scratch):
    write_csv(spark.range(1000).coalesce(1), scratch + "/r", records=300)
    assert len(glob.glob(scratch + "/r/part-*")) == 4
    with pytest.raises(ValueError):
        write_csv(spark.range(3), scratch + "/x", files=2, rebalance=("id",))


# ---- views ------------------------------------------------------------------------------

def test_views_live_as_long_as_their_block(spark):
    from quarry.plans import views

    a, b = spark.range(5), spark.range(3).withColumn("v", F.col("id") * 2)
    spark.range(1).createOrReplaceTempView("taken_before")
    both = views.answer(spark, {"first_view": a, "second_view": b}, "SELECT f.id, s.v FROM first_view f JOIN second_view s USING (id) WHERE s.v < :most", most=4)
    names = {t.name for t in spark.catalog.listTables()}
    assert not names & {"first_view", "second_view"}
    assert sorted(tuple(r) for r in both.collect()) == [(0, 0), (1, 2)]
    with pytest.raises(Exception):
        views.answer(spark, {"first_view": a, "taken_before": b}, "SELECT 1")
    names = {t.name for t in spark.catalog.listTables()}
    assert "first_view" not in names and "taken_before" in names
    spark.catalog.dropTempView("taken_before")
    with pytest.raises(Exception):
        with views.session_views(spark, {"first_view": a}):
            spark.sql("SELECT nothing FROM first_view")
    assert "first_view" not in {t.name for t in spark.catalog.listTables()}


def test_the_registered_question_leaves_no_view(spark):
    before = {t.name for t in spark.catalog.listTables()}
    assert catalog.q_spending_of_users_below(spark, SMOKE_DIR).count() >= 0
    assert {t.name for t in spark.catalog.listTables()} == before


# ---- rounding as Python does ---------------------------------------------------------------

@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.floats(allow_nan=False, allow_infinity=False), st.floats(-1e4, 1e4), st.integers(-10**6, 10**6).map(lambda i: i / 8)), min_size=1, max_size=40), st.integers(0, 10))
def test_round_half_even_is_python_round(spark, values, digits):
    from quarry.functions.rounding import round_half_even

    got = spark.createDataFrame([(v,) for v in values], "v double").select(round_half_even("v", digits)).collect()
    assert [r[0] for r in got] == [float(round(v, digits)) for v in values]


def test_round_half_even_of_known_values(spark):
    from quarry.functions.rounding import round_half_even

    values = [2.675, 0.125, 0.375, 1.005, -2.675, 2.5, 1e-300, float("inf"), None, 9.995, 99.995, -0.125]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(round_half_even("v")).collect()]
    assert got == [2.67, 0.12, 0.38, 1.0, -2.67, 2.5, 0.0, float("inf"), None, 9.99, 100.0, -0.12]
    nan = spark.sql("SELECT double('nan') AS v").select(round_half_even("v")).first()[0]
    assert nan != nan
    with pytest.raises(ValueError):
        round_half_even("v", 11)
