from pyspark.sql import functions as F

from conftest import rows
from quarry.operators.relational import (
    count_rows,
    facts_of_top_n,
    in_list,
    never_matched,
    never_matched_outer,
    rows_at_extreme,
    share_where,
    top_n,
    without_value,
)


def _products(spark):
    # stock: 8 products at 10 and 11 at 9 -> the 10th place is a tie
    data = [(i, f"p{i}", 1.5, 20 + i) for i in range(1, 3)]
    data += [(i, f"p{i}", 2.5, 10) for i in range(3, 11)]
    data += [(i, f"p{i}", 3.5, 9) for i in range(11, 22)]
    data += [(i, f"p{i}", 4.5, 1) for i in range(22, 30)]
    return spark.createDataFrame(data, "idProducto int, descripcion string, precio float, stock int")


def test_top_n_breaks_ties_by_key(spark):
    top = top_n(_products(spark), 10, [F.desc("stock")], ["idProducto"])
    assert [r[0] for r in top.collect()] == [2, 1, 3, 4, 5, 6, 7, 8, 9, 10]
    # repeatable whatever the partitioning
    again = top_n(_products(spark).repartition(7), 10, [F.desc("stock")], ["idProducto"])
    assert [r[0] for r in again.collect()] == [2, 1, 3, 4, 5, 6, 7, 8, 9, 10]


def test_top_n_puts_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 7)], "id int, v int")
    assert [r[0] for r in top_n(df, 3, [F.desc("v")], ["id"]).collect()] == [3, 2, 1]


def test_rows_at_extreme_keeps_ties(spark):
    df = spark.createDataFrame(
        [("2016-01-01", 10.0), ("2016-01-02", 12.5), ("2016-01-03", 12.5), ("2016-01-04", None)],
        "Date string, High double",
    )
    assert rows(rows_at_extreme(df, "High", "max"), "Date") == [("2016-01-02",), ("2016-01-03",)]
    assert rows(rows_at_extreme(df, "High", "min"), "Date") == [("2016-01-01",)]


def test_rows_at_extreme_of_empty_table(spark):
    df = spark.createDataFrame([], "Date string, High double")
    assert rows_at_extreme(df, "High").count() == 0


def _hotels(spark):
    hotels = spark.createDataFrame(
        [(1, "A", "Madrid", "es"), (2, "B", "Sevilla", " ES "), (3, "C", "Paris", "fr")],
        "id int, name string, city_hotel string, cc1 string",
    )
    revenue = spark.createDataFrame([(1, 100), (2, None)], "id int, revenue int")
    return hotels, revenue


def test_without_value_is_not_an_anti_join(spark):
    hotels, revenue = _hotels(spark)
    # unmatched (C) and matched-with-null (B) both count as "no revenue"
    assert rows(without_value(hotels, revenue, "id", "revenue"), "name") == [("B",), ("C",)]
    assert rows(never_matched(hotels, revenue, "id"), "name") == [("C",)]


def test_outer_form_equals_anti_join(spark):
    left = spark.createDataFrame([(k,) for k in range(10)], "k long")
    right = spark.createDataFrame([(k % 4,) for k in range(40)] + [(None,)], "r long")
    anti = never_matched(left, right, F.col("k") == F.col("r"))
    outer = never_matched_outer(left, "k", right, "r")
    assert rows(anti) == rows(outer) == [(k,) for k in range(4, 10)]


def test_facts_of_top_n_and_in_list_agree(spark):
    products = _products(spark)
    facts = spark.createDataFrame(
        [(f"t{i}", i % 30) for i in range(200)], "fecha string, producto int"
    )
    semi = facts_of_top_n(facts, "producto", products, "idProducto", 10, [F.desc("stock")], ["idProducto"])
    listed = in_list(facts, "producto", [2, 1, 3, 4, 5, 6, 7, 8, 9, 10])
    assert rows(semi) == rows(listed)
    assert semi.columns == ["fecha", "producto"]
    # an unsold product in the top list adds no rows and duplicates none
    assert semi.count() == facts.filter(F.col("producto").between(1, 10)).count()


def test_share_where_and_count_rows(spark):
    df = spark.createDataFrame([(x,) for x in [100.0, 600.0, 700.0, None]], "Close double")
    assert share_where(df, F.col("Close") > 500, "pct").collect()[0][0] == 50.0
    assert count_rows(df.filter(F.col("Close") > 500), "days").collect()[0][0] == 2


def test_null_left_keys_survive_both_unmatched_forms(spark):
    left = spark.createDataFrame([(1,), (None,), (3,)], "k long")
    right = spark.createDataFrame([(1,)], "r long")
    anti = sorted((r[0] for r in never_matched(left, right, F.col("k") == F.col("r")).collect()), key=str)
    outer = sorted((r[0] for r in never_matched_outer(left, "k", right, "r").collect()), key=str)
    assert anti == outer == sorted([None, 3], key=str)


def test_rows_at_extreme_with_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, 2.0)], "i int, v double")
    # Spark orders NaN above every number, and joins NaN to NaN
    assert rows(rows_at_extreme(df, "v", "max"), "i") == [(2,)]
    assert rows(rows_at_extreme(df, "v", "min"), "i") == [(1,)]
