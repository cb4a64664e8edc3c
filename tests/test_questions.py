"""The composite questions on small inline tables with the reference's input shapes."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from quarry.functions.dates import MONTH_NAME_DAY, parse_date
from quarry.plans import prices as px
from quarry.plans import ratings as rt
from quarry.plans import retail, revenue


def _stays(spark):
    return spark.createDataFrame(
        [
            (1, "Hotel Ábaco", "Madrid", "es"),
            (2, "Hotel Sol", "Sevilla", " ES "),
            (3, "Le Petit", "Paris", "fr"),
            (4, "Hotel Mar", "Madrid", "es"),
            (5, "Hotel Vacío", "Bilbao", "es"),
        ],
        "id long, name string, city string, cc string",
    )


def _income(spark):
    return spark.createDataFrame([(1, 500.0), (2, 300.0), (3, None), (4, 500.0)], "id long, revenue double")


def _joined(spark):
    return revenue.stays_with_income(_stays(spark), _income(spark))


def test_revenue_in_country_keeps_null_revenue(spark):
    got = rows(revenue.revenue_in(_joined(spark), "es"), "id", "revenue")
    assert got == [(1, 500.0), (4, 500.0)]
    fr = rows(revenue.revenue_in(_joined(spark), "fr"), "id", "revenue")
    assert fr == [(3, None)]  # DataFrame reading keeps the null


def test_revenue_in_normalized_drops_blank(spark):
    got = rows(revenue.revenue_in(_joined(spark), "es", normalize=True, drop_null=True), "id")
    assert got == [(1,), (2,), (4,)]
    fr = revenue.revenue_in(_joined(spark), "FR", normalize=True, drop_null=True)
    assert fr.count() == 0


def test_top_revenue_ties_and_nulls(spark):
    got = [r["id"] for r in revenue.top_revenue(_joined(spark), n=4).collect()]
    assert got == [1, 4, 2, 3]


def test_revenue_by_city_name_and_by_city(spark):
    by_pair = rows(revenue.revenue_by(_joined(spark), ("city", "name"), n=None))
    assert ("Paris", "Le Petit", None) in by_pair
    by_city = dict(revenue.revenue_by(_joined(spark), ("city",), n=None).collect())
    assert by_city == {"Madrid": 1000.0, "Sevilla": 300.0, "Paris": None}


def test_no_revenue_is_unmatched_or_null(spark):
    assert rows(revenue.no_revenue(_joined(spark)), "id") == [(3,), (5,)]


def _sales(spark):
    return spark.createDataFrame(
        [
            ("2020-01-01", "10:00", 7, 1, 2, 10.1),
            ("2020-01-01", "11:00", 8, 1, 1, 15.0),
            ("2020-01-02", "12:00", 8, 2, 3, 0.05),
            ("2020-01-02", "13:00", 9, 2, 1, 15.05),
        ],
        "fecha string, hora string, idCliente int, producto int, numero_items int, dinero_total float",
    )


def _products(spark):
    return spark.createDataFrame(
        [(1, "uno", 1.5, 5), (2, "dos", 2.5, 9), (3, "tres", 3.5, 9)],
        "idProducto int, descripcion string, precio float, stock int",
    )


def test_top_spender_equal_totals_break_by_client(spark):
    got = retail.top_spender(_sales(spark), "idCliente", "dinero_total").collect()
    assert [tuple(r) for r in got] == [(8, 15.05)]  # 8 and 9 tie at 15.05 (float32 inputs)


def test_sold_report_and_never_sold(spark):
    rep = rows(retail.sold_report(_sales(spark), "producto", _products(spark), "idProducto", "descripcion", "numero_items", "dinero_total"))
    assert rep == [(1, "uno", 3.0, 25.1), (2, "dos", 4.0, 15.1)]
    cols = ["idProducto", "descripcion", "precio"]
    anti = retail.never_sold(_products(spark), "idProducto", _sales(spark), "producto", cols)
    outer = retail.never_sold_outer(_products(spark), "idProducto", _sales(spark), "producto", cols)
    assert rows(anti) == rows(outer) == [(3, "tres", 3.5)]


def test_sales_of_top_stock_both_forms(spark):
    semi = retail.facts_of_top_stock(_sales(spark), "producto", _products(spark), "idProducto", "stock", 2)
    listed = retail.facts_in_top_stock_list(_sales(spark), "producto", _products(spark), "idProducto", "stock", 2)
    assert rows(semi) == rows(listed)
    assert rows(semi, "producto") == [(2,), (2,)]  # top 2 by stock: 2 and 3 (3 unsold)


def _prices(spark):
    d = dt.date
    return spark.createDataFrame(
        [
            (d(2015, 12, 30), 100.0, 700.0, 90.0, 650.0, 5),
            (d(2015, 12, 31), 101.0, 700.0, 91.0, 550.0, 9),
            (d(2016, 1, 4), 102.0, None, 92.0, 610.0, 5),
            (d(2016, 1, 5), 103.0, 480.0, 93.0, 590.0, 7),
        ],
        "date date, open double, high double, low double, close double, volume long",
    )


def test_price_questions(spark):
    p = _prices(spark)
    assert rows(px.day_of_extreme(p, "high", "max", "high")) == [
        (dt.date(2015, 12, 30), 700.0),
        (dt.date(2015, 12, 31), 700.0),
    ]
    assert rows(px.day_of_extreme(p, "volume", "min", "min_volume", rounded=False), "date") == [
        (dt.date(2015, 12, 30),),
        (dt.date(2016, 1, 4),),
    ]
    assert px.mean_of(p, "close", "m").first()[0] == 600.0
    assert px.days_above(p, "close", 600).count() == 2
    assert px.pct_above(p, "high", 500, "pct").first()[0] == 50.0  # null high counts in the base
    assert rows(px.extreme_by_year(p, "high", "max", "mx")) == [(2015, 700.0), (2016, 480.0)]
    assert [tuple(r) for r in px.mean_by_month(p, "close", "m").collect()] == [(2015, 12, 600.0), (2016, 1, 600.0)]


def test_conversion_drops_days_without_rate_and_parses_named_dates(spark):
    fx_raw = spark.createDataFrame(
        [("Dec 30, 2015", 0.9, 0.95, 0.85), ("Jan 04, 2016", 0.8, 0.9, 0.7), ("not a date", 1.0, 1.0, 1.0)],
        "Date string, Open double, High double, Low double",
    )
    fx = fx_raw.select(
        parse_date("Date", MONTH_NAME_DAY).alias("date"),
        F.col("Open").alias("open_rate"),
        F.col("High").alias("high_rate"),
        F.col("Low").alias("low_rate"),
    )
    conv = px.convert(_prices(spark), fx)
    assert rows(conv, "date") == [(dt.date(2015, 12, 30),), (dt.date(2016, 1, 4),)]
    first = conv.filter("date = '2015-12-30'").first()
    assert first["close_eur"] == 650.0 * 0.9  # close uses the open rate
    assert first["high_eur"] == 700.0 * 0.95
    assert first["volume"] == 5


def _ratings(spark):
    return spark.createDataFrame(
        [(1, 10, 5.0), (1, 11, 4.0), (1, 12, 4.0), (2, 10, 3.0), (2, 11, 4.0), (3, 12, 2.0), (9, 10, 1.0)],
        "user_id long, item_id int, rating double",
    )


def _users(spark):
    return spark.createDataFrame([(1, "F"), (2, "M"), (3, "F"), (4, "M")], "user_id long, segment string")


def test_rating_means(spark):
    by_user = dict(rt.mean_by_user(_ratings(spark), _users(spark)).collect())
    assert by_user == {1: 4.33, 2: 3.5, 3: 2.0}  # user 4 has no ratings, 9 is unknown
    by_seg = dict(rt.mean_by_segment(_ratings(spark), _users(spark)).collect())
    assert by_seg == {"F": 3.75, "M": 3.5}
    below = rows(rt.below_threshold(spark, rt.mean_by_user(_ratings(spark), _users(spark)), 4), "user_id")
    assert below == [(2,), (3,)]


def test_top_items_ties_after_rounding_broken_by_item(spark):
    items = spark.createDataFrame([(10, "Toy Story"), (11, "Heat"), (12, "Up")], "item_id long, title string")
    r = spark.createDataFrame(
        [(1, 10, 4.0), (2, 10, 4.0), (3, 10, 4.01), (1, 11, 4.0), (1, 12, 1.0)], "user_id long, item_id int, rating double"
    )
    # item 10 averages 4.00333..., item 11 exactly 4.0: equal once rounded
    got = [tuple(x) for x in rt.top_items(r, items, 2).collect()]
    assert got == [(10, "Toy Story", 4.0), (11, "Heat", 4.0)]


def test_orders_first_join_equals_stays_then_income(spark):
    from conftest import SMOKE_DIR
    from quarry.plans import standins

    a = standins.stays_with_income(spark, SMOKE_DIR)
    b = revenue.stays_with_income(standins.stays(spark, SMOKE_DIR), standins.income(spark, SMOKE_DIR))
    cols = ["id", "name", "city", "cc", "revenue", "has_income"]
    assert a.columns == cols
    key = lambda r: (r[0],)
    assert sorted(map(tuple, a.select(cols).collect()), key=key) == sorted(map(tuple, b.select(cols).collect()), key=key)


def test_per_customer_sums_equal_per_stay_sums(spark):
    from conftest import SMOKE_DIR
    from quarry.plans import standins

    stays = standins.stays_with_income(spark, SMOKE_DIR)
    customers = standins.customer_income(spark, SMOKE_DIR)
    for by in (("city", "name"), ("name",), ("city",)):
        for drop_null in (False, True):
            a = revenue.revenue_by(stays, by, n=None, drop_null=drop_null)
            b = revenue.revenue_by(customers, by, n=None, drop_null=drop_null)
            key = lambda r: tuple(str(x) for x in r)
            assert sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key), (by, drop_null)
