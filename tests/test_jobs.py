"""The jobs on files in their original layouts, with the original parameters."""

import os

from conftest import rows, write_text
from quarry.plans import jobs
from quarry.sources import read_delimited


def test_hotel_job(spark, scratch):
    hotels = write_text(
        os.path.join(scratch, "hotels.csv"),
        "id;name;stars;rooms;city_hotel;cc1\n1;Hotel Ábaco;4;50;Madrid;es\n2;Hotel Sol;3;20;Sevilla; ES \n"
        "3;Le Petit;2;10;Paris;fr\n4;Hotel Vacío;1;5;Bilbao;es\n5;Hotel Mar;3;30;Madrid;es\n",
        newline="\r\n",
    )
    income = write_text(os.path.join(scratch, "revenue.csv"), "id;revenue\n1;500\n2;300\n3;\n5;500\n", newline="\r\n")
    r = jobs.hotel_results(spark, hotels, income)
    assert rows(r["spain"], "id") == [(1,), (5,)]
    assert rows(r["spain_normalized"], "id") == [(1,), (2,), (5,)]
    assert [x["id"] for x in r["top_hotels"].collect()] == [1, 5, 2, 3]
    assert dict(r["top_cities"].collect()) == {"Madrid": 1000.0, "Sevilla": 300.0, "Paris": None}
    assert rows(r["no_revenue"], "id") == [(3,), (4,)]


def test_shop_job(spark, scratch):
    products = write_text(
        os.path.join(scratch, "products.txt"), "".join(f"{i}#item {i}#{i}.25#{30 - i}\n" for i in range(1, 13)), newline="\r\n"
    )
    sales = write_text(
        os.path.join(scratch, "sales.txt"),
        "2020-01-01#10:00#7#1#2#10.1\n2020-01-01#11:00#8#1#1#15.0\n2020-01-02#12:00#8#2#3#0.05\n2020-01-02#13:00#9#12#1#15.05\n",
    )
    r = jobs.shop_results(spark, products, sales)
    assert [tuple(x) for x in r["top_client"].collect()] == [(8, 15.05)]
    assert rows(r["sold_items"]) == [(1, "item 1", 3), (2, "item 2", 3), (12, "item 12", 1)]
    assert dict(r["sold_items"].dtypes)["items_sold"] == "bigint"  # an integer count stays an integer
    assert r["never_sold"].count() == 9
    assert r["never_sold"].columns == ["idProducto", "descripcion", "precio"]
    assert rows(r["top_stock_sales"], "producto") == [(1,), (1,), (2,)]


def test_price_job(spark, scratch):
    prices = write_text(
        os.path.join(scratch, "prices.csv"),
        "Date,Open,High,Low,Close,Volume,Adj Close\n2015-12-30,100.0,700.0,90.0,650.0,5,650.0\n"
        "2015-12-31,101.0,700.0,91.0,550.0,9,550.0\n2016-01-04,102.0,,92.0,610.0,5,610.0\n"
        "2016-01-05,103.0,480.0,93.0,590.0,7,590.0\n",
    )
    fx = write_text(
        os.path.join(scratch, "fx.csv"),
        'Date,Price,Open,High,Low,Change %\n"Dec 30, 2015",0.91,0.9,0.95,0.85,0.1%\n'
        '"Jan 04, 2016",0.81,0.8,0.9,0.7,-0.2%\n"not a date",1.0,1.0,1.0,1.0,0%\n',
    )
    r = jobs.price_results(spark, prices, fx)
    assert len(r) == 17
    assert r["max_high_day"].count() == 2
    assert r["close_above"].count() == 2  # close > 600: 650 and 610
    assert "Adj Close" in r["close_above"].columns  # the input rows as they are
    assert r["pct_high_above"].first()[0] == 50.0
    assert r["eur_mean_close"].first()[0] == 536.5
    assert rows(r["eur_min_high_by_year"]) == [(2015, 665.0), (2016, None)]  # 2016-01-04 has a rate but no high


def test_rating_job_and_writer(spark, scratch):
    users = write_text(os.path.join(scratch, "users.txt"), "1::F::25::3::01234\n2::M::35::7::55555\n3::F::45::1::99999\n")
    votes = write_text(
        os.path.join(scratch, "votes.txt"), "1::10::5::978300760\n1::11::4::978300761\n2::10::3::978300762\n9::10::1::978300763\n"
    )
    movies = write_text(os.path.join(scratch, "movies.txt"), "10::Heat (1995)::Action|Crime\n11::Up: a story, told::Animation\n")
    r = jobs.rating_results(spark, users, votes, movies)
    assert dict(r["mean_by_user"].collect()) == {1: 4.5, 2: 3.0}
    assert dict(r["mean_by_gender"].collect()) == {"F": 4.5, "M": 3.0}
    assert rows(r["users_below"], "user_id") == [(2,)]
    written = jobs.write_results(r, os.path.join(scratch, "out"))
    back = read_delimited(spark, written["top_movies"], header=True, schema=r["top_movies"].schema)
    assert rows(back) == rows(r["top_movies"])


def test_word_count_job(spark, scratch):
    folder = os.path.join(scratch, "texts")
    os.makedirs(folder)
    write_text(os.path.join(folder, "a.txt"), "to be\n\n  or not to be\n")
    write_text(os.path.join(folder, "b.txt"), "be\tquick\n")
    r = jobs.word_counts(spark, folder)
    assert dict(r["word_count"].collect()) == {"to": 2, "be": 3, "or": 1, "not": 1, "quick": 1}


def test_shop_results_as_tuple_text(spark, scratch):
    import glob

    import pytest

    products = write_text(os.path.join(scratch, "products.txt"), "1#uno#1.5#5\n2#dos#2.5#9\n")
    sales = write_text(os.path.join(scratch, "sales.txt"), "2020-01-01#10:00#7#1#2#10.5\n")
    r = jobs.shop_results(spark, products, sales)
    written = jobs.write_results({"top_client": r["top_client"]}, os.path.join(scratch, "out"), fmt="tuples")
    lines = [line for f in glob.glob(os.path.join(written["top_client"], "part-*")) for line in open(f).read().splitlines()]
    assert lines == ["(7, 10.5)"]
    with pytest.raises(Exception):  # like the line-by-line jobs: an existing folder is an error
        jobs.write_results({"top_client": r["top_client"]}, os.path.join(scratch, "out"), fmt="tuples")


def test_results_that_grow_are_written_by_size(spark, scratch):
    """A product with most of all sales is split over files; only bounded results have a stated number."""
    import glob
    import os

    from pyspark.sql import functions as F

    from quarry.plans.jobs import LAYOUTS, write_results

    growing = {"sold_report", "never_sold", "top_stock_sales", "eur_close_above"}
    assert all("rebalance" in LAYOUTS[n] and "files" not in LAYOUTS[n] and "by" not in LAYOUTS[n] for n in growing)
    sales = spark.range(120_000).select(
        F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id") % 50).alias("producto"), F.sha2(F.col("id").cast("string"), 256).alias("fecha"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_results({"top_stock_sales": sales.repartition(10)}, scratch + "/out")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
        spark.catalog.dropTempView("top_stock_sales")
    sizes = [os.path.getsize(f) for f in glob.glob(scratch + "/out/top_stock_sales/part-*")]
    assert len(sizes) >= 4 and max(sizes) < sum(sizes) / 2
    assert spark.read.option("header", True).csv(scratch + "/out/top_stock_sales").count() == 120_000
