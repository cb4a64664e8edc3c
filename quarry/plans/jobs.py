"""The four analytics jobs and the word count on their own input files.

Each function reads the inputs in the layout the original jobs use (see
FIXTURES.md), answers every question of that job and returns
``{result name: DataFrame}``; ``write_results`` writes them. The questions
are the same functions the registered queries run on the test tables.

A relation several questions share (hotels joined to revenue, the daily and
converted price tables, sales, the per-user ratings) is parsed once and kept as Parquet in the
session's shared checkpoint folder.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.dates import ISO_DAY, MONTH_NAME_DAY, parse_date
from quarry.operators.wordcount import word_count
from quarry.plans import prices as px
from quarry.plans import ratings as rt
from quarry.plans import retail, revenue, views
from quarry.session import ensure_checkpoint_dir, kept, remove_path, require_ansi
from quarry.sinks import write_csv, write_tuple_text
from quarry.sources.delimited import read_delimited, read_lines, read_split_text, read_typed

# The parameters the original jobs ask with.
SPAIN = "es"
TOP_HOTELS = 100
TOP_CITY_HOTELS = 200
TOP_STOCK = 10
TOP_MOVIES = 10
CLOSE_ABOVE = 600.0
HIGH_ABOVE = 500.0
RATING_BELOW = 4.0
MOST_RECORDS = 5_000_000

# Declared layouts of the headerless inputs.
PRODUCTS_SCHEMA = "idProducto INT, descripcion STRING, precio FLOAT, stock INT"
SALES_SCHEMA = "fecha STRING, hora STRING, idCliente INT, producto INT, numero_items INT, dinero_total FLOAT"
USERS_SCHEMA = "idUser INT, genero STRING, edad INT, ocupacion INT, codigoPostal STRING"
RATINGS_SCHEMA = "idUser_ratings INT, idPelicula INT, rating INT, tp INT"
MOVIES_SCHEMA = "idMovie INT, titulo STRING, genero STRING"
# Types of the columns of inputs with a header that are not strings.
HOTEL_TYPES = {"id": "bigint"}
INCOME_TYPES = {"id": "bigint", "revenue": "double"}
PRICE_TYPES = {"Open": "double", "High": "double", "Low": "double", "Close": "double", "Adj Close": "double", "Volume": "bigint"}
RATE_TYPES = {"Price": "double", "Open": "double", "High": "double", "Low": "double"}

# Output files of the results that the original jobs bound or deal by a key. Those that grow with the input
# are dealt by the same keys, in files by size: a hot product is split.
LAYOUTS: dict[str, dict] = {
    "top_hotels": {"files": 1}, "top_city_hotels": {"files": 1}, "top_hotel_names": {"files": 1}, "top_cities": {"files": 1},
    "top_client": {"files": 1}, "sold_report": {"rebalance": ("idProducto",), "records": MOST_RECORDS}, "never_sold": {"rebalance": (), "records": MOST_RECORDS},
    "top_stock_sales": {"rebalance": ("producto",), "records": MOST_RECORDS},
    "max_high_day": {"files": 1}, "mean_close": {"files": 1}, "max_volume_day": {"files": 1}, "min_volume_day": {"files": 1},
    "pct_high_above": {"files": 1}, "max_high_by_year": {"files": 1}, "mean_close_by_month": {"files": 3, "by": ("month",)},
    "eur_max_high_day": {"files": 1}, "eur_mean_close": {"files": 1}, "eur_max_volume_day": {"files": 1},
    "eur_min_volume_day": {"files": 1}, "eur_close_above": {"rebalance": ("date",), "records": MOST_RECORDS}, "eur_pct_high_above": {"files": 1},
    "eur_max_high_by_year": {"files": 1}, "eur_min_high_by_year": {"files": 1}, "eur_mean_close_by_month": {"files": 3, "by": ("month",)},
    "top_movies": {"files": 1},
}


def hotel_results(spark: SparkSession, hotels_path: str, revenue_path: str) -> dict[str, DataFrame]:
    """Hotels (``;``, header: id, name, …, city_hotel, cc1) and revenue (``;``, header: id, revenue)."""
    hotels = read_typed(spark, hotels_path, HOTEL_TYPES, sep=";")
    income = read_typed(spark, revenue_path, INCOME_TYPES, sep=";")
    stays = hotels.select("id", "name", F.col("city_hotel").alias("city"), F.col("cc1").alias("cc"))
    joined = kept(revenue.stays_with_income(stays, income.select("id", "revenue")), "hotels")
    return {
        "spain": revenue.revenue_in(joined, SPAIN),
        "spain_normalized": revenue.revenue_in(joined, SPAIN, normalize=True, drop_null=True),
        "top_hotels": revenue.top_revenue(joined, TOP_HOTELS),
        "top_city_hotels": revenue.revenue_by(joined, ("city", "name"), TOP_CITY_HOTELS),
        "top_hotel_names": revenue.revenue_by(joined, ("name",), TOP_CITY_HOTELS, drop_null=True),
        "top_cities": revenue.revenue_by(joined, ("city",), TOP_CITY_HOTELS),
        "no_revenue": revenue.no_revenue(joined),
    }


def shop_results(spark: SparkSession, products_path: str, sales_path: str) -> dict[str, DataFrame]:
    """Products and transactions: ``#``-separated, no header, declared layouts."""
    products = kept(read_delimited(spark, products_path, sep="#", schema=PRODUCTS_SCHEMA), "products")
    sales = kept(read_delimited(spark, sales_path, sep="#", schema=SALES_SCHEMA), "sales")
    return {
        "top_client": retail.top_spender(sales, "idCliente", "dinero_total"),
        "sold_report": retail.sold_report(
            sales, "producto", products, "idProducto", "descripcion", "numero_items", "dinero_total"
        ),
        "sold_items": retail.sold_report(sales, "producto", products, "idProducto", "descripcion", "numero_items", None),
        "never_sold": retail.never_sold(products, "idProducto", sales, "producto", ["idProducto", "descripcion", "precio"]),
        "top_stock_sales": retail.facts_of_top_stock(sales, "producto", products, "idProducto", "stock", TOP_STOCK),
    }


def price_results(spark: SparkSession, prices_path: str, fx_path: str) -> dict[str, DataFrame]:
    """Daily prices (CSV, header, ``yyyy-MM-dd``) and exchange rates (CSV, header, ``MMM dd, yyyy``)."""
    raw = kept(read_typed(spark, prices_path, PRICE_TYPES), "prices")
    p = raw.withColumnsRenamed({c: c.lower() for c in ("Date", "Open", "High", "Low", "Close", "Volume")}).withColumn(
        "date", parse_date("date", ISO_DAY))
    fx_raw = read_typed(spark, fx_path, RATE_TYPES)
    fx = fx_raw.withColumnsRenamed({"Date": "date", "Open": "open_rate", "High": "high_rate", "Low": "low_rate"}).withColumn(
        "date", parse_date("date", MONTH_NAME_DAY))
    eur = kept(px.convert(p, fx), "converted")  # every column of both files
    return {
        "max_high_day": px.day_of_extreme(p, "high", "max", "high"),
        "mean_close": px.mean_of(p, "close", "mean_close"),
        "max_volume_day": px.day_of_extreme(p, "volume", "max", "max_volume", False),
        "min_volume_day": px.day_of_extreme(p, "volume", "min", "min_volume", False),
        "close_above": px.days_above(raw, "Close", CLOSE_ABOVE),  # the full input rows, every column
        "pct_high_above": px.pct_above(p, "high", HIGH_ABOVE, "pct_days_high_above"),
        "max_high_by_year": px.extreme_by_year(p, "high", "max", "max_high"),
        "mean_close_by_month": px.mean_by_month(p, "close", "mean_close"),
        "eur_max_high_day": px.day_of_extreme(eur, "high_eur", "max", "high_eur"),
        "eur_mean_close": px.mean_of(eur, "close_eur", "mean_close_eur"),
        "eur_max_volume_day": px.day_of_extreme(eur, "volume", "max", "max_volume", False),
        "eur_min_volume_day": px.day_of_extreme(eur, "volume", "min", "min_volume", False),
        "eur_close_above": px.days_above(eur, "close_eur", CLOSE_ABOVE),
        "eur_pct_high_above": px.pct_above(eur, "high_eur", HIGH_ABOVE, "pct_days_high_eur_above"),
        "eur_max_high_by_year": px.extreme_by_year(eur, "high_eur", "max", "max_high_eur"),
        "eur_min_high_by_year": px.extreme_by_year(eur, "high_eur", "min", "min_high_eur"),
        "eur_mean_close_by_month": px.mean_by_month(eur, "close_eur", "mean_close_eur"),
    }


def rating_results(spark: SparkSession, users_path: str, ratings_path: str, movies_path: str) -> dict[str, DataFrame]:
    """Users, ratings and movies: text lines with ``::`` between fields."""
    users = read_split_text(spark, users_path, "::", USERS_SCHEMA)
    votes = read_split_text(spark, ratings_path, "::", RATINGS_SCHEMA)
    movies = read_split_text(spark, movies_path, "::", MOVIES_SCHEMA)
    ratings = votes.select(
        F.col("idUser_ratings").alias("user_id"), F.col("idPelicula").alias("item_id"), "rating"
    )
    people = users.select(F.col("idUser").alias("user_id"), F.col("genero").alias("segment"))
    items = movies.select(F.col("idMovie").alias("item_id"), F.col("titulo").alias("title"))
    parts = kept(rt.rating_parts(ratings, "user_id"), "user_ratings")
    by_user = rt.mean_by_user(ratings, people, parts)
    return {
        "mean_by_user": by_user,
        "mean_by_gender": rt.mean_by_segment(ratings, people, parts),
        "top_movies": rt.top_items(ratings, items, TOP_MOVIES),
        "users_below": rt.below_threshold(spark, by_user, RATING_BELOW),
    }


def word_counts(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Word count of every text file under ``path``."""
    return {"word_count": word_count(read_lines(spark, path), "value")}


def write_results(results: Mapping[str, DataFrame], out_dir: str, fmt: str = "csv") -> dict[str, str]:
    """Write each result under ``out_dir/<name>`` in the files of ``LAYOUTS``, else one per task.

    Every result is also a temp view of its name, for SQL over it (``views.query``).

    ``fmt="csv"`` writes CSV with a header; ``fmt="tuples"`` writes one Python
    tuple per line, as the line-by-line jobs saved their results (the folder
    must not exist yet).
    """
    if fmt not in ("csv", "tuples"):
        raise ValueError("fmt must be 'csv' or 'tuples'")
    written = {}
    views.register(results)
    for name, df in results.items():
        path = os.path.join(out_dir, name)
        if fmt == "csv":
            write_csv(df, path, **LAYOUTS.get(name, {}))
        else:
            write_tuple_text(df, path)
        written[name] = path
    return written


JOBS = {
    "hotels": (hotel_results, ("hotels_csv", "revenue_csv")),
    "shop": (shop_results, ("products_txt", "sales_txt")),
    "prices": (price_results, ("prices_csv", "fx_csv")),
    "ratings": (rating_results, ("users_dat", "ratings_dat", "movies_dat")),
    "wordcount": (word_counts, ("text_dir",)),
}


def main(argv: list[str]) -> int:
    """``python -m quarry.plans.jobs JOB INPUT... OUT_DIR``; prints ``name<TAB>path`` per result."""
    if len(argv) < 2 or argv[1] not in JOBS or len(argv) != len(JOBS[argv[1]][1]) + 3:
        usage = "; ".join(f"{k} {' '.join(v[1])} OUT_DIR" for k, v in JOBS.items())
        print(f"usage: python -m quarry.plans.jobs JOB INPUTS... OUT_DIR  ({usage})")
        return 2
    fn, _ = JOBS[argv[1]]
    spark = SparkSession.builder.appName(f"quarry-{argv[1]}").getOrCreate()
    require_ansi(spark)
    try:
        for name, path in write_results(fn(spark, *argv[2:-1]), argv[-1]).items():
            print(f"{name}\t{path}")
    finally:
        remove_path(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/kept")  # of this application alone
        spark.stop()
    return 0


if __name__ == "__main__":
    import sys

    sys.exit(main(sys.argv))
