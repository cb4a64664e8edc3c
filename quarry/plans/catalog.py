"""Every registered question as ``fn(spark, data_dir) -> DataFrame``.

Each reads whole tables of ``data_dir`` (or relations Spark derives from them)
and returns a lazy DataFrame; nothing is collected here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from quarry.functions.money import exact_state, exact_sum, state_sum, state_text
from quarry.functions.rounding import round_half_even
from quarry.operators.wordcount import word_count
from quarry.plans import partitioned, prices as px
from quarry.plans import ratings as rt
from quarry.plans import retail, revenue, roundtrip, standins, views, walkthrough
from quarry.sources.tables import table

# Parameters of the questions on the test tables.
COUNTRY = "F"                # stays' country code (order status 'F')
TOP_STAYS = 100
TOP_GROUPS = 200
TOP_STOCK = 10
TOP_ITEMS = 10
CLOSE_ABOVE = 450000.0
HIGH_ABOVE = 400000.0
RATING_BELOW = 45.0
FIRST_MONTH, LAST_MONTH = "1995-01", "1995-06"
BUSIEST_MONTHS = 3

Query = Callable[[SparkSession, str], DataFrame]


def _joined(spark: SparkSession, d: str, drop_null: bool = False) -> DataFrame:
    return standins.stays_with_income(spark, d, drop_null=drop_null)


def _by_customer(spark: SparkSession, d: str, drop_null: bool = False) -> DataFrame:
    return standins.customer_income(spark, d, drop_null=drop_null)


def _converted(spark: SparkSession, d: str) -> DataFrame:
    return px.convert(standins.prices(spark, d), standins.rates(spark, d))


# ---- revenue -------------------------------------------------------------

def q_revenue_by_country(spark, d):
    return revenue.revenue_in(_joined(spark, d), cc=COUNTRY)


def q_revenue_by_country_normalized(spark, d):
    return revenue.revenue_in(_joined(spark, d, drop_null=True), cc=" f ", normalize=True, drop_null=True)


def q_top100_revenue(spark, d):
    return revenue.top_revenue(_joined(spark, d), n=TOP_STAYS)


def q_top100_present_revenue(spark, d):
    return revenue.top_revenue(_joined(spark, d, drop_null=True), n=TOP_STAYS, drop_null=True)


def q_top200_city_name_revenue(spark, d):
    return revenue.revenue_by(_by_customer(spark, d), by=("city", "name"), n=TOP_GROUPS)


def q_top200_name_revenue(spark, d):
    return revenue.revenue_by(_by_customer(spark, d, drop_null=True), by=("name",), n=TOP_GROUPS, drop_null=True)


def q_city_revenue(spark, d):
    return revenue.revenue_by(_by_customer(spark, d), by=("city",), n=TOP_GROUPS)


def q_no_revenue(spark, d):
    return revenue.no_revenue(_joined(spark, d))


# ---- retail --------------------------------------------------------------

def q_top_spender(spark, d):
    return retail.top_spender(table(spark, d, "orders"), "o_custkey", "o_totalprice", n=1)


def q_top_spender_unrounded(spark, d):
    return retail.top_spender(table(spark, d, "orders"), "o_custkey", "o_totalprice", n=1, digits=None)


def q_sold_report(spark, d):
    return retail.sold_report(
        table(spark, d, "lineitem"), "l_partkey", table(spark, d, "part"), "p_partkey", "p_name",
        "l_quantity", "l_extendedprice",
    )


def q_sold_items_only(spark, d):
    return retail.sold_report(
        table(spark, d, "lineitem"), "l_partkey", table(spark, d, "part"), "p_partkey", "p_name",
        "l_quantity", None,
    )


_UNSOLD_COLS = ["o_orderkey", "o_custkey", "o_totalprice"]


def q_never_sold(spark, d):
    return retail.never_sold(table(spark, d, "orders"), "o_orderkey", table(spark, d, "lineitem"), "l_orderkey", _UNSOLD_COLS)


def q_never_sold_outer(spark, d):
    return retail.never_sold_outer(
        table(spark, d, "orders"), "o_orderkey", table(spark, d, "lineitem"), "l_orderkey", _UNSOLD_COLS
    )


def q_lines_of_top10_stock(spark, d):
    return retail.facts_of_top_stock(
        table(spark, d, "lineitem"), "l_partkey", table(spark, d, "part"), "p_partkey", "p_size", TOP_STOCK
    )


def q_lines_in_list(spark, d):
    return retail.facts_in_top_stock_list(
        table(spark, d, "lineitem"), "l_partkey", table(spark, d, "part"), "p_partkey", "p_size", TOP_STOCK
    )


# ---- prices --------------------------------------------------------------

def q_day_of_max_high(spark, d):
    return px.day_of_extreme(standins.prices(spark, d), "high", "max", "high")


def q_day_of_max_volume(spark, d):
    return px.day_of_extreme(standins.prices(spark, d), "volume", "max", "max_volume", rounded=False)


def q_day_of_min_volume(spark, d):
    return px.day_of_extreme(standins.prices(spark, d), "volume", "min", "min_volume", rounded=False)


def q_mean_close(spark, d):
    return px.mean_of(standins.prices(spark, d), "close", "mean_close")


def q_days_close_above(spark, d):
    return px.days_above(standins.prices(spark, d), "close", CLOSE_ABOVE)


def q_days_close_above_count(spark, d):
    return px.days_above_count(standins.prices(spark, d), "close", CLOSE_ABOVE)


def q_pct_days_high_above(spark, d):
    return px.pct_above(standins.prices(spark, d), "high", HIGH_ABOVE, "pct_days_high_above")


def q_pct_days_high_above_half_even(spark, d):
    return px.pct_above_half_even(standins.prices(spark, d), "high", HIGH_ABOVE, "pct_days_high_above")


def q_eur_pct_high_above_half_even(spark, d):
    return px.pct_above_half_even(_converted(spark, d), "high_eur", HIGH_ABOVE, "pct_days_high_eur_above")


def q_max_high_by_year(spark, d):
    return px.extreme_by_year(standins.prices(spark, d), "high", "max", "max_high")


def q_mean_close_by_month(spark, d):
    return px.mean_by_month(standins.prices(spark, d), "close", "mean_close")


def q_converted_prices(spark, d):
    return _converted(spark, d)


def q_eur_day_of_max_high(spark, d):
    return px.day_of_extreme(_converted(spark, d), "high_eur", "max", "high_eur")


def q_eur_mean_close(spark, d):
    return px.mean_of(_converted(spark, d), "close_eur", "mean_close_eur")


def q_eur_day_of_max_volume(spark, d):
    return px.day_of_extreme(_converted(spark, d), "volume", "max", "max_volume", rounded=False)


def q_eur_day_of_min_volume(spark, d):
    return px.day_of_extreme(_converted(spark, d), "volume", "min", "min_volume", rounded=False)


def q_eur_days_close_above(spark, d):
    return px.days_above(_converted(spark, d), "close_eur", CLOSE_ABOVE)


def q_eur_pct_high_above(spark, d):
    return px.pct_above(_converted(spark, d), "high_eur", HIGH_ABOVE, "pct_days_high_eur_above")


def q_eur_max_high_by_year(spark, d):
    return px.extreme_by_year(_converted(spark, d), "high_eur", "max", "max_high_eur")


def q_eur_min_high_by_year(spark, d):
    return px.extreme_by_year(_converted(spark, d), "high_eur", "min", "min_high_eur")


def q_eur_mean_close_by_month(spark, d):
    return px.mean_by_month(_converted(spark, d), "close_eur", "mean_close_eur")


# ---- ratings -------------------------------------------------------------

def q_mean_by_user(spark, d):
    return rt.mean_by_user(standins.ratings(spark, d), standins.users(spark, d))


def q_mean_by_segment(spark, d):
    return rt.mean_by_segment(standins.ratings(spark, d), standins.users(spark, d))


def q_top10_items(spark, d):
    return rt.top_items(standins.ratings(spark, d), standins.items(spark, d), TOP_ITEMS)


def q_users_below_threshold(spark, d):
    return rt.below_threshold(spark, q_mean_by_user(spark, d), RATING_BELOW)


# ---- walkthrough and text -------------------------------------------------

def q_full_name(spark, d):
    return walkthrough.full_name(table(spark, d, "customer"))


def q_conform_flat(spark, d):
    return walkthrough.conform_flat(table(spark, d, "customer"))


def q_conform_nested(spark, d):
    return walkthrough.conform_nested(walkthrough.supplier_documents(table(spark, d, "supplier")))


def q_party_union(spark, d):
    return walkthrough.party_union(table(spark, d, "customer"), table(spark, d, "supplier"))


def q_replicate_midpoint(spark, d):
    return walkthrough.replicate_midpoint(table(spark, d, "supplier"))


def q_self_union(spark, d):
    return walkthrough.self_union(table(spark, d, "nation"))


def q_parse_delimited(spark, d):
    return walkthrough.parse_delimited(table(spark, d, "orders"))


def q_parse_dates(spark, d):
    return walkthrough.parse_dates(table(spark, d, "orders"))


def q_orders_by_status(spark, d):
    return walkthrough.orders_by_status(table(spark, d, "orders"))


def q_word_count(spark, d):
    return word_count(table(spark, d, "documents"), "text")


# ---- readers and writers on whole tables ---------------------------------

def q_roundtrip_hash_separated(spark, d):
    return roundtrip.hash_separated(spark, table(spark, d, "orders"))


def q_roundtrip_semicolon_header(spark, d):
    return roundtrip.semicolon_with_header(spark, table(spark, d, "customer"))


def q_roundtrip_hive_text(spark, d):
    # part, not lineitem: the reader check needs a whole real table, not the largest one
    return roundtrip.hive_text(spark, table(spark, d, "part"))


def q_roundtrip_double_colon(spark, d):
    return roundtrip.double_colon_lines(spark, table(spark, d, "events"))


def q_roundtrip_nested_json(spark, d):
    return roundtrip.nested_json(spark, table(spark, d, "supplier"))


def q_inferred_comma_separated(spark, d):
    return roundtrip.inferred_comma_separated(spark, table(spark, d, "orders"))


def q_headed_lines_income(spark, d):
    return roundtrip.headed_lines(spark, standins.income(spark, d))


def q_roundtrip_tuple_text(spark, d):
    return roundtrip.tuple_lines(spark, table(spark, d, "events"))


def q_stored_schema(spark, d):
    return roundtrip.stored_schema(spark, table(spark, d, "part"))


# ---- folders per month, views, exact numbers -------------------------------

_LINE_COLS = ["l_orderkey", "l_quantity", "l_extendedprice"]


def q_month_sales(spark, d):
    facts = partitioned.by_month(spark, table(spark, d, "lineitem"), "l_shipdate", "ship_month", _LINE_COLS)
    return partitioned.month_sales(facts, "ship_month", "l_quantity", "l_extendedprice", FIRST_MONTH, LAST_MONTH)


def q_busiest_month_sales(spark, d):
    facts = partitioned.by_month(spark, table(spark, d, "lineitem"), "l_shipdate", "ship_month", _LINE_COLS)
    return partitioned.busiest_month_sales(
        facts, "ship_month", "l_quantity", "l_extendedprice", table(spark, d, "orders"), "o_orderdate", BUSIEST_MONTHS
    )


def q_spending_of_users_below(spark, d):
    spent = table(spark, d, "orders").groupBy("o_custkey").agg(exact_sum("o_totalprice").alias("total_spent"))
    return views.answer(
        spark, {"user_means": q_mean_by_user(spark, d), "user_spending": spent},
        "SELECT m.user_id, m.mean_rating, s.total_spent FROM user_means m JOIN user_spending s ON m.user_id = s.o_custkey WHERE m.mean_rating < :below",
        below=RATING_BELOW,
    )


def q_totals_of_all_sizes(spark, d):
    # prices shifted by twenty places up and eighteen down, line by line: their sum has over thirty digits
    shift = F.when(F.col("l_linenumber") % 3 == 0, "E20").when(F.col("l_linenumber") % 3 == 1, "E0").otherwise("E-18")
    value = F.concat(F.col("l_extendedprice").cast("string"), shift).cast("double")
    sums = table(spark, d, "lineitem").select("l_returnflag", value.alias("value")).groupBy("l_returnflag").agg(exact_state("value").alias("s"))
    return sums.select("l_returnflag", state_text("s").alias("digits"), state_sum("s").alias("total"))


def q_half_even_charges(spark, d):
    charge = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", charge.alias("charge"), (F.col("l_extendedprice") / 8).alias("eighth"))
    return lines.select("l_orderkey", "l_linenumber", round_half_even("charge").alias("charge"), round_half_even("eighth", 1).alias("eighth"))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


# The SURVEY §2 ids each registered query answers.
SURVEY_IDS: dict[str, tuple[str, ...]] = {
    "revenue_by_country": ("H1", "F1", "J1", "P1"),
    "revenue_by_country_normalized": ("H1r", "F2", "F5"),
    "top100_revenue": ("H2", "O1", "O3", "O4"),
    "top100_present_revenue": ("H2r",),
    "top200_city_name_revenue": ("H3", "A2"),
    "top200_name_revenue": ("H3r", "A10"),
    "city_revenue": ("H3",),
    "no_revenue": ("H4", "H4r", "J5", "J9", "F4", "X15"),
    "top_spender": ("R1", "A11", "O5"),
    "top_spender_unrounded": ("R1r",),
    "sold_report": ("R2", "A1", "A3", "J2", "X1"),
    "sold_items_only": ("R2r", "A10"),
    "never_sold": ("R3", "J6"),
    "never_sold_outer": ("R3r", "J9"),
    "lines_of_top10_stock": ("R4", "J7", "O4"),
    "lines_in_list": ("R4r", "F8"),
    "day_of_max_high": ("N1", "J4", "A6", "X1"),
    "day_of_max_volume": ("N3", "J4", "A6"),
    "day_of_min_volume": ("N4", "J4", "A6"),
    "mean_close": ("N2", "A5"),
    "days_close_above": ("N5", "F3"),
    "days_close_above_count": ("N5", "K5", "S9"),
    "pct_days_high_above": ("N6", "A9", "S9"),
    "max_high_by_year": ("N7", "A7", "X7"),
    "mean_close_by_month": ("N8", "A8", "O2"),
    "converted_prices": ("E0", "J3", "X3"),
    "eur_day_of_max_high": ("E1", "J4"),
    "eur_mean_close": ("E2", "A5"),
    "eur_day_of_max_volume": ("E3", "J4"),
    "eur_day_of_min_volume": ("E4", "J4"),
    "eur_days_close_above": ("E5", "F3"),
    "eur_pct_high_above": ("E6", "A9"),
    "eur_max_high_by_year": ("E7", "A7", "O2"),
    "eur_min_high_by_year": ("E8", "A7"),
    "eur_mean_close_by_month": ("E9", "A8", "O2"),
    "mean_by_user": ("M1", "A4", "J2"),
    "mean_by_segment": ("M2", "A4"),
    "top10_items": ("M3", "A4", "O4"),
    "users_below_threshold": ("M4", "F9"),
    "spending_of_users_below": ("F9", "K6", "S11", "V1"),
    "inferred_comma_separated": ("W1", "S2", "K1"),
    "headed_lines_income": ("S5", "F6", "F7"),
    "roundtrip_tuple_text": ("K2",),
    "stored_schema": ("K7", "W4"),
    "month_sales": ("L2", "A1"),
    "busiest_month_sales": ("L2", "J1"),
    "totals_of_all_sizes": ("A1", "A10"),
    "half_even_charges": ("X2",),
    "pct_days_high_above_half_even": ("N6", "A9", "X2"),
    "eur_pct_high_above_half_even": ("E6", "A9", "X2"),
    "orders_by_status": ("W7", "S8", "S10"),
    "full_name": ("W2", "X8"),
    "conform_flat": ("W3", "P2", "P3", "P6", "P7", "X8"),
    "conform_nested": ("W5", "S7", "P11", "X9", "X10", "X11"),
    "party_union": ("W6", "U2", "P8"),
    "replicate_midpoint": ("W8", "U3", "X4", "P5"),
    "self_union": ("W9", "U1", "X4"),
    "parse_delimited": ("S4", "X13", "X14"),
    "parse_dates": ("X5", "X6"),
    "word_count": ("W10", "A12"),
    "roundtrip_hash_separated": ("S3", "S6", "K1"),
    "roundtrip_semicolon_header": ("S1", "K1"),
    "roundtrip_hive_text": ("S13", "K1"),
    "roundtrip_double_colon": ("S4",),
    "roundtrip_nested_json": ("S7", "W5"),
}
