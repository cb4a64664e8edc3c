from pyspark.sql import functions as F

from conftest import SMOKE_DIR, rows
from quarry.plans import views, walkthrough
from quarry.sources.tables import table


def test_timed_steps_reports_every_step(spark):
    t = walkthrough.timed_steps(spark, SMOKE_DIR, copies=3)
    assert list(t) == ["load", "build", "clean", "transform", "action"]
    assert all(v >= 0 for v in t.values())


def test_party_union_types_and_short_cases(spark):
    u = walkthrough.party_union(table(spark, SMOKE_DIR, "customer"), table(spark, SMOKE_DIR, "supplier"))
    assert u.columns == list(walkthrough.PARTY_COLUMNS)
    types = dict(u.dtypes)
    assert types["datasetId"] == "string" and types["dateEnd"] == "string" and types["geoY"] == "double"
    sup = u.filter(F.col("county") == "Suppliers")
    # a type without " - " and a one-element location both give null, not an error
    assert sup.filter(F.col("type").isNull()).count() > 0
    assert sup.filter(F.col("geoY").isNull()).count() == sup.filter(F.col("geoX") < 0).count()


def test_full_name_null_in_null_out(spark):
    df = spark.createDataFrame([(1, "Perrin", 7), (2, None, 3)], "c_custkey long, c_name string, c_nationkey int")
    assert dict(walkthrough.full_name(df).collect()) == {1: "Perrin, 7", 2: None}


def test_parse_round_trips(spark):
    orders = table(spark, SMOKE_DIR, "orders")
    back = walkthrough.parse_delimited(orders)
    assert rows(back) == rows(orders.select(*back.columns))
    dates = walkthrough.parse_dates(orders)
    assert dates.filter("iso_date <> named_date OR iso_date IS NULL").count() == 0


def test_views_with_bound_parameters(spark):
    df = spark.createDataFrame([(1, 3.5), (2, 4.5)], "user_id long, mean_rating double")
    views.register({"ratings_view": df})
    assert rows(views.query(spark, "SELECT user_id FROM ratings_view WHERE mean_rating < :t", t=4)) == [(1,)]
    # a parameter is a value, never SQL text
    assert views.query(spark, "SELECT count(*) FROM ratings_view WHERE :t = 'x OR 1=1'", t="1").first()[0] == 0


def test_driver_rows_keep_statuses_without_orders(spark):
    from quarry.plans.walkthrough import STATUS_ROWS, orders_by_status

    orders = spark.createDataFrame([("F",), ("F",), ("P",), (None,), ("?",)], "o_orderstatus string")
    got = {r["status"]: r["orders"] for r in orders_by_status(orders, [("Z", "late")]).collect()}
    assert got == {"F": 2, "P": 1, "O": 0, "X": 0, "Z": 0}
    assert orders_by_status(orders.limit(0)).count() == len(STATUS_ROWS)
