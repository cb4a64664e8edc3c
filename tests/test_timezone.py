"""Day-level results do not depend on the session time zone (the tables hold
timestamps without a zone, and every date is taken from them directly)."""

import pytest

import __spark_entry__ as entry
from conftest import SMOKE_DIR

DATED = ["parse_dates", "day_of_max_high", "converted_prices", "mean_close_by_month", "eur_max_high_by_year"]


@pytest.mark.parametrize("name", DATED)
def test_same_days_in_every_time_zone(spark, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        results = []
        for tz in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = entry.queries()[name](spark, SMOKE_DIR)
            results.append(sorted((tuple(r) for r in df.collect()), key=str))
        assert results[0] == results[1] == results[2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
