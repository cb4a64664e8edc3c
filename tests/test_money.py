from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions.money import (
    exact_mean, exact_state, exact_sum, exact_total, mean_from_parts, merged_state, round_half_up, share_pct, state_order, state_rounded,
    state_sum, state_text,
)


def _half_up(fr: Fraction, digits: int = 2) -> float:
    """Brute force: exact rational rounded half away from zero."""
    sign = 1 if fr >= 0 else -1
    units = (abs(fr.numerator) * 10**digits * 2 + fr.denominator) // (2 * fr.denominator)
    return sign * units / 10**digits


def test_round_half_up_decimal_reading(spark):
    df = spark.createDataFrame([(2.675,), (0.125,), (1.005,), (0.285,), (-1.005,), (None,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x").alias("r")).collect()]
    assert got == [2.68, 0.13, 1.01, 0.29, -1.01, None]


def test_exact_sum_null_only_group_is_null(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.1), ("b", 2.2)], "k string, v double")
    got = dict(df.groupBy("k").agg(exact_sum("v").alias("s")).collect())
    assert got["a"] is None
    assert got["b"] == 3.3  # float sum would give 3.3000000000000003


def test_exact_mean_halves_round_up(spark):
    # mean 2.125 -> 2.13 ; mean 58530.425 -> 58530.43 ; -0.005 -> -0.01
    df = spark.createDataFrame(
        [("a", 2.12), ("a", 2.13), ("b", 58530.42), ("b", 58530.43), ("c", -0.01), ("c", 0.0), ("d", None)],
        "k string, v double",
    )
    got = dict(df.groupBy("k").agg(exact_mean("v").alias("m")).collect())
    assert got == {"a": 2.13, "b": 58530.43, "c": -0.01, "d": None}


def test_exact_mean_on_empty_table_is_null(spark):
    df = spark.createDataFrame([], "v double")
    assert df.agg(exact_mean("v").alias("m")).collect()[0][0] is None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(min_value=-10**9, max_value=10**9), min_size=1, max_size=40))
def test_exact_mean_matches_rational_arithmetic(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "v double")
    got = df.agg(exact_mean("v").alias("m")).collect()[0][0]
    assert got == _half_up(Fraction(sum(cents), 100 * len(cents)))


def test_share_counts_nulls_in_denominator(spark):
    df = spark.createDataFrame([(600.0,), (400.0,), (None,)], "h double")
    got = df.agg(share_pct(F.col("h") > 500).alias("p")).collect()[0][0]
    assert got == 33.33  # 1 of 3, not 1 of 2


def test_share_rounds_half_up_and_empty_is_null(spark):
    df = spark.createDataFrame([(1,)] + [(0,)] * 7, "x int")  # 12.5 %
    assert df.agg(share_pct(F.col("x") == 1, digits=0).alias("p")).collect()[0][0] == 13.0
    empty = spark.createDataFrame([], "x int")
    assert empty.agg(share_pct(F.col("x") == 1).alias("p")).collect()[0][0] is None


@pytest.mark.parametrize("value,expected", [(Decimal("2.675"), 2.68), (Decimal("1.115"), 1.12)])
def test_decimal_reference_rounding(value, expected):
    assert float(value.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) == expected


def test_cents_and_other_decimals_add_up_exactly(spark):
    df = spark.createDataFrame([("a", 1.25), ("a", 2.505), ("b", -0.01), ("b", None), ("c", 0.1), ("c", 0.004), ("c", 1e-18)], "k string, v double")
    got = dict(df.groupBy("k").agg(exact_total("v").alias("s")).collect())
    assert got == {"a": Decimal("3.755"), "b": Decimal("-0.01"), "c": Decimal("0.104000000000000001")}


def test_nothing_is_rounded_before_the_aggregate(spark):
    """Means and sums of values finer than a cent, as floating arithmetic gives them."""
    def one(values, agg):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(agg.alias("r")).first()[0]

    assert one([10.004, 10.004, 10.008], exact_mean("v")) == 10.01
    assert one([9.12496] * 3, exact_mean("v")) == 9.12
    assert one([9.1249996], exact_mean("v")) == 9.12
    assert one([0.004] * 3, exact_sum("v")) == 0.012
    assert spark.createDataFrame([(9.1249996,)], "v double").select(round_half_up("v")).first()[0] == 9.12


def test_the_biggest_spender_is_found_on_unrounded_sums(spark):
    from quarry.plans.retail import top_spender

    sales = spark.createDataFrame([(1, 0.004)] * 10 + [(2, 0.01)], "client int, amount double")
    assert tuple(top_spender(sales, "client", "amount").first()) == (1, 0.04)
    sales = spark.createDataFrame([(1, 10.004), (2, 10.0)], "client int, amount double")
    assert tuple(top_spender(sales, "client", "amount").first()) == (1, 10.0)
    assert tuple(top_spender(sales, "client", "amount", digits=None).first()) == (1, 10.004)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6).map(lambda v: round(v, 9)), min_size=1, max_size=20))
def test_sums_and_means_equal_decimal_arithmetic(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    total, mean = df.agg(exact_total("v"), exact_mean("v")).first()
    want = sum((Decimal(r[0]) for r in df.selectExpr("CAST(v AS STRING)").collect()), Decimal(0))
    assert total == want
    assert mean == _half_up(Fraction(want) / len(values))


def test_other_number_types(spark):
    df = spark.createDataFrame([(1,)], "x int").selectExpr(
        "CAST(10.1 AS FLOAT) f", "CAST(0.004 AS DECIMAL(38,10)) d", "9007199254740993 AS l", "CAST(7 AS TINYINT) t")
    got = df.agg(*[exact_total(c) for c in ("f", "d", "l", "t")]).first()
    assert tuple(got) == (Decimal("10.1"), Decimal("0.004"), Decimal(9007199254740993), Decimal(7))


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("values", [[1e38], [1.2345678901234567e-30]])
def test_what_has_no_place_raises(spark, ansi, values):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="1E"):
            spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum("v").alias("s")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_totals_that_do_not_fit_their_decimal_raise(spark):
    for values in ([1e30], [1e-20], [float("nan")]):
        with pytest.raises(Exception, match="does not fit"):
            spark.createDataFrame([(v,) for v in values], "v double").agg(exact_total("v").alias("s")).collect()


@pytest.mark.parametrize("values, total, mean", [
    ([1.2345678901234567e-5, 1e30], "1000000000000000000000000000000.000012345678901234568", 5e29),
    ([1.2345678901234567e-5] * 3, "0.000037037036703703704", 0.0),
    ([9.0e16, 9.0e16, -0.01], "179999999999999999.99", 6e16),
    ([1e30, -1e30, 0.005], "0.005", 0.0),
    ([-1e-20, -0.01], "-0.01000000000000000001", -0.01),
    ([1e37, 5e37, -5.9e37], "1000000000000000000000000000000000000", 3.333333333333333e35),
    ([0.0, -0.0], "0", 0.0),
])
def test_values_of_all_sizes_add_up(spark, values, total, mean):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(2)
    state = df.agg(exact_state("v").alias("s"), F.count("v").alias("n"))
    got = state.select(state_text("s"), state_sum("s"), mean_from_parts("s", "n")).first()
    assert got[0] == total and got[1] == float(Decimal(total))
    assert got[2] == pytest.approx(mean, rel=1e-15)
    assert df.agg(exact_sum("v").alias("x"), exact_mean("v").alias("m")).first()[0] == float(Decimal(total))


def test_nan_and_infinities_are_those_of_floating_sums(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([("a", nan), ("a", 1.0), ("b", inf), ("b", 2.5), ("c", inf), ("c", -inf), ("d", -inf)], "k string, v double")
    got = {r["k"]: r for r in df.groupBy("k").agg(exact_sum("v").alias("s"), exact_mean("v").alias("m")).collect()}
    assert got["b"]["s"] == got["b"]["m"] == inf and got["d"]["s"] == -inf
    assert all(got[k][c] != got[k][c] for k in "ac" for c in "sm")


def test_decimals_keep_their_last_digits(spark):
    df = spark.sql("SELECT * FROM VALUES (12345678901234.0005BD), (0.0001BD) AS t(d)")
    assert df.agg(exact_total("d")).first()[0] == Decimal("12345678901234.0006")
    wide = spark.sql("SELECT * FROM VALUES (CAST('0.123456789012345678901234567890123456' AS DECIMAL(38,36))), (CAST('-0.5' AS DECIMAL(38,36))) AS t(d)")
    assert wide.agg(exact_state("d").alias("s")).select(state_text("s")).first()[0] == "-0.376543210987654321098765432109876544"
    long = spark.sql("SELECT CAST('99999999999999999999999999999999999999' AS DECIMAL(38,0)) AS d")
    assert long.agg(exact_state("d").alias("s")).select(state_text("s")).first()[0] == "9" * 38


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(min_value=-1e15, max_value=1e15).filter(lambda v: v == 0 or abs(v) > 1e-10), min_size=1, max_size=15))
def test_states_merge_and_sort_as_exact_sums(spark, values):
    df = spark.createDataFrame([(i % 4, v) for i, v in enumerate(values)], "k int, v double").selectExpr("k", "v", "CAST(v AS STRING) AS printed")
    printed = [Decimal(r["printed"]) for r in df.collect()]
    states = df.groupBy("k").agg(exact_state("v").alias("s"))
    assert Decimal(states.agg(merged_state("s").alias("s")).select(state_text("s")).first()[0]) == sum(printed, Decimal(0))
    sums = {k: sum(printed[k::4], Decimal(0)) for k in range(min(4, len(values)))}
    ordered = [r["k"] for r in states.select("k", state_order("s").alias("o")).orderBy("o", "k").collect()]
    assert ordered == sorted(sums, key=lambda k: (sums[k], k))
    rounded = {r["k"]: r["r"] for r in states.select("k", state_rounded("s").alias("r")).collect()}
    assert rounded == {k: float(x.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for k, x in sums.items()}


def test_sums_take_names_only(spark):
    with pytest.raises(TypeError):
        exact_sum(F.col("v"))


def test_rounding_leaves_numbers_without_places(spark):
    values = [1e30, -1e16, 1.2345678901234567e-5, float("inf"), 9007199254740993.0, -0.005]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(round_half_up("v")).collect()]
    assert got == [1e30, -1e16, 0.0, float("inf"), 9007199254740992.0, -0.01]


def test_midpoint_with_awkward_column_names(spark):
    from quarry.operators.replicate import midpoint

    df = spark.createDataFrame([(1.0, 3.0)], "`lo`` w` double, `up x` double")
    assert midpoint(df, "lo` w", "up x").first()["avg"] == 2.0
