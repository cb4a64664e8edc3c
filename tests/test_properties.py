"""Random inputs against brute-force Python."""

from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions.money import exact_sum, share_pct
from quarry.operators.relational import rows_at_extreme, top_n
from quarry.operators.wordcount import word_count

WORDS = st.sampled_from(["a", "bb", "ccc", "Ünï", "d-e", "x1"])
GAPS = st.sampled_from([" ", "  ", "\t", "\n", "\r\n", "\f", " \t "])


@st.composite
def texts(draw):
    parts = []
    for _ in range(draw(st.integers(0, 30))):
        parts.append(draw(GAPS) if draw(st.booleans()) else "")
        parts.append(draw(WORDS))
    if draw(st.booleans()):
        parts.append(draw(GAPS))
    return "".join(parts)


@settings(max_examples=15, deadline=None)
@given(st.lists(texts(), max_size=6))
def test_word_count_equals_whitespace_split(spark, docs):
    df = spark.createDataFrame([(t,) for t in docs], "value string")
    got = dict(word_count(df).collect())
    want = Counter(w for t in docs for w in t.split())
    assert got == dict(want)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.one_of(st.none(), st.integers(0, 5))), min_size=0, max_size=40, unique_by=lambda r: r[0]), st.integers(1, 12))
def test_top_n_equals_sorted_prefix(spark, data, n):
    df = spark.createDataFrame(data, "id int, v int")
    got = [tuple(r) for r in top_n(df, n, [F.desc_nulls_last("v")], ["id"]).collect()]
    want = sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))[:n]
    assert got == want


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3)), max_size=30))
def test_rows_at_extreme_equals_brute_force(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v int")
    present = [v for v in values if v is not None]
    for how, pick in (("max", max), ("min", min)):
        got = sorted(r[0] for r in rows_at_extreme(df, "v", how).collect())
        want = [i for i, v in enumerate(values) if present and v == pick(present)]
        assert got == want


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-10**8, 10**8))), max_size=40))
def test_exact_sum_and_share_equal_decimal_arithmetic(spark, data):
    df = spark.createDataFrame([(k, None if c is None else c / 100) for k, c in data], "k int, v double")
    got = dict(df.groupBy("k").agg(exact_sum("v").alias("s")).collect())
    want = {}
    for k, c in data:
        want.setdefault(k, None)
        if c is not None:
            want[k] = (want[k] or 0) + c
    assert got == {k: None if s is None else float(Decimal(s) / 100) for k, s in want.items()}
    if data:
        share = df.agg(share_pct(F.col("v") > 0).alias("p")).first()[0]
        hits = sum(1 for _, c in data if c is not None and c > 0)
        assert share == ((20000 * hits + len(data)) // (2 * len(data))) / 100


SAFE_TEXT = st.text(alphabet=st.characters(whitelist_categories=("L", "N"), whitelist_characters=" -_'"), max_size=12)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-10**9, 10**9)), SAFE_TEXT,
                          st.one_of(st.none(), st.integers(-10**6, 10**6).map(lambda c: c / 100))), max_size=20))
def test_delimited_lines_round_trip(spark, data):
    from quarry.sources.delimited import join_fields, split_to_schema

    df = spark.createDataFrame(data, "a bigint, b string, c double")
    lines = df.select(join_fields(["a", "b", "c"], "::").alias("value"))
    back = split_to_schema(lines, "value", "::", "a bigint, b string, c double")
    got = sorted((tuple(r) for r in back.collect()), key=str)
    # strings come back as written ('' stays ''), numbers and nulls exactly
    assert got == sorted(data, key=str)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(-10**12, 10**12), min_size=1, max_size=20))
def test_round_half_up_equals_decimal_rounding(spark, micros):
    from quarry.functions.money import round_half_up

    values = [m / 10**6 for m in micros]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(round_half_up("v").alias("r")).collect()]
    want = [float(Decimal(repr(v)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for v in values]
    assert got == want
