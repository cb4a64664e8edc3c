"""Ingestion and reshaping exercises: names, conforming two layouts, union,
enlarging a table, parsing delimited text and dates.

The two "sources" to conform are customers (a flat table, like a CSV file)
and suppliers rendered as nested JSON documents (an object with a nested
record and an array) and parsed back under a declared schema, like a JSON
lines file. Both are derived by Spark from the test tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from quarry.functions.dates import ISO_DAY, MONTH_NAME_DAY, format_date, parse_date
from quarry.functions.text import join_name, part
from quarry.operators.conform import composite_id, conform, unite
from quarry.operators.replicate import midpoint, replicate
from quarry.sources.delimited import join_fields, split_to_schema
from quarry.sources.rows import rows_frame

# The common party schema both sources are conformed to.
PARTY_COLUMNS = ("datasetId", "name", "state", "type", "geoX", "geoY", "dateEnd", "county", "id")
PARTY_TYPES = {"geoX": "double", "geoY": "double", "dateEnd": "string"}

# Rows held by the driver, and their declared schema.
STATUS_ROWS = (("F", "filled"), ("O", "open"), ("P", "in part"), ("X", "withdrawn"))
STATUS_SCHEMA = "status STRING, meaning STRING"

# Declared schema of the nested supplier documents.
SUPPLIER_DOC_SCHEMA = StructType(
    [
        StructField(
            "fields",
            StructType(
                [
                    StructField("id", LongType()),
                    StructField("premise_name", StringType()),
                    StructField("premise_state", StringType()),
                    StructField("type_description", StringType()),
                    StructField("closing_date", StringType()),
                    StructField("geolocation", ArrayType(DoubleType())),
                ]
            ),
        ),
        StructField("recordid", StringType()),
    ]
)

# The delimited line layout of orders and its separator.
ORDER_LINE_SCHEMA = StructType(
    [
        StructField("o_orderkey", LongType()),
        StructField("o_custkey", LongType()),
        StructField("o_orderstatus", StringType()),
        StructField("o_totalprice", DoubleType()),
        StructField("o_orderpriority", StringType()),
    ]
)
ORDER_LINE_SEP = "::"

# Copies made by the enlargement exercise.
COPIES = 61


def full_name(customer: DataFrame) -> DataFrame:
    """(c_custkey, full_name = name + ', ' + nation key); null in gives null out."""
    return customer.select("c_custkey", join_name("c_name", "c_nationkey").alias("full_name"))


def conform_flat(customer: DataFrame) -> DataFrame:
    """Customers renamed into the party schema, with a constant county and a composite id."""
    df = conform(
        customer,
        {
            "datasetId": F.col("c_custkey").cast("string"),
            "name": "c_name",
            "state": F.col("c_nationkey").cast("string"),
            "type": "c_mktsegment",
            "geoX": "c_acctbal",
            "geoY": F.col("c_nationkey"),
            "dateEnd": None,
            "county": F.lit("Customers"),
        },
        PARTY_TYPES,
    )
    return df.withColumn("id", composite_id(["state", "county", "datasetId"]))


def supplier_documents(supplier: DataFrame) -> DataFrame:
    """One JSON text per supplier: ``{"fields": {...,"geolocation": [...]}, "recordid": ...}``.

    Low-balance suppliers get a type without ``" - "`` and negative balances a
    one-element location, so both short cases occur in the data.
    """
    bal, nat = F.col("s_acctbal"), F.col("s_nationkey")
    fields = F.struct(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("premise_name"),
        nat.cast("string").alias("premise_state"),
        F.when(bal < 1000, F.lit("Supplier"))
        .otherwise(F.concat(F.lit("Supplier - "), nat.cast("string")))
        .alias("type_description"),
        F.when(bal < 0, F.array(bal)).otherwise(F.array(bal, nat.cast("double"))).alias("geolocation"),
    )
    return supplier.select(F.to_json(F.struct(fields.alias("fields"), F.col("s_name").alias("recordid"))).alias("value"))


def conform_nested(documents: DataFrame) -> DataFrame:
    """Nested JSON documents parsed under a declared schema and flattened to the party schema."""
    parsed = documents.select(F.from_json("value", SUPPLIER_DOC_SCHEMA).alias("doc")).select("doc.*")
    return flatten_suppliers(parsed)


def flatten_suppliers(parsed: DataFrame) -> DataFrame:
    """Parsed supplier documents (``fields`` struct, ``recordid``) to the party schema."""
    df = conform(
        parsed,
        {
            "datasetId": F.col("fields.id").cast("string"),
            "name": "fields.premise_name",
            "state": "fields.premise_state",
            "type": part("fields.type_description", " - ", 1),
            "geoX": F.get(F.col("fields.geolocation"), 0),
            "geoY": F.get(F.col("fields.geolocation"), 1),
            "dateEnd": "fields.closing_date",
            "county": F.lit("Suppliers"),
        },
        PARTY_TYPES,
    )
    return df.withColumn("id", composite_id(["state", "county", "datasetId"]))


def party_union(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    return unite([conform_flat(customer), conform_nested(supplier_documents(supplier))])


def replicate_midpoint(supplier: DataFrame, copies: int = COPIES, mode: str = "col") -> DataFrame:
    """Suppliers ``copies`` times with lower/upper bounds, their midpoint and copies of both."""
    base = supplier.select(
        "s_suppkey",
        "s_name",
        F.col("s_acctbal").alias("lcl"),
        (F.col("s_acctbal") + F.col("s_nationkey")).alias("ucl"),
    )
    return midpoint(replicate(base, copies), "lcl", "ucl", mode)


def self_union(nation: DataFrame, mode: str = "col") -> DataFrame:
    """Nations twice (union by position, duplicates kept) with the midpoint columns."""
    base = nation.select(
        "n_nationkey",
        "n_name",
        F.col("n_regionkey").cast("double").alias("lcl"),
        F.col("n_nationkey").cast("double").alias("ucl"),
    )
    return midpoint(base.union(base), "lcl", "ucl", mode)


def parse_delimited(orders: DataFrame) -> DataFrame:
    """Orders rendered as ``a::b::c`` lines and parsed back under the declared schema."""
    lines = orders.select(join_fields([f.name for f in ORDER_LINE_SCHEMA.fields], ORDER_LINE_SEP).alias("value"))
    return split_to_schema(lines, "value", ORDER_LINE_SEP, ORDER_LINE_SCHEMA)


def parse_dates(orders: DataFrame) -> DataFrame:
    """Order days written in two layouts and parsed back; both must give the same date."""
    texts = orders.select(
        "o_orderkey",
        format_date("o_orderdate", ISO_DAY).alias("iso_text"),
        format_date("o_orderdate", MONTH_NAME_DAY).alias("named_text"),
    )
    return texts.select(
        "o_orderkey",
        parse_date("iso_text", ISO_DAY, strict=True).alias("iso_date"),
        parse_date("named_text", MONTH_NAME_DAY).alias("named_date"),
    )


def timed_steps(spark, data_dir: str, copies: int = COPIES, mode: str = "col") -> dict[str, float]:
    """Milliseconds spent in each step of the laziness exercise.

    Loading, enlarging, renaming and transforming only build a plan; the
    action (a ``noop`` write, which runs the whole plan without collecting it)
    is where the work happens. Returns ``{"load", "build", "clean",
    "transform", "action"}``.
    """
    import time

    from quarry.sources.tables import table

    marks = [time.perf_counter()]
    df = table(spark, data_dir, "supplier")
    marks.append(time.perf_counter())
    df = replicate(df, copies)
    marks.append(time.perf_counter())
    df = df.withColumnsRenamed({"s_acctbal": "lcl"}).withColumn("ucl", F.col("lcl") + F.col("s_nationkey"))
    marks.append(time.perf_counter())
    df = midpoint(df, "lcl", "ucl", mode)
    marks.append(time.perf_counter())
    df.write.format("noop").mode("overwrite").save()
    marks.append(time.perf_counter())
    steps = ["load", "build", "clean", "transform", "action"]
    return {s: round((b - a) * 1000, 3) for s, a, b in zip(steps, marks, marks[1:])}


def orders_by_status(orders: DataFrame, late_rows: list | tuple = ()) -> DataFrame:
    """(status, meaning, orders): driver rows as a table under a declared schema, with the number of orders of each; 0 where none.

    Orders are counted first, so a status with most of them is a row per task. ``late_rows`` may add to the list; an empty one
    is an empty table of the same schema.
    """
    spark = orders.sparkSession
    names = rows_frame(spark, STATUS_ROWS, STATUS_SCHEMA).union(rows_frame(spark, late_rows, STATUS_SCHEMA))
    counts = orders.groupBy(F.col("o_orderstatus").alias("__status")).agg(F.count(F.lit(1)).alias("__n"))
    return names.join(counts, F.col("status") == F.col("__status"), "left").select("status", "meaning", F.coalesce("__n", F.lit(0)).cast("long").alias("orders"))
