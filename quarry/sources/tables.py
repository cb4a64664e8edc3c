"""Parquet tables of a data directory (one ``<name>.parquet`` per table).

Each table is read under its declared schema. Without one, every
``spark.read.parquet`` runs a job to read file footers before the query is
even planned (one per table per query; at scale, over many files).

Every call lists the files anew, so files that arrived since the last call are read.
A job that asks many questions of one table keeps the DataFrame, as ``plans.run.Shared`` does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The table names of a data directory and their schemas.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}
TABLES = tuple(SCHEMAS)


def table(spark: SparkSession, data_dir: str, name: str, declared: bool = True) -> DataFrame:
    """Lazy scan; Catalyst prunes columns and pushes filters into the reader.

    ``declared=False`` infers the schema from the files instead.
    """
    if name not in SCHEMAS:
        raise KeyError(f"unknown table {name!r}")
    reader = spark.read.schema(SCHEMAS[name]) if declared else spark.read
    return reader.parquet(f"{str(data_dir).rstrip('/')}/{name}.parquet")
