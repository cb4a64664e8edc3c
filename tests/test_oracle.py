"""Every registered question against its DuckDB SQL on the smallest test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMOKE_DIR
from quarry.plans.catalog import QUERIES
from quarry.sources.tables import TABLES

SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
    "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    yield con
    con.close()


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        if isinstance(v, list):
            return tuple(v)
        return v

    out = [tuple(norm(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_question_has_oracle_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SMOKE_DIR)
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    dtypes = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()}
    for f in df.schema:
        assert SPARK_TO_DUCK[f.dataType.simpleString()] == dtypes[f.name], (f.name, f.dataType, dtypes[f.name])
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(dcols, drows)


def test_entry_runs_with_stable_schema(spark):
    a = entry.entry(spark)
    b = entry.entry(spark)
    assert a.schema == b.schema
    assert a.count() == 100
