"""Every registered query against its DuckDB oracle on the smallest tables."""
import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from pluvio.plans.catalog import QUERIES
from small_tables import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    sql = E.oracle_sql().get(name)
    if sql is None:
        return
    cur = con.execute(sql)
    ocols = [d[0].lower() for d in cur.description]
    assert sorted(ocols) == sorted(c.lower() for c in cols)
    idx = {c: i for i, c in enumerate(ocols)}
    want = sorted((tuple(_norm(r[idx[c.lower()]]) for c in cols) for r in cur.fetchall()), key=repr)
    assert got == want


SQL_TYPES = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE",
             "StringType": "VARCHAR", "BooleanType": "BOOLEAN", "DateType": "DATE",
             "TimestampNTZType": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_types_match_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = {f.name.lower(): SQL_TYPES.get(type(f.dataType).__name__, str(f.dataType))
           for f in df.schema.fields}
    rel = con.sql(E.oracle_sql()[name])
    want = {c.lower(): str(t) for c, t in zip(rel.columns, rel.types)}
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "evento" in df.columns
