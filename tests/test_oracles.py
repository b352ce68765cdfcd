"""Every registered query against its DuckDB oracle on sf0.001."""

import decimal

import duckdb
import pytest

import __spark_entry__ as ent
from basketry.registry import QUERIES
from conftest import SF_SMALL

TABLES = ["orders", "lineitem", "customer", "part", "nation", "region", "supplier"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


# the document queries have tests of their own
ORACLES = {k: v for k, v in ent.oracle_sql().items() if k in QUERIES}
SPARK_TO_DUCK = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "int": "INTEGER"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    df = ent.queries()[name](spark, SF_SMALL)
    cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[name])
    d_cols, d_types = rel.columns, [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    assert sorted(cols) == sorted(d_cols)
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in df.schema.fields}
    assert s_types == dict(zip(d_cols, d_types))
    order = sorted(cols)
    s = sorted((tuple(_norm(r[cols.index(c)]) for c in order) for r in s_rows), key=repr)
    d = sorted((tuple(_norm(r[d_cols.index(c)]) for c in order) for r in d_rows), key=repr)
    assert s == d


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(ent.queries())


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.count() == 1500
    assert "order_segmentation" in df.columns
