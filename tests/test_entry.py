"""The driver contract, and every closed-form query against its DuckDB
oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tabml.sources import TABLES
from conftest import SF001


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["dataset", "metric", "value"] and len(rows) == 10


def test_oracle_keys_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 40


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    con.execute(f"CREATE OR REPLACE VIEW oracle_{name} AS {E.oracle_sql()[name]}")      # as the driver does
    res = con.execute(f"SELECT * FROM oracle_{name}")
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    want = sorted((tuple(_norm(dict(zip(dcols, r))[c]) for c in cols) for r in res.fetchall()),
                  key=repr)
    assert got == want
