"""Every registered query equals its DuckDB oracle on the sf0.001 tables
(row count, column names, order-insensitive values)."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans.queries import all_queries
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
OWN = set(all_queries())                                  # the training-data queries have tests of their own
QUERIES = {k: v for k, v in E.queries().items() if k in OWN}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in OWN}


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, repr(x)) for x in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_parity(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    srows = sorted((tuple(_norm(x) for x in r) for r in df.collect()), key=_key)
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    order = [dcols.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in order) for r in cur.fetchall()), key=_key)
    assert len(srows) == len(drows)
    assert srows == drows


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:5] == ["year_month", "yr", "mon", "group_name", "priority_label"]
    assert df.count() > 0
