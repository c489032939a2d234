"""Every catalogue query on sf0.001 against its DuckDB oracle."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from rateflow.plans.catalog import QUERIES
from rateflow.plans.oracle import ORACLE_SQL
from tests.conftest import SF_SMALL

TABLES = ["part", "lineitem", "orders", "customer"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "user_id", "item_id", "prediction", "rank"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_als():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) - set(ORACLE_SQL) == {"als_predict", "recommend_als"}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    rel = con.sql(ORACLE_SQL[name])
    assert sorted(cols) == sorted(rel.columns)
    order = sorted(cols)
    a = sorted((tuple(_norm(r[c]) for c in order) for r in df.collect()), key=repr)
    oc = rel.columns
    b = sorted((tuple(_norm(r[oc.index(c)]) for c in order) for r in rel.fetchall()), key=repr)
    assert a == b
