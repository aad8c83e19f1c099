"""Every catalog query against its DuckDB statement on the sf0.001 tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as E
from riskmart.plans import catalog

KEYS = sorted(catalog.QUERIES)
ORACLE = catalog.ORACLE
TABLES = ["nation", "events", "region"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{Path(sf_small) / (t + '.parquet')}')")
    return con


def test_every_key_has_sql():
    assert set(ORACLE) == set(KEYS), set(KEYS) ^ set(ORACLE)
    assert set(KEYS) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_small, duck, key):
    sdf = E.queries()[key](spark, sf_small)
    s_cols, s_rows = sdf.columns, [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLE[key])
    d_cols, d_rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _canon(s_cols, s_rows) == _canon(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["DTE_EVENT", "NAM_COUNTRY", "NAM_CITY", "CNT_EVENTS", "NUM_GOLDSTEIN_AVG",
                          "NUM_RISK_SCORE", "DTE_INGESTION"]
    assert df.count() > 0
