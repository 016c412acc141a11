"""Every catalogue query with an oracle equals its DuckDB SQL on sf0.001."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from faultline.sources.adapters import TABLES
from tests_support import SF_SMALL

_SQL = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(_SQL))
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(_SQL[name])
    idx = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    assert cols == sorted(rel.columns)
    exp = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == exp


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count() and "label_4h" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())
