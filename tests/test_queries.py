"""Every registered query of the domain against its oracle."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from ridgecast.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{os.path.join(sf, t)}.parquet'")
    return con


def rows(df):
    def plain(v):
        if pd.isna(v):
            return None
        return v if isinstance(v, (str, bool)) else round(float(v), 6) + 0.0

    return sorted((tuple(plain(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf, name):
    got = QUERIES[name](spark, sf).toPandas()
    if name in ORACLES:
        want = duck.sql(ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_scans_are_pruned(spark, sf):
    p = QUERIES["towers_clean"](spark, sf)
    text = p._jdf.queryExecution().executedPlan().toString()
    assert "s_acctbal" not in text and "s_name" not in text
