"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from scripts.check_oracles import TABLES, canon  # noqa: E402

SF = "/root/testdata/sf0.001"
KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_registered():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 55


def test_entry(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"class", "cells", "points"}
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    got = E.queries()[key](spark, SF).toPandas()
    exp = con.execute(E.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert canon(got) == canon(exp)
