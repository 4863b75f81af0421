"""The driver contract: the flagship runs, names match, and queries agree with their SQL."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__
from quarry.plans.registry import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def test_flagship_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_statement_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    want = duck.sql(f"select {', '.join(cols)} from ({ORACLES[name]})").fetchall()
    assert sorted(map(repr, map(tuple, df.select(*cols).collect()))) == sorted(map(repr, want))
