"""Queries against their SQL on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from quarry.llm import license_scan, registry
from quarry.llm.license_texts import TEMPLATES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    df = registry.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    want = con.sql(f"select {', '.join(cols)} from ({registry.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, map(tuple, df.select(*cols).collect()))) == sorted(map(repr, want))


def test_one_query_for_each_operator():
    assert {n.split("_")[0] for n in registry.QUERIES} == {f"op{i}" for i in range(1, 11)}


def test_license_lines_beside_notices(spark):
    """Each short line after each long notice, at every offset of 32 words, against the SQL."""
    lines, notices = [k for k in TEMPLATES if k.endswith(" line")], [k for k in TEMPLATES if not k.endswith(" line")]
    rows = [(n, "x " * i + f"{TEMPLATES[b]} {TEMPLATES[a]}") for n, (b, a, i) in enumerate((b, a, i) for b in notices for a in lines for i in range(32))]
    con = duckdb.connect()
    con.sql("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    cols = ["doc_id", "template", "n_shingles", "n_matched", "containment", "first_word", "last_word"]
    want = con.sql(f"select {', '.join(cols)} from ({registry.oracle_sql()['op1_license_scan']})").fetchall()
    got = license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).select(*cols).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert {(n, lines[n // 32 % len(lines)]) for n, _ in rows} <= {(r["doc_id"], r["template"]) for r in got}
