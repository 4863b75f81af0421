"""Queries over the raster agree with their SQL where depths are 0, whose logarithm is infinite."""

from __future__ import annotations

import duckdb
import pytest

from quarry.plans.registry import ORACLES, QUERIES

#: Zeros alone, side by side, in the first and last row and at the seam; 72 pixels are 6 rows of 12.
ZEROS = (0, 11, 12, 30, 31, 43, 66)


@pytest.fixture(scope="module")
def sf_dir(tmp_path_factory):
    path = tmp_path_factory.mktemp("zeros")
    value = f"case when i in {ZEROS} then 0.0 else 1 + (i * 37) % 61 / 4.0 end"
    duckdb.connect().execute(f"copy (select i as event_id, 'view' as event_type, {value}::double as value, '{{\"k\": ' || i % 90 || '}}' as props from range(72) t(i)) to '{path}/events.parquet' (format parquet)")
    return str(path)


@pytest.mark.parametrize("name", ["occlusion_edges", "stride_class", "fwd_diff_edges", "place_fg", "visible_edges", "bg_band", "bg_band_derived", "bg_solid_angle_gate"])
def test_zero_depths_as_in_sql(spark, sf_dir, name):
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{sf_dir}/events.parquet'")
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    want = con.execute(f"select {', '.join(cols)} from ({ORACLES[name]})").fetchall()
    assert want and sorted(map(repr, map(tuple, df.select(*cols).collect()))) == sorted(map(repr, want))


def test_normals_keep_the_sign_of_zero(spark, tmp_path):
    """A column straight to the side, in the first and last row, where directions back round to zero from below."""
    con = duckdb.connect()
    con.execute(f"copy (select i as event_id, 'view' as event_type, (1 + (i * 37) % 61 / 4.0)::double as value, '{{\"k\": ' || i % 90 || '}}' as props from range(50) t(i)) to '{tmp_path}/events.parquet' (format parquet)")
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet'")
    want = con.execute(f"select r, c, nx, ny, nz from ({ORACLES['normals']})").fetchall()
    got = QUERIES["normals"](spark, str(tmp_path)).select("r", "c", "nx", "ny", "nz").collect()
    assert any("-0.0" in map(repr, row) for row in want) and sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
