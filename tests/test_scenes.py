"""Operators on planted scenes with known answers."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.functions import geometry as g
from quarry.functions.canonical import canonical_json, number_or_text
from quarry.operators import layers, metrics, place, prune, raster, render, stats
from quarry.params import DEFAULTS, params_hash, with_overrides
from quarry.plans import gates, provenance, sweep


def raster_of(spark, h, w, **values):
    r, c = np.divmod(np.arange(h * w), w)
    frame = pd.DataFrame({"r": r, "c": c, "h": h, "w": w} | {k: np.asarray(v(r, c) if callable(v) else np.broadcast_to(v, h * w)) for k, v in values.items()})
    return spark.createDataFrame(frame)


def test_directions_and_back(spark):
    px = raster_of(spark, 8, 16)
    u, v = g.to_uv("dx", "dy", "dz")
    off = g.with_directions(px).select((F.abs(F.expr(u) - F.col("c")) + F.abs(F.expr(v) - F.col("r"))).alias("e")).agg(F.max("e")).first()[0]
    assert off < 1e-9


def test_rings_tiles_and_tapers():
    assert len(g.ring_adjacency()) == 24 and (7, 0) in g.ring_adjacency()
    starts = g.tile_starts(1000, 518, 64)
    assert starts[0] == 0 and starts[-1] == 482 and all(b - a <= 518 for a, b in zip(starts, starts[1:], strict=False))
    assert g.taper(4) == [1.0, 2.0, 2.0, 1.0] and len(g.tile_views()) == 32 and len(g.head_poses()) == 7


def slabs(spark):
    def depth(r, c):
        d = np.full(len(r), np.inf)
        d = np.where((r >= 12) & (r < 60), 10.0, d)
        d = np.where((r >= 12) & (r < 60) & (c >= 60) & (c <= 120), 2.0, d)
        d = np.where((r >= 12) & (r < 60) & (c >= 160) & (c <= 200), 13.8, d)
        d = np.where((r >= 82) & (r < 116), 200.0, d)
        return np.where((r >= 82) & (r < 116) & (c >= 60) & (c <= 120), 600.0, d)

    return raster_of(spark, 128, 256, d=depth).withColumn("sky", ~F.expr(g.finite("d")))


def test_occlusion_edges_of_slabs(spark):
    px = layers.visible_edges(layers.occlusion_edges(slabs(spark))).persist()
    assert px.where("edge").count() == 2 * 48 + 2 * 34
    assert px.where("visible").count() == 96
    assert layers.band_pixels(px) == math.ceil(0.4 / (math.pi / 128)) + 2 == 19
    band = layers.background_band(px, 19)
    assert band.where("band and sky").count() == 0 and band.where("visible and not band").count() == 0


@pytest.mark.parametrize(("depth", "content", "shell"), [(20.0, 8192, 0), (100.0, 0, 8192), (3.0, 8192, 0)])
def test_spheres_route_whole(spark, depth, content, shell):
    px = place.routed(raster_of(spark, 64, 128, d=depth, sky=False))
    assert (px.where("content").count(), px.where("shell").count()) == (content, shell)


def test_strides_and_placement(spark):
    assert place.strides(DEFAULTS["s4"]) == {"edge": 1, "ground": 1, "base": 2, "bg": 2, "shell": 4}
    px = raster_of(spark, 32, 64, d=20.0, sky=False, red=lambda r, c: (r + c) % 2 * 255, grn=0, blu=0).persist()
    out = place.place(px).persist()
    assert out.where("layer <> 0").count() == 0
    far = out.select(F.abs(F.expr("sqrt(x * x + y * y + z * z)") - 20).alias("e"), F.abs(F.expr("rot_0 * rot_0 + rot_1 * rot_1 + rot_2 * rot_2 + rot_3 * rot_3") - 1).alias("q")).agg(F.max("e"), F.max("q")).first()
    assert far[0] < 1e-9 and far[1] < 1e-9
    assert place.place(px, multiplier=2.0).count() < out.count() / 2
    flat = place.thinned(px.withColumn("variance", F.lit(0.0))).agg(F.avg(F.col("keep").cast("int"))).first()[0]
    assert 0.3 < flat < 0.37


def test_isolation_merge_and_floor(spark):
    i = np.arange(1900)
    s = math.log(0.05)
    base = {"opacity": 4.0, "scale_0": s, "scale_1": s, "scale_2": s}
    rows = [dict(base, x=float(a % 44) * 0.05, y=float(a // 44) * 0.05, z=0.0, layer=0) for a in i.tolist()]
    rows += [dict(base, x=0.5 + 0.01 * a, y=0.5, z=0.0, layer=0, opacity=-6.0) for a in range(30)]
    rows += [dict(base, x=60.0 + 10 * a, y=60.0, z=60.0, layer=0) for a in range(5)]
    rows += [dict(base, x=float(a % 40) * 0.05 + 0.001, y=0.05, z=0.0, layer=1) for a in range(40)]
    rows += [dict(base, x=float(a % 10) * 0.05, y=float(a // 10) * 0.05, z=1.0, layer=1) for a in range(60)]
    rows += [dict(base, x=200 * math.cos(a), y=0.0, z=200 * math.sin(a), layer=2) for a in range(50)]
    df = spark.createDataFrame(pd.DataFrame(rows)).withColumn("ord", F.monotonically_increasing_id()).persist()
    floored = prune.opacity_floor(df)
    assert floored.count() == 2055
    kept = prune.isolation_prune(floored)
    assert kept.count() == 2050
    assert prune.merge_duplicates(kept).count() == 2010
    assert prune.isolation_prune(df.limit(1)).count() == 1 and prune.merge_duplicates(df.where("layer = 1")).count() == 100
    out, tries = prune.fit_cap(lambda m: df.where(F.col("ord") % max(1, round(m)) == 0), 500)
    assert out.count() <= 500 or len(tries) == 7
    assert [t["multiplier"] for t in tries] == [1.5**k for k in range(len(tries))]


def test_plane_with_outliers(spark):
    rng = np.random.default_rng(1)
    x, z = rng.uniform(-5, 5, (2, 4000))
    y = 0.05 * x - 0.03 * z - 1.7 + rng.normal(0, 0.005, 4000)
    y[:800] += rng.uniform(0.5, 3, 800)
    coef, points = stats.ground_plane(spark.createDataFrame(pd.DataFrame({"x": x, "y": y, "z": z})))
    assert np.allclose(coef, (0.05, -0.03, -1.7), atol=2e-3)
    assert points.where("inlier").count() >= 0.9 * 3200
    assert abs(stats.plane_measures((0.0, math.tan(math.radians(20)), -1.0))["tilt_deg"] - 20) < 1e-9


def test_faces_align_up_to_one_gauge(spark):
    a, b = np.array([1, 1.3, 0.8, 1.1, 0.9, 1.2]), np.array([0, 0.4, -0.3, 0.2, -0.5, 0.1])
    truth = np.sin(np.arange(400) * 0.37) + np.arange(400) / 200
    rows = [(i, (i + 1) % 6, float((truth[p] - b[i]) / a[i]), float((truth[p] - b[(i + 1) % 6]) / a[(i + 1) % 6]), 1.0) for i in range(6) for p in range(i * 60, i * 60 + 100)]
    theta, rms = stats.align_faces(spark.createDataFrame(rows, "face_i int, face_j int, xi double, xj double, base double"), 6)
    assert rms < 1e-2 and np.allclose(theta[0], (1, 0), atol=1e-4)
    alone, _ = stats.align_faces(spark.createDataFrame([(0, 1, 0.5, 0.5, 1.0), (0, 1, 0.7, 0.7, 1.0)], "face_i int, face_j int, xi double, xj double, base double"), 3)
    assert np.allclose(alone[2], (1, 0), atol=1e-6)


def test_weighted_percentile_and_empty(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (10.0, 5.0)], "v double, wt double")
    assert stats.weighted_percentile(df, "v", "wt", 0.5).first()[0] == 10.0
    assert stats.weighted_percentile(df.withColumn("wt", F.lit(0.0)), "v", "wt", 0.5).first()[0] == 2.0
    assert stats.weighted_percentile(df.limit(0), "v", "wt", 0.5).first()[0] == 0.0


def test_box_against_loops(spark):
    v = np.sin(0.7 * np.arange(16 * 12)).reshape(12, 16)
    got = raster.box_sum(raster_of(spark, 12, 16, v=v.ravel()), ["v"], 3).toPandas().sort_values(["r", "c"])["sum_v"].to_numpy().reshape(12, 16)
    want = [[sum(v[y, x % 16] for y in range(max(0, r - 3), min(12, r + 4)) for x in range(c - 3, c + 4)) for c in range(16)] for r in range(12)]
    assert np.allclose(got, want)


def test_ssim_of_equal_images_and_blobs(spark):
    px = raster_of(spark, 16, 16, a=lambda r, c: (r * c % 7) / 7.0).withColumn("b", F.col("a"))
    assert metrics.ssim(px, "a", "b").agg(F.min("ssim")).first()[0] == pytest.approx(1)
    assert metrics.largest_blob(raster_of(spark, 8, 8, m=lambda r, c: (r < 3) | ((r == 5) & (c < 2))), "m").first()[0] == 24
    assert metrics.disparity({-2: 4.0, -1: 1.0, 0: 0.0, 1: 1.0, 2: 4.0}) == 0.0 and metrics.disparity({k: 1.0 for k in range(-2, 3)}) == 0.0


def test_render_one_splat_and_two(spark):
    s = math.log(0.5)
    base = dict(y=0.0, nx=0.0, ny=0.0, nz=1.0, opacity=6.0, scale_0=s, scale_1=s, scale_2=s, rot_0=1.0, rot_1=0.0, rot_2=0.0, rot_3=0.0, layer=0)
    white = dict(base, ord=0, x=0.0, z=5.0, f_dc_0=1.7, f_dc_1=1.7, f_dc_2=1.7)
    view = spark.sql("select 'v' as view, 0e0 as px, 0e0 as py, 0e0 as pz, 0e0 as yaw, 0e0 as pitch, 60e0 as fov, 32 as vw, 32 as vh")
    out = render.rendered(spark.createDataFrame(pd.DataFrame([white])), view).toPandas().set_index(["py", "px"])
    assert abs(out.loc[(16, 16), "depth"] - 5) < 0.2 and out.loc[(16, 16), "alpha"] > 0.5 and out.loc[(0, 0), "alpha"] == 0 and np.isinf(out.loc[(0, 0), "depth"])
    red, green = dict(white, ord=1, z=3.0, f_dc_1=-1.7, f_dc_2=-1.7), dict(white, f_dc_0=-1.7, f_dc_2=-1.7)
    both = spark.createDataFrame(pd.DataFrame([green, red]))
    exact = render.rendered(both, view).toPandas().set_index(["py", "px"])
    assert exact.loc[(16, 16), "red"] > 200 and exact.loc[(16, 16), "grn"] < 40 and abs(exact.loc[(16, 16), "depth"] - 3) < 0.5
    loose = render.composited(render.projected(both, view)).toPandas().set_index(["py", "px"])
    both_at = loose.join(exact, rsuffix="_exact")
    assert np.abs(both_at["alpha"] - both_at["alpha_exact"]).max() < 2e-3


def test_push_pull_keeps_what_is_known(spark):
    px = raster_of(spark, 12, 16, v=lambda r, c: (r + c).astype(float), known=lambda r, c: ((r + c) % 3 == 0).astype(float))
    out = layers.push_pull(px, ["v"], "known")
    assert out.where("known = 1 and abs(v - v_fill) > 1e-12").count() == 0 and out.where("v_fill is null").count() == 0
    empty = layers.push_pull(px.withColumn("known", F.lit(0.0)), ["v"], "known")
    assert empty.where("v_fill <> 0").count() == 0


def test_gates_can_fail_and_pass(spark):
    good = spark.sql("select 0.01e0 as edge_density")
    assert gates.verdict(good, "watermark").first()["pass"] and not gates.verdict(spark.sql("select 0.5e0 as edge_density"), "watermark").first()["pass"]
    assert not gates.verdict(spark.sql("select cast(null as double) as near_m"), "min_content_distance").first()["pass"]
    assert gates.verdict(spark.sql("select 0.0e0 as vdisp_px, 1e0 as min_depth_m, 1e0 as `order`"), "stereo").first()["pass"]
    assert not gates.summary(gates.verdict(good, "watermark").limit(0)).first()["shippable"]


def test_provenance_finds_stale_and_missing(spark):
    art = spark.createDataFrame([(1, "output", "a", "h1", 0), (2, "input", "a", "h1", 0), (2, "output", "b", "h2", 1), (3, "input", "b", "old", 0), (3, "input", "c", "h3", 1)], "stage_idx int, kind string, path string, sha string, line int")
    assert {(r["path"], r["fault"]) for r in provenance.incoherent(art).collect()} == {("b", "stale"), ("c", "no producer")}
    bad = spark.createDataFrame([("/abs", "0" * 64), ("a/../b", "0" * 64), ("ok/x", "0" * 64), ("ok", "xyz")], "path string, sha256 string")
    assert provenance.receipt_faults(bad).count() == 3


def test_sweep_ranks_with_ties(spark):
    cells = spark.createDataFrame([(0, 0.5, 0.1), (1, 0.7, 0.2), (2, 0.7, 0.3), (3, 0.7, 0.3)], "idx long, ssim_mean double, ssim_worst double")
    assert [r["idx"] for r in sweep.ranked(cells).orderBy("rank").collect()] == [2, 3, 1, 0]
    assert sweep.grid(spark).count() == 36
    out = sweep.run_sweep(spark, DEFAULTS, lambda p: {"ssim": p["s4"]["scale_multiplier"]}, first=20)
    assert out.count() == 20 and out.where("rank = 1").first()["overrides"]["s4.scale_multiplier"] == 1.15


def test_params_and_canonical_json():
    assert params_hash(DEFAULTS) != params_hash(with_overrides(DEFAULTS, {"s4.base_stride": 3}))
    with pytest.raises(KeyError):
        with_overrides(DEFAULTS, {"s4.nothing": 1})
    assert canonical_json({"b": 1e-07, "a": [True, None]}) == b'{"a":[true,null],"b":1e-07}' and number_or_text(math.inf) == "inf"
    with pytest.raises(ValueError, match="finite"):
        canonical_json({"a": math.nan})


def _cloud(spark, rows):
    return spark.createDataFrame(rows, "ord long, layer int, x double, y double, z double, scale_0 double, scale_1 double, scale_2 double").persist()


def test_merge_duplicates_looks_at_few_pairs(spark, monkeypatch):
    """A radius as large as the cloud made every background splat meet every foreground splat; 20,000 of each were 400 million pairs."""
    rng = np.random.default_rng(5)
    xyz, layer, size = rng.normal(0, 1.25, (40000, 3)), np.arange(40000) % 2, rng.normal(-3, 0.12, 40000)
    cloud = _cloud(spark, pd.DataFrame({"ord": np.arange(40000), "layer": layer, "x": xyz[:, 0], "y": xyz[:, 1], "z": xyz[:, 2], "scale_0": size, "scale_1": size, "scale_2": size}))
    met, frame = [], type(cloud)
    join = frame.join

    def counted(left, right, on=None, how=None):
        if on == ["cx", "cy", "cz"] and how in (None, "left"):
            met.append(join(left, right, on).count())
        return join(left, right, on, how)

    monkeypatch.setattr(frame, "join", counted)
    left = {r["ord"] for r in prune.merge_duplicates(cloud, 40.0).select("ord").collect()}
    front = xyz[layer == 0]
    for i in range(1, 40000, 200):
        d = np.sqrt(((front - xyz[i]) ** 2).sum(1))
        assert (i in left) == (not d.min() < 40.0 * np.exp(size[layer == 0][d.argmin()]))
    assert sum(met) < 64 * 40000


@pytest.mark.parametrize("factor", [0.05, 0.5, 4.0, 40.0])
def test_merge_duplicates_as_all_pairs_do(spark, factor):
    """Copies, clusters, radii over six orders of magnitude, ties and missing values."""
    rng = np.random.default_rng(7)
    xyz = np.concatenate([rng.normal(0, 1, (500, 3)), rng.normal(3, 1e-4, (200, 3)), np.repeat([[1.0, 1.0, 1.0]], 60, 0), rng.integers(-2, 3, (200, 3)).astype(float), rng.uniform(-90, 90, (40, 3))])
    rows = [(i, int(rng.integers(0, 3)), *map(float, p), float(rng.uniform(-9, 4)), -20.0, -20.0) for i, p in enumerate(xyz)]
    rows += [(2000, 0, None, 1.0, 1.0, 3.0, 3.0, 3.0), (2001, 1, float("nan"), 1.0, 1.0, 3.0, 3.0, 3.0), (2002, None, 1.0, 1.0, 1.0, 3.0, 3.0, 3.0), (2003, 0, 5.0, 5.0, 5.0, None, None, None), (2004, 1, 5.0, 5.0, 5.0, 1.0, 1.0, 1.0)]
    gone = set()
    for o, layer, *p in (r[:5] for r in rows):
        if layer == 1 and all(v == v for v in p):
            dist, _, radius = min((math.sqrt(sum((a - b) * (a - b) for a, b in zip(p, q[2:5], strict=True))), q[0], q[5]) for q in rows if q[1] == 0 and q[2] is not None)
            gone |= {o} if radius is not None and dist < factor * math.exp(radius) else set()
    kept = {r["ord"] for r in prune.merge_duplicates(_cloud(spark, rows), factor).collect()}
    assert kept == {r[0] for r in rows} - gone
