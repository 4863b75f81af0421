"""A whole run on a planted room, and the small files at its end."""

from __future__ import annotations

import io
import zipfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.functions import geometry as g
from quarry.operators import faces, judge, metrics
from quarry.params import DEFAULTS, with_overrides
from quarry.plans import gates, runner, stages
from quarry.sources import report


BOXES = "face int, yaw double, pitch double, fov double, x0 double, y0 double, x1 double, y1 double, score double, label string"
PARAMS = with_overrides(DEFAULTS, {"s2.guided_radius": 1, "s2.sky_grad_max": 0.0, "s6.cap": 5000, "s7.render_px": 24, "s0.dilate_px": 1})


def room(spark, boxes=(), edited=None):
    """The sources of a run: a closed room of stripes, seen by three faces."""
    h, w = 24, 48
    r, c = np.divmod(np.arange(h * w), w)
    lat, lon = np.pi / 2 - (r + 0.5) / h * np.pi, (c + 0.5) / w * 2 * np.pi - np.pi
    d = np.stack([np.cos(lat) * np.sin(lon), np.sin(lat), np.cos(lat) * np.cos(lon)], 1)
    box = np.array([12.0, 8.0, 16.0])
    floor = np.where(d[:, 1] < 0, 1.6 / np.maximum(-d[:, 1], 1e-9), np.inf)
    depth = np.minimum(np.min(box / np.maximum(np.abs(d), 1e-9), axis=1), floor)
    pixel = pd.DataFrame({"r": r, "c": c, "h": h, "w": w, "red": 100 + r, "grn": 80, "blu": 60})
    rows = pd.concat([pd.DataFrame({"r": r, "c": c, "face": f, "x": (np.log(depth) - 0.1 * f) / (1 + 0.1 * f), "wt": 1.0}) for f in range(3)])
    plain = [(0, 0.0, 0.0, 90.0, 10.0, 10.0, 50.0, 50.0, 0.2, "person"), (0, 0.0, 0.0, 90.0, 10.0, 10.0, 50.0, 50.0, 0.9, "chair")]
    names = [v["view"] for v in judge.head_views(spark).select("view").collect()]
    return {
        "pixel": spark.createDataFrame(pixel), "depth": spark.createDataFrame(rows), "detection": spark.createDataFrame([*plain, *boxes], BOXES), "clean_detection": spark.createDataFrame([], BOXES),
        "edited": spark.createDataFrame([] if edited is None else edited(pixel)[["r", "c", "red", "grn", "blu"]].values.tolist(), "r long, c long, red long, grn long, blu long"),
        "packed": spark.createDataFrame([("quest", 1 << 20), ("review", 1 << 21)], "profile string, sog_bytes long"), "people": spark.createDataFrame([(n, 0.1) for n in names], "view string, score double"),
    }


def test_run_of_a_room(spark, tmp_path):
    sources = room(spark)
    done = runner.run(spark, stages.STAGES, sources, PARAMS, f"{tmp_path}/run")
    assert [x["stage"] for x in done.receipts] == [s.name for s in stages.STAGES] and not runner.verify(done)
    verdicts = {v["gate"]: v for v in done.tables["gates"].collect()}
    assert set(verdicts) == set(gates.GATES) and done.tables["summary"].first()["total"] == 13
    assert all(verdicts[k]["pass"] for k in ("watermark", "cleanplate_detector", "cleanplate_containment", "budgets", "people", "jitter")) and verdicts["interface_step"]["metrics"]["step_log"] < 0.01
    assert verdicts["ground_plane"]["metrics"]["tilt_deg"] < 10
    assert {r["view"] for r in done.tables["hole_views"].collect()} == {r["view"] for r in sources["people"].collect()} and done.tables["fidelity_tiles"].count() == 32
    assert done.tables["stereo_views"].count() == 6 and done.tables["stereo_views"].where("min_depth_m < 1e9").count() > 0
    assert 0 < done.tables["splats"].count() <= 5000 and done.tables["splats"].where("layer = 2").count() == 0
    assert {r["profile"] for r in done.tables["profiles"].collect()} == {"quest", "review"} and done.tables["sky_measure"].first()["sky_fraction"] == 0.0
    page = report.page("room", [v.asDict() for v in verdicts.values()], {"a": report.png(np.zeros((2, 3), bool))})
    assert page.count("<tr>") == 14 and "data:image/png;base64," in page
    assert g.PIXEL in "(pi() / h)"
    # another driver reads it
    again = runner.load(spark, stages.STAGES, f"{tmp_path}/run")
    assert runner.manifest_hash(again) == runner.manifest_hash(done)
    same = runner.versus_accepted(done.tables["gates"], again.tables["gates"].where("gate <> 'watermark'"))
    assert same.where("value = accepted").count() == same.where("gate <> 'watermark' and value is not null").count() and same.where("gate = 'watermark' and accepted is null").count() == 1


def test_a_cloud_without_its_packed_size_fails(spark):
    sized = spark.sql("select 10L as final_count, cast(null as long) as sog_bytes union all select 10L, 1000L union all select 10L, 1099511627776L")
    assert [r["pass"] for r in gates.verdict(sized, "budgets").collect()] == [False, True, False]


def test_plates(spark):
    person = (0, 0.0, 0.0, 90.0, 280.0, 280.0, 360.0, 360.0, 0.9, "person")

    def plate(edited=None, found=()):
        t = room(spark, [person], edited) | {"clean_detection": spark.createDataFrame(list(found), BOXES)}
        t |= stages.ingest(t, PARAMS)
        out = stages.clean_plate(t, PARAMS)
        return {r["gate"]: r["pass"] for r in out["plate_gates"].collect()}, out["clean"], t["ingested"]

    with pytest.raises(stages.PlateNeeded):
        plate()
    inside = lambda px: px.assign(blu=np.where((px["r"] == 12) & (px["c"] == 24), 200, px["blu"]))
    verdicts, clean, marked = plate(inside)
    assert verdicts == {"cleanplate_detector": True, "cleanplate_containment": True} and clean.where("blu = 200").count() == 1 and marked.where("person").count() > 0
    assert plate(inside, [person])[0] == {"cleanplate_detector": False, "cleanplate_containment": True}
    assert plate(lambda px: px.assign(blu=np.where(px["r"] == 0, 200, px["blu"])))[0] == {"cleanplate_detector": True, "cleanplate_containment": False}


def test_pixels_without_a_face(spark):
    """The fallback weight counts only where no other does; a pixel that no face covers is an error, not a gap."""
    rows = [(0, 0, 0, 1.0, 0.5, 0.1), (0, 0, 1, 3.0, 0.5, 0.9), (0, 1, 0, 1.0, 0.0, 0.75), (0, 1, 1, 3.0, 0.0, 0.25), (0, 2, 0, 1.0, 0.0, 0.0)]
    depth = spark.createDataFrame(rows, "r long, c long, face long, value double, wt double, fallback double")
    assert {r["c"]: r["ld"] for r in faces.fused_rows(depth).collect()} == {0: 2.0, 1: 1.5, 2: None}
    t = room(spark)
    with pytest.raises(ValueError, match="no face covers"):
        stages.fuse({"clean": t["pixel"], "depth": t["depth"].where("c > 0")}, PARAMS)


def sphere(spark, keep=lambda d: np.ones(len(d), bool), radius=4.0, n=2500):
    """Splats all around, large enough to close the sphere."""
    i = np.arange(n)
    y, turn = 1 - 2 * (i + 0.5) / n, i * np.pi * (3 - 5**0.5)
    d = np.stack([np.cos(turn) * np.sqrt(1 - y * y), y, np.sin(turn) * np.sqrt(1 - y * y)], 1)
    frame = pd.DataFrame({"ord": i, **{a: radius * d[:, k] for k, a in enumerate("xyz")}, "f_dc_0": 1.5 * np.sign(np.sin(4 * np.arctan2(d[:, 0], d[:, 2]))), "f_dc_1": 1.5 * np.sign(np.sin(15 * y)), "f_dc_2": -1.0, "opacity": 6.0, **{f"scale_{k}": np.log(0.25) for k in range(3)}, "rot_0": 1.0, "rot_1": 0.0, "rot_2": 0.0, "rot_3": 0.0, "layer": 0})
    return spark.createDataFrame(frame[keep(d)])


def test_holes_of_closed_and_open_clouds(spark):
    p = PARAMS["s7"]
    views = judge.views_of(spark, judge.level_and_down("center", (0.0, 0.0, 0.0)), p)
    closed = judge.holes(sphere(spark), views).collect()
    assert len(closed) == 5 and all(r["magenta"] == 0 and r["alpha"] == 0 and r["blob_px"] == 0 for r in closed)
    wedge = {r["view"]: r for r in judge.holes(sphere(spark, lambda d: ~((d[:, 2] > 0.8) & (np.abs(d[:, 0]) < 0.4))), views).collect()}
    assert wedge["center_yaw000"]["alpha"] > 0.01 and wedge["center_yaw000"]["blob_px"] > 0 and wedge["center_yaw180"]["alpha"] == 0
    shell = {r["view"]: r for r in judge.holes(sphere(spark).withColumn("layer", F.when(F.col("z") > 3.0, 2).otherwise(0)), views).collect()}
    assert shell["center_yaw000"]["magenta"] > 0.1 and shell["center_yaw180"]["magenta"] == 0
    nothing = judge.holes(sphere(spark).limit(0), views).collect()
    assert len(nothing) == 5 and all(r["alpha"] == 1 for r in nothing)


def test_jitter_and_stereo(spark):
    p = PARAMS["s7"]
    far, near = sphere(spark), sphere(spark, radius=0.5)
    assert judge.jitter(far, p).agg(F.max("energy")).first()[0] < 0.01 and judge.jitter(far, p | {"jitter_m": 2.0}).agg(F.max("energy")).first()[0] > 0.02
    good = {r["view"]: r for r in judge.stereo(far, p).collect()}
    assert len(good) == 6 and all(r["min_depth_m"] > 2 for r in good.values()) and all(abs(r["vdisp_px"]) < 0.5 and r["order"] > 0.9 for v, r in good.items() if v.startswith("yaw"))
    assert good["pole+90"]["vdisp_px"] is None and good["pole-90"]["order"] is None
    assert max(r["min_depth_m"] for r in judge.stereo(near, p).collect()) < 0.75
    costs = lambda *v: spark.range(1).select(judge.shift_of(F.create_map(*[F.lit(x) for i, c in enumerate(v) for x in (i - 2, c)])).alias("s")).first()["s"]
    assert costs(1.0, 1.0, 1.0, 1.0, 1.0) == 0 and costs(5.0, 4.0, 2.0, 0.0, 2.0) == 1 and abs(costs(4.0, 2.0, 0.0, 1.0, 4.0) - metrics.disparity({-2: 4.0, -1: 2.0, 0: 0.0, 1: 1.0, 2: 4.0})) < 1e-12


def test_missing_verdicts_do_not_ship(spark):
    good = gates.verdict(spark.createDataFrame([(0,)], "hits long"), "cleanplate_detector")
    out = stages.manifest({n: good for n in stages.GATE_TABLES}, DEFAULTS)
    assert not out["summary"].first()["shippable"]


def test_small_files():
    image = np.arange(24, dtype=np.uint8).reshape(2, 4, 3)
    assert report.png(image) == report.png(image.copy()) and report.png(image)[:4] == b"\x89PNG"
    a, b = report.archive({"b": b"2", "a": b"1"}), report.archive({"a": b"1", "b": b"2"})
    assert a == b and zipfile.ZipFile(io.BytesIO(a)).namelist() == ["a", "b"]
    assert report.text_table([{"x": 1.5, "y": None}], ["x", "y"]) == "x       y\n1.5000  -\n"
