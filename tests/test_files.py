"""Files, runs and streams."""

from __future__ import annotations

import io
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.plans import runner
from quarry.sources import files, ply
from quarry.streaming import placement


def cloud(n=17):
    rng = np.random.default_rng(3)
    return pd.DataFrame({c: rng.normal(size=n) for c in ply.FLOATS} | {"layer": np.arange(n) % 3, "origin_stage": 4, "ord": np.arange(n)})


def test_ply_round_trip(spark, tmp_path):
    frame = cloud()
    df = spark.createDataFrame(frame).repartition(3)
    ply.write_ply(df, f"{tmp_path}/a.ply")
    assert (tmp_path / "a.ply").stat().st_size == len(ply.header(17)) + 17 * 70
    back = ply.read_ply(spark, f"{tmp_path}/a.ply").orderBy("ord").toPandas()
    assert np.allclose(back["x"], frame["x"], atol=1e-6) and (back["layer"] == frame["layer"]).all() and (back["rot_0"] >= 0).all()
    ply.write_ply(df, f"{tmp_path}/std.ply", standard=True)
    assert ply.read_ply(spark, f"{tmp_path}/std.ply").count() == 17


def test_ply_refuses_what_is_not_it():
    with pytest.raises(ValueError, match="header"):
        ply.decode(b"ply\nformat ascii 1.0\nend_header\n")
    with pytest.raises(ValueError, match="size"):
        ply.decode(ply.header(2) + b"x")
    rows = {c: cloud()[c].to_numpy(copy=True) for c in (*ply.FLOATS, *ply.BYTES)}
    rows["x"][0] = np.nan
    with pytest.raises(ValueError, match="finite"):
        ply.encode(rows)


def test_npy_round_trip(spark, tmp_path):
    a = np.arange(12, dtype=np.float32).reshape(3, 4)
    a[0, 0] = np.inf
    np.save(tmp_path / "d.npy", a)
    px = files.read_npy(spark, f"{tmp_path}/d.npy")
    assert px.count() == 12 and px.where("r = 0 and c = 0").first()["d"] == float("inf")
    content = files.to_npy(px, "name").first()["content"]
    assert np.array_equal(np.load(io.BytesIO(bytes(content))), a)


def test_sidecars_and_documents(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"source": "a", "license_id": "CC0", "camera_height_m": 1.6}')
    side = files.read_documents(spark, f"{tmp_path}/s.json", files.SIDECAR)
    src = spark.createDataFrame([("a",), ("b",)], "source string")
    assert [r["source"] for r in files.sources_without_sidecar(src, side).collect()] == ["b"]
    pins = spark.createDataFrame([("s.json", "0" * 64), ("gone", "0" * 64)], "name string, sha256 string")
    assert files.verified_files(spark, f"{tmp_path}/*.json", pins).where("ok").count() == 0


def test_runs_chain_and_compare(spark, tmp_path):
    def twice(tables, params):
        return {"b": tables["a"].select((F.col("v") * params["k"]).alias("v"))}

    stages = [runner.Stage("twice", ("a",), twice), runner.Stage("sum", ("b",), lambda t, p: {"c": t["b"].agg(F.sum("v").alias("s"))})]
    src = {"a": spark.range(10).withColumnRenamed("id", "v")}
    x, y = (runner.run(spark, stages, src, {"k": k}, f"{tmp_path}/{k}") for k in (2, 3))
    again = runner.run(spark, stages, {"a": src["a"].repartition(4)}, {"k": 2}, f"{tmp_path}/again")
    assert runner.manifest_hash(x) == runner.manifest_hash(again) and not runner.differences(x, again) and not runner.verify(x)
    assert "twice.outputs.b" in runner.differences(x, y)
    x.receipts[1]["inputs"]["b"]["sha256"] = "old"
    assert runner.verify(x) == ["sum: stale b"]
    with pytest.raises(ValueError, match="stale"):
        runner.promote(x, f"{tmp_path}/accepted", True)
    with pytest.raises(ValueError, match="gates"):
        runner.promote(again, f"{tmp_path}/accepted", False)
    runner.promote(again, f"{tmp_path}/accepted", True)
    assert spark.read.parquet(f"{tmp_path}/accepted/sum/c").first()["s"] == 90
    runner.promote(y, f"{tmp_path}/accepted", False, force=True)  # another whole run takes its place, and says that it was forced
    assert spark.read.parquet(f"{tmp_path}/accepted/sum/c").first()["s"] == 135 and json.loads((tmp_path / "accepted/promotion.json").read_text())["forced"]
    assert sorted(p.name for p in tmp_path.iterdir() if p.name.startswith("accepted")) == ["accepted"]
    kept = runner.load(spark, stages, f"{tmp_path}/2")
    assert runner.manifest_hash(kept) == runner.manifest_hash(again) and kept.receipts[0]["code"].keys() == {"git_sha", "dirty"}
    last = runner.run(spark, stages, src, {"k": 2}, f"{tmp_path}/2", only=("sum",))  # just the last stage, on the first one's tables
    assert last.receipts[0] == kept.receipts[0] and last.tables["c"].first()["s"] == 90 and not runner.verify(last)
    with pytest.raises(KeyError, match="no receipt"):
        runner.load(spark, stages, f"{tmp_path}/nowhere")
    with pytest.raises(KeyError):
        runner.run(spark, [stages[1]], src, {}, f"{tmp_path}/none")


def test_streamed_placement_equals_batch(spark, tmp_path):
    r, c = np.divmod(np.arange(128), 16)
    px = spark.createDataFrame(pd.DataFrame({"pano": "p", "r": r, "c": c, "h": 8, "w": 16, "d": 1.0 + np.arange(128), "sky": False})).selectExpr("pano", "r", "c", "cast(h as bigint) h", "cast(w as bigint) w", "d", "sky")
    px.repartition(2).write.parquet(f"{tmp_path}/in")
    q = placement.start(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ckpt")
    q.awaitTermination(60)
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.exceptAll(placement.positions(px)).count() == 0 and got.count() == 50
