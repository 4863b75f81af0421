"""The stages of a panorama's way from raster to judged cloud, for ``runner.run``.

Tables in, those of models and tools that run elsewhere among them:

* ``pixel`` (r, c, h, w, red, grn, blu), the source.
* ``detection`` and ``clean_detection`` (face, yaw, pitch, fov, x0..y1, score,
  label): boxes on the source, and on the edited plate (empty if there is none).
* ``edited`` (r, c, red, grn, blu): the plate without people, empty if there is
  none; a source with people needs one.
* ``depth`` (face, r, c, x, wt[, fallback]): log depth as each face has it, its
  feathered weight and the weight that counts where no face has one.
* ``packed`` (profile, sog_bytes): sizes of the packed clouds.
* ``people`` (view, score): the highest score of a person in each rendered view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import geometry as g
from quarry.functions import splats as sp
from quarry.operators import faces, judge, layers, metrics, place, prune, raster, stats
from quarry.plans import gates
from quarry.plans.runner import Stage, Tables


def _verdicts(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def is_person(p: dict):
    return (F.col("label") == "person") & (F.col("score") >= p["score_min"])


def person_mask(px: DataFrame, boxes: DataFrame, p: dict) -> DataFrame:
    """``person``: inside a person's box of some view, and ``person_dilated``, some steps around."""
    views = boxes.select("face", "yaw", "pitch", "fov").distinct()
    parts = boxes.where(is_person(p)).select("face", *[(F.col(f"{a}{i}") / p["view_px"]).alias(f"{b}{i}") for a, b in (("x", "u"), ("y", "v")) for i in (0, 1)])
    hit = faces.in_boxes(px, views, parts).withColumn("person", F.lit(True))
    marked = px.join(hit, ["r", "c"], "left").withColumn("person", F.coalesce("person", F.lit(False)))
    return raster.dilated(marked, "person", p["dilate_px"])


def ingest(t: Tables, params: dict) -> Tables:
    """Checks the raster's shape, measures the nadir's edges, marks people."""
    p, px = params["s0"], t["pixel"]
    if px.where("w <> 2 * h").limit(1).count():
        raise ValueError("a panorama is twice as wide as high")
    edges = metrics.sobel(px.withColumn("gray", F.expr(sp.LUMA)), "gray").where(F.expr(f"{g.PITCH_DEG} < {p['nadir_pitch_deg']}e0"))
    measured = edges.agg(stats.share(F.col("magnitude") > p["edge_magnitude"], 0.0).alias("edge_density"))
    return {"ingested": person_mask(px, t["detection"], p), "ingest_gates": gates.verdict(measured, "watermark")}


class PlateNeeded(RuntimeError):
    """The source shows people: somebody has to edit the plate before the run can go on."""


def clean_plate(t: Tables, params: dict) -> Tables:
    """The plate that the cloud is made of: the source itself if it shows nobody, else the edited one, judged.

    An edit may change only what lies in the dilated mask of people, and a
    detector must find nobody on it.  Without an edited plate the run stops.
    """
    p, px = params["s0"], t["ingested"]
    size = ["r", "c", "h", "w"]
    if not t["detection"].where(is_person(p)).limit(1).count():
        found = px.sparkSession.createDataFrame([(0, 0)], "hits long, outside_px long")
        clean = px.select(*size, "red", "grn", "blu")
    else:
        if not t["edited"].limit(1).count():
            raise PlateNeeded("the source shows people: provide the edited plate")
        other = t["edited"].select("r", "c", *[F.col(k).alias(f"new_{k}") for k in ("red", "grn", "blu")])
        both = px.join(other, ["r", "c"], "left")
        if both.where("new_red is null").limit(1).count() or t["edited"].count() != px.count():
            raise ValueError("the edited plate has another size than the source")
        changed = F.greatest(*[F.abs(F.col(k) - F.col(f"new_{k}")) for k in ("red", "grn", "blu")]) > params["s1"]["delta_max"]
        outside = both.agg(F.count_if(changed & ~F.col("person_dilated")).alias("outside_px"))
        found = t["clean_detection"].agg(F.count_if(is_person(p)).alias("hits")).crossJoin(outside)
        clean = both.select(*size, *[F.col(f"new_{k}").alias(k) for k in ("red", "grn", "blu")])
    return {"clean": clean, "plate_gates": _verdicts(gates.verdict(found, "cleanplate_detector"), gates.verdict(found, "cleanplate_containment"))}


def fuse(t: Tables, params: dict) -> Tables:
    """Aligns the faces' depths, fuses them by weight, smooths along the image, and marks the sky."""
    p, depth = params["s2"], t["depth"]
    at = depth.where("wt > 0").groupBy("r", "c").agg(F.collect_list(F.struct("face", "x", "wt")).alias("faces"))
    a = at.select(F.explode("faces").alias("a"), "faces").select("a", F.explode("faces").alias("b")).where("a.face < b.face")
    overlap = a.selectExpr("a.face as face_i", "b.face as face_j", "a.x as xi", "b.x as xj", "a.wt * b.wt as base")
    count = int(depth.agg(F.max("face")).first()[0] or 0) + 1
    theta, _ = stats.align_faces(overlap, count, p["huber_delta"], p["huber_iters"], p["affine_reg"], p["anchor"])
    affine = depth.sparkSession.createDataFrame([(i, float(u), float(v)) for i, (u, v) in enumerate(theta)], "face long, a double, b double")
    fused = faces.fused_rows(depth.join(F.broadcast(affine), "face").withColumn("value", F.expr("a * x + b"))).persist()
    px = t["clean"].join(fused, ["r", "c"], "left")
    if bare := px.where("ld is null").count():
        raise ValueError(f"{bare} pixels that no face covers")
    middle = fused.agg(F.percentile(F.exp("ld"), 0.5).alias("m")).first()["m"]
    px = px.withColumns({"ld": F.col("ld") - F.ln(F.lit(middle)), "gray": F.expr(sp.LUMA)})
    px = raster.box_filter_guided(px, "gray", "ld", p["guided_radius"], p["guided_eps"])
    px = metrics.gradient(px.withColumn("d", F.exp("ld_guided")), "d")
    far = px.agg(F.percentile("d", p["sky_percentile"]).alias("far"))
    px = px.crossJoin(F.broadcast(far)).withColumn("raw_sky", F.expr(f"{g.PITCH_DEG} > 0e0 and d > far and gradient < {p['sky_grad_max']}e0"))
    px = raster.opened_closed(px, "raw_sky").withColumnRenamed("raw_sky_clean", "sky")
    ring = overlap.where(f"face_i < {p['ring']} and face_j < {p['ring']}").join(F.broadcast(affine.toDF("face_i", "ai", "bi")), "face_i").join(F.broadcast(affine.toDF("face_j", "aj", "bj")), "face_j")
    pairs = ring.selectExpr("abs(ai * xi + bi - aj * xj - bj) as step", "greatest(ai * xi + bi, aj * xj + bj) as depth", "base as wt")
    measured = stats.interface_step(pairs).crossJoin(px.agg(stats.dynamic_range().alias("dynamic_range")))
    return {"relative": px.select("r", "c", "h", "w", "red", "grn", "blu", "d", "sky"), "sky_measure": judge.sky_share(px), "fuse_gates": gates.verdict(measured, "interface_step")}


def scale(t: Tables, params: dict) -> Tables:
    """Metres from the height of the camera over the ground."""
    p, px = params["s2b"], t["relative"]
    cone = g.with_directions(px.where(F.expr(f"{g.PITCH_DEG} < {p['cone_pitch_deg']}e0 and {g.finite('d')} and not sky"))).select(*[F.expr(f"d{a} * d").alias(a) for a in "xyz"])
    explicit = params["s2b"].get("explicit_scale")
    coef, points = stats.ground_plane(cone, p["irls_iters"])
    m = stats.plane_measures(coef)
    factor = explicit or params["camera_height_m"] / max(m["h_rel"], 1e-9)
    norm = (coef[0] ** 2 + 1 + coef[1] ** 2) ** 0.5
    res = points.where("inlier").agg((F.percentile(F.abs("res"), 0.5) / norm / max(m["h_rel"], 1e-9)).alias("residual_rel")).withColumns({"tilt_deg": F.lit(m["tilt_deg"]), "explicit_scale": F.lit(explicit is not None)})
    metric = px.withColumn("d", F.when(F.col("sky"), float("inf")).otherwise((F.col("d") * factor).cast("float").cast("double")))
    band = metric.where(F.expr(f"{g.PITCH_DEG} between {-p['band_down_deg']}e0 and {p['band_up_deg']}e0")).agg(F.percentile("d", p["near_percentile"]).alias("near_m"))
    return {"metric": metric, "scale_gates": _verdicts(gates.verdict(res, "ground_plane"), gates.verdict(band, "min_content_distance"))}


def layer(t: Tables, params: dict) -> Tables:
    """Occlusion edges that a head's movement uncovers, the band behind them, and its fill."""
    p, px = params["s3"], t["metric"]
    box = params["head_box"]
    seen = layers.visible_edges(layers.occlusion_edges(px, p), g.head_poses(box["lateral_m"], box["up_m"], params["s7"]["squat_y_m"]))
    width = layers.band_pixels(seen, p, max(box.values()))
    banded = layers.background_band(seen, width)
    known = F.expr(f"if({g.finite('d')} and not band, 1e0, 0e0)")
    filled = layers.push_pull(banded.withColumns({"known": known, "ld": F.expr(f"case when {g.finite('d')} and d > 0 then ln(d) else 0e0 end"), "fr": F.col("red") * 1.0, "fg": F.col("grn") * 1.0, "fb": F.col("blu") * 1.0}), ["ld", "fr", "fg", "fb"], "known", p["pyramid_min"])
    back = {f"bg_{n}": F.rint(F.greatest(F.lit(0.0), F.least(F.lit(255.0), F.col(f"{c}_fill")))).cast("int") for n, c in (("red", "fr"), ("grn", "fg"), ("blu", "fb"))}
    out = filled.withColumns(back).withColumn("bg_d", F.when(F.col("known") == 1, F.col("d")).otherwise(F.exp("ld_fill")))
    share = banded.agg(stats.solid_angle("band").alias("fraction"))
    return {"layered": out.select("r", "c", "h", "w", "red", "grn", "blu", "d", "sky", "band", "bg_red", "bg_grn", "bg_blu", "bg_d"), "layer_gates": gates.verdict(share, "bg_solid_angle")}


def compress(t: Tables, params: dict) -> Tables:
    """Placed and pruned splats of each profile, thinned further until they fit its cap; the primary one is judged.

    A profile without a packed size fails its budget.
    """
    p, spark, out, rows = params["s6"], t["layered"].sparkSession, {}, []
    for name, cap in [*sorted(p["other_caps"].items()), (p["primary"], p["cap"])]:
        cloud, tries = prune.fit_cap(lambda m: place.place(t["layered"], params["s4"], m, "band"), cap, p)
        out["splats" if name == p["primary"] else f"splats_{name}"] = cloud
        rows.append((name, tries[-1]["count"], cap, tries[-1]["multiplier"], len(tries)))
    profiles = spark.createDataFrame(rows, "profile string, final_count long, cap long, multiplier double, tries int").join(t["packed"].select("profile", "sog_bytes"), "profile", "left")
    return out | {"profiles": profiles, "budget_gates": gates.verdict(profiles.where(F.col("profile") == p["primary"]), "budgets")}


def judged(t: Tables, params: dict) -> Tables:
    """The verdicts on the cloud itself, from rendered views."""
    p, spark, splats = params["s7"], t["splats"].sparkSession, t["splats"]
    views = judge.head_views(spark, params)
    # a few dozen rows each, which verdicts and tables both read
    hole, moved, pairs, tiles = (m.persist() for m in (judge.holes(splats, views, p["center_frac"]), judge.jitter(splats, p), judge.stereo(splats, p), judge.fidelity(splats, t["clean"], p)))
    # a view that no detector has looked at has no score, and fails
    looked = views.select("view").join(t["people"].groupBy("view").agg(F.max("score").alias("score")), "view", "left")
    worst = lambda df, **of: df.agg(*[F.max(v).alias(k) for k, v in of.items()])
    verdicts = _verdicts(
        gates.verdict(worst(hole, worst_magenta="magenta", worst_alpha="alpha", worst_blob_px="blob_px"), "hole"),
        gates.verdict(worst(moved, worst_energy="energy"), "jitter"),
        gates.verdict(pairs.agg(F.max(F.abs("vdisp_px")).alias("vdisp_px"), F.min("min_depth_m").alias("min_depth_m"), F.min("order").alias("order")), "stereo"),
        gates.verdict(looked.agg(F.when(F.count_if(F.col("score").isNull()) == 0, F.max("score")).alias("worst_score")), "people"),
        gates.verdict(tiles.agg(F.min("ssim").alias("ssim_worst"), F.avg("ssim").alias("ssim_mean")), "fidelity_at_origin"),
    )
    return {"hole_views": hole, "jitter_views": moved, "stereo_views": pairs, "fidelity_tiles": tiles, "layer_counts": prune.layer_counts(splats), "cloud_gates": verdicts}


GATE_TABLES = ("ingest_gates", "plate_gates", "fuse_gates", "scale_gates", "layer_gates", "budget_gates", "cloud_gates")


def manifest(t: Tables, params: dict) -> Tables:
    """All verdicts of the run; a run that lacks any gate's verdict isn't shippable."""
    every = _verdicts(*[t[n] for n in GATE_TABLES])
    missing = every.agg(F.count_distinct("gate").alias("n")).select(F.col("n") < len(gates.GATES))
    summary = gates.summary(every).crossJoin(missing.toDF("missing"))
    return {"gates": every, "summary": summary.withColumn("shippable", F.col("shippable") & ~F.col("missing")).drop("missing")}


STAGES = [
    Stage("s0_ingest", ("pixel", "detection"), ingest),
    Stage("s1_cleanplate", ("ingested", "detection", "edited", "clean_detection"), clean_plate),
    Stage("s2_fuse", ("clean", "depth"), fuse),
    Stage("s2b_scale", ("relative",), scale),
    Stage("s3_layers", ("metric",), layer),
    Stage("s6_compress", ("layered", "packed"), compress),
    Stage("s7_gates", ("splats", "clean", "people"), judged),
    Stage("s8_manifest", GATE_TABLES, manifest),
]
