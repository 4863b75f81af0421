"""Measures of a finished cloud from rendered views: holes, jitter, stereo pairs, fidelity, people.

Views are a small table (a few dozen rows).  Every measure renders its views in
one pass over the cloud and then aggregates by view, so nothing is looped over on
the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import geometry as g
from quarry.functions import splats as sp
from quarry.operators import metrics, raster, render, stats
from quarry.plans.gates import central_window, hole_pixels
from quarry.params import DEFAULTS

VIEWS = "view string, px double, py double, pz double, yaw double, pitch double, fov double, vw int, vh int"
#: Directions of the level views, and those of the pairs that are looked at for near depths only.
YAWS, POLES = (0.0, 90.0, 180.0, 270.0), (-90.0, 90.0)
#: Fixed value: rows and columns at the border of a view whose depths don't count.
BORDER = 2


def views_of(spark: SparkSession, rows: Iterable[tuple[str, tuple[float, float, float], float, float]], p: dict, fov: float | None = None) -> DataFrame:
    """Views (name, position, yaw, pitch) of the parameters' size."""
    size, wide = int(p["render_px"]), float(p["fov_deg"] if fov is None else fov)
    return spark.createDataFrame([(name, *map(float, at), yaw, pitch, wide, size, size) for name, at, yaw, pitch in rows], VIEWS)


def level_and_down(name: str, at: tuple[float, float, float]) -> list[tuple[str, tuple[float, float, float], float, float]]:
    """The four level views and the one straight down from a position."""
    return [(f"{name}_yaw{yaw:03.0f}", at, yaw, 0.0) for yaw in YAWS] + [(f"{name}_down", at, 0.0, -90.0)]


def head_views(spark: SparkSession, params: dict = DEFAULTS) -> DataFrame:
    """Five views from each of the head box's seven positions."""
    box, p = params["head_box"], params["s7"]
    poses = g.head_poses(box["lateral_m"], box["up_m"], p["squat_y_m"])
    return views_of(spark, [v for name, x, y, z in poses for v in level_and_down(name, (x, y, z))], p)


def images(splats: DataFrame, views: DataFrame) -> DataFrame:
    """(view, r, c, h, w, red, grn, blu, alpha, d) of every pixel of the views."""
    size = F.broadcast(views.select("view", F.col("vh").cast("long").alias("h"), F.col("vw").cast("long").alias("w")))
    out = render.rendered(splats, views).join(size, "view")
    return out.select("view", F.col("py").cast("long").alias("r"), F.col("px").cast("long").alias("c"), "h", "w", *[F.col(k).cast("int").alias(k) for k in ("red", "grn", "blu")], "alpha", F.col("depth").alias("d"))


def rays(px: DataFrame, views: DataFrame) -> DataFrame:
    """Pixels of views with the unit direction ``dx, dy, dz`` that each looks along."""
    at = px.join(F.broadcast(views.select("view", "yaw", "pitch", "fov")), "view")
    at = at.withColumn("f", F.expr("(w / 2e0) / tan(radians(fov) / 2e0)")).withColumns({"tx": F.expr("(c - w / 2e0 + 0.5e0) / f"), "ty": F.expr("(h / 2e0 - 0.5e0 - r) / f"), "tz": F.lit(1.0)})
    world = g.into_world("tx", "ty", "tz", "yaw", "pitch")
    return at.withColumn("n", F.expr("sqrt(tx * tx + ty * ty + 1e0)")).withColumns({f"d{a}": F.expr(f"({e}) / n") for a, e in zip("xyz", world, strict=True)}).drop("f", "tx", "ty", "tz", "n", "yaw", "pitch", "fov")


def holes(splats: DataFrame, views: DataFrame, share: float = DEFAULTS["s7"]["center_frac"]) -> DataFrame:
    """(view, ``magenta``, ``alpha``, ``blob_px``): below the skyline, the share of pixels that show the shell (painted magenta) or next to nothing, and the largest patch of them in the middle."""
    shell = {f"f_dc_{i}": F.when(F.col("layer") == 2, F.expr(sp.to_dc(v))).otherwise(F.col(f"f_dc_{i}")) for i, v in enumerate(("1e0", "0e0", "1e0"))}
    px = rays(images(splats.withColumns(shell), views), views).withColumns({k: F.col(k) / 255.0 for k in ("red", "grn", "blu")})
    px = hole_pixels(px, "degrees(asin(greatest(-1e0, least(1e0, dy))))")
    size = views.select("vw", "vh").first()
    (left, right), (top, bottom) = central_window(size["vw"], share), central_window(size["vh"], share)
    px = px.withColumn("patch", F.expr(f"(magenta or hole) and below and r >= {top} and r < {bottom} and c >= {left} and c < {right}"))
    part = lambda mask: F.coalesce(F.try_divide(F.count_if(F.expr(f"{mask} and below")), F.count_if("below")), F.lit(0.0))
    shares = px.groupBy("view").agg(part("magenta").alias("magenta"), part("hole").alias("alpha"))
    blobs = metrics.largest_blob(px, "patch", ["view"])
    return shares.join(blobs, "view", "left").withColumn("blob_px", F.coalesce("blob", F.lit(0).cast("long"))).drop("blob")


def jitter(splats: DataFrame, p: dict = DEFAULTS["s7"]) -> DataFrame:
    """(view, ``energy``): how much the five views from the centre change when the eye moves a little to the side."""
    spark = splats.sparkSession
    both = [(f"{side}|{name}", at, yaw, pitch) for side, x in (("a", 0.0), ("b", p["jitter_m"])) for name, at, yaw, pitch in level_and_down("center", (x, 0.0, 0.0))]
    px = images(splats, views_of(spark, both, p)).withColumns({"side": F.substring("view", 1, 1), "view": F.expr("substring(view, 3)")})
    return metrics.mean_difference(px.where("side = 'a'"), px.where("side = 'b'"), ["view"])


def stereo(splats: DataFrame, p: dict = DEFAULTS["s7"]) -> DataFrame:
    """(view, ``vdisp_px``, ``min_depth_m``, ``order``) of pairs of eyes: four level ones, and two towards the poles that have depths only.

    ``vdisp_px`` is the vertical shift between the eyes, ``order`` the share of
    pixels whose depth the other eye sees where it should.
    """
    spark, half, size = splats.sparkSession, p["ipd_m"] / 2, int(p["render_px"])
    pairs = []
    for name, yaw, pitch in [*((f"yaw{y:03.0f}", y, 0.0) for y in YAWS), *((f"pole{q:+03.0f}", 0.0, q) for q in POLES)]:
        right = (math.cos(math.radians(yaw)), 0.0, -math.sin(math.radians(yaw)))
        pairs += [(f"{eye}|{name}", tuple(sign * half * v for v in right), yaw, pitch) for eye, sign in (("l", -1.0), ("r", 1.0))]
    px = images(splats, views_of(spark, pairs, p)).withColumns({"eye": F.substring("view", 1, 1), "view": F.expr("substring(view, 3)"), "gray": F.expr(sp.LUMA)})
    inner = F.expr(f"r >= {BORDER} and r < h - {BORDER} and c >= {BORDER} and c < w - {BORDER} and {g.finite('d')}")
    near = px.groupBy("view").agg(F.coalesce(F.min(F.when(inner, F.col("d"))), F.lit(1e9)).alias("min_depth_m"))
    left, right = (px.where(f"eye = '{e}' and view like 'yaw%'") for e in "lr")
    order = metrics.order_consistency(left, right, size / 2 / math.tan(math.radians(p["fov_deg"]) / 2), p["ipd_m"], by=["view"]).select("view", F.col("consistent").alias("order"))
    costs = metrics.vertical_costs(left, right, "gray", 2, ["view"]).groupBy("view").agg(F.map_from_entries(F.collect_list(F.struct("dy", "cost"))).alias("costs"))
    shift = costs.select("view", shift_of(F.col("costs")).alias("vdisp_px"))
    return near.join(shift, "view", "left").join(order, "view", "left").withColumn("order", F.when(F.col("view").like("yaw%"), F.coalesce("order", F.lit(1.0))))


def shift_of(costs: Column, reach: int = 2) -> Column:
    """The shift of least cost (of equals the smallest), refined by a parabola through its neighbours; 0 where costs hardly differ."""
    each = F.array(*[F.element_at(costs, d) for d in range(-reach, reach + 1)])
    at = F.array_position(each, F.array_min(each)).cast("int")
    a, b, c = (F.get(each, at - 1 + k) for k in (-1, 0, 1))
    bend = a - 2 * b + c
    inner = (at > 1) & (at < 2 * reach + 1) & (F.abs(bend) > 1e-12)
    return F.when(F.array_max(each) - F.array_min(each) < 1e-12, F.lit(0.0)).otherwise(at - 1 - reach + F.when(inner, F.try_divide(0.5 * (a - c), bend)).otherwise(0.0))


def fidelity(splats: DataFrame, panorama: DataFrame, p: dict = DEFAULTS["s7"]) -> DataFrame:
    """(view, ``ssim``): each tile's view from the origin against the panorama seen the same way."""
    spark, size = splats.sparkSession, int(p["render_px"])
    tiles = [(f"tile{j}_{i}", 0.0, 0.0, 0.0, yaw, pitch, fov, size, size) for i, j, yaw, pitch, fov in g.tile_views(p["tiles_lon"], p["tiles_lat"])]
    views = spark.createDataFrame(tiles, VIEWS)
    px = rays(images(splats, views), views).withColumn("seen", F.expr(sp.LUMA)).withColumn("pid", F.expr("r * w + c"))
    of = F.broadcast(panorama.agg(F.max("h").alias("ph"), F.max("w").alias("pw")))
    u, v = g.to_uv("dx", "dy", "dz")
    points = px.select("view", "pid", "dx", "dy", "dz").crossJoin(of).select("view", "pid", F.col("ph").alias("h"), F.col("pw").alias("w"), "dx", "dy", "dz").withColumns({"u": F.expr(u), "v": F.expr(v)})
    points = points.withColumn("pid", F.struct("view", "pid")).select("pid", "u", "v", "h", "w")
    source = raster.bilinear(points, panorama.withColumn("gray", F.expr(sp.LUMA)), ["gray"]).select(F.col("pid.view").alias("view"), F.col("pid.pid").alias("pid"), F.col("gray").alias("source"))
    both = px.select("view", "pid", "r", "c", "h", "w", "seen").join(source, ["view", "pid"])
    return metrics.ssim(both, "seen", "source", ["view"]).groupBy("view").agg(F.avg("ssim").alias("ssim"))


def sky_share(px: DataFrame) -> DataFrame:
    """(``sky_fraction``): the sky's share of the sphere."""
    return px.agg(stats.solid_angle("sky").alias("sky_fraction"))
