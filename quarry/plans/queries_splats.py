"""Queries over the splat view: codecs, frames, pruning, projection, compositing, image measures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import views
from quarry.functions import geometry as g
from quarry.functions import splats as sp
from quarry.operators import metrics, prune, render
from quarry.plans.queries_raster import PX, r6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SP = views.SPLAT_SQL


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(f"WITH {SP} SELECT ord, round(f_dc_0 * 0.28209479177387814 + 0.5, 6) AS red, round((f_dc_0 * 0.28209479177387814 + 0.5 - 0.5) / 0.28209479177387814, 6) AS dc, round(1 / (1 + exp(-opacity)), 6) AS alpha, round(ln(greatest(1e-6, least(1 - 1e-6, 1 / (1 + exp(-opacity)))) / (1 - greatest(1e-6, least(1 - 1e-6, 1 / (1 + exp(-opacity)))))), 5) AS logit FROM splat")
def codec_roundtrip(spark, sf_dir):
    s = views.splat(spark, sf_dir).select("ord", F.expr(sp.from_dc("f_dc_0")).alias("colour"), F.expr(sp.from_logit("opacity")).alias("a"))
    return s.select("ord", r6("red", "colour"), r6("dc", sp.to_dc("colour")), r6("alpha", "a"), F.round(F.expr(sp.to_logit("a")), 5).alias("logit"))


@query("""WITH q AS (SELECT vec_id AS ord, embedding[14]::DOUBLE AS w, embedding[15]::DOUBLE AS x, embedding[16]::DOUBLE AS y, embedding[17]::DOUBLE AS z FROM embeddings), n AS (SELECT *, greatest(sqrt(w * w + x * x + y * y + z * z), 1e-12) AS l, CASE WHEN w < 0 THEN -1 ELSE 1 END AS s FROM q)
SELECT ord, round(s * w / l, 6) + 0.0::DOUBLE AS qw, round(s * x / l, 6) + 0.0::DOUBLE AS qx, round(s * y / l, 6) + 0.0::DOUBLE AS qy, round(s * z / l, 6) + 0.0::DOUBLE AS qz FROM n""")
def canonical_quat(spark, sf_dir):
    raw = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("ord"), *[F.element_at("embedding", 14 + i).cast("double").alias(c) for i, c in enumerate("wxyz")])
    return raw.select("ord", *[(F.round(F.expr(e), 6) + 0.0).alias(f"q{c}") for c, e in zip("wxyz", sp.canonical_quat("w", "x", "y", "z"), strict=True)])


FRAME = f"""{SP}, fr AS (SELECT *, CASE WHEN abs(ny) > 0.9 THEN 0 ELSE nz END AS ax, CASE WHEN abs(ny) > 0.9 THEN -nz ELSE 0 END AS ay, CASE WHEN abs(ny) > 0.9 THEN ny ELSE -nx END AS az FROM splat),
t1 AS (SELECT *, ax / greatest(sqrt(ax * ax + ay * ay + az * az), 1e-12) AS t1x, ay / greatest(sqrt(ax * ax + ay * ay + az * az), 1e-12) AS t1y, az / greatest(sqrt(ax * ax + ay * ay + az * az), 1e-12) AS t1z FROM fr),
t2 AS (SELECT *, ny * t1z - nz * t1y AS t2x, nz * t1x - nx * t1z AS t2y, nx * t1y - ny * t1x AS t2z FROM t1)"""


@query(f"WITH {FRAME} SELECT ord, " + ", ".join(f"round({c}, 6) + 0.0::DOUBLE AS {c}" for c in ("t1x", "t1y", "t1z", "t2x", "t2y", "t2z")) + " FROM t2")
def frame_from_normal(spark, sf_dir):
    f = sp.frame("nx", "ny", "nz")
    return views.splat(spark, sf_dir).select("ord", *[(F.round(F.expr(v), 6) + 0.0).alias(k) for k, v in f.items()])


@query(f"""WITH {FRAME}, q AS (SELECT ord, t1x, t2x, nx, t1y, t2y, ny, t1z, t2z, nz, 1 + t1x + t2y + nz AS s0, 1 + t1x - t2y - nz AS s1, 1 - t1x + t2y - nz AS s2, 1 - t1x - t2y + nz AS s3 FROM t2),
p AS (SELECT *, greatest(s0, s1, s2, s3) AS m FROM q),
k AS (SELECT ord, m, CASE WHEN s0 = m THEN [s0, t2z - ny, nx - t1z, t1y - t2x] WHEN s1 = m THEN [t2z - ny, s1, t2x + t1y, nx + t1z] WHEN s2 = m THEN [nx - t1z, t2x + t1y, s2, ny + t2z] ELSE [t1y - t2x, nx + t1z, ny + t2z, s3] END AS v FROM p)
SELECT ord, """ + ", ".join(f"round(CASE WHEN v[1] < 0 THEN -1 ELSE 1 END * v[{i + 1}] / (2 * sqrt(m)), 6) + 0.0::DOUBLE AS rot_{i}" for i in range(4)) + " FROM k")
def quat_from_frame(spark, sf_dir):
    s = views.splat(spark, sf_dir)
    s = s.withColumns({k: F.expr(v) for k, v in sp.frame("nx", "ny", "nz").items()})
    q = sp.quat_of([["t1x", "t2x", "nx"], ["t1y", "t2y", "ny"], ["t1z", "t2z", "nz"]])
    return s.select("ord", *[(F.round(F.expr(v), 6) + 0.0).alias(f"rot_{i}") for i, v in enumerate(q)])


@query(f"WITH {SP} SELECT DISTINCT least(255, greatest(0, floor((pi() / 2 - asin(greatest(-1, least(1, y / sqrt(x * x + y * y + z * z))))) / pi() * 256)))::BIGINT AS row, (floor((atan2(x, z) + pi()) / (2 * pi()) * 512)::BIGINT % 512) AS col FROM splat")
def direction_bins(spark, sf_dir):
    s = views.splat(spark, sf_dir)
    row = F.expr("cast(least(255, greatest(0, floor((pi() / 2 - asin(greatest(-1e0, least(1e0, y / sqrt(x * x + y * y + z * z))))) / pi() * 256))) as bigint)")
    return s.select(row.alias("row"), F.expr("pmod(cast(floor((atan2(x, z) + pi()) / (2 * pi()) * 512) as bigint), 512)").alias("col")).distinct()


@query(f"WITH {SP} SELECT layer, count(*) AS n FROM splat GROUP BY layer")
def layer_counts(spark, sf_dir):
    return prune.layer_counts(views.splat(spark, sf_dir))


@query(f"WITH {SP} SELECT round(coalesce(count(*) FILTER (WHERE 1 / (1 + exp(-opacity)) >= 0.05 AND layer <> 2)::DOUBLE / nullif(count(*) FILTER (WHERE layer <> 2), 0), 1), 6) AS retained FROM splat")
def retained_frac(spark, sf_dir):
    kept = F.count_if(F.expr(f"{sp.from_logit('opacity')} >= 0.05e0 and layer <> 2"))
    return views.splat(spark, sf_dir).agg(F.round(F.coalesce(kept.cast("double") / F.nullif(F.count_if(F.col("layer") != 2), F.lit(0)), F.lit(1.0)), 6).alias("retained"))


FLOOR = "fl AS (SELECT * FROM splat WHERE 1 / (1 + exp(-opacity)) >= 0.05)"
DIST = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z))"


def _isolated(src: str, name: str) -> str:
    return f"""{name} AS (SELECT * FROM {src} WHERE layer = 2 OR ord IN (SELECT a.ord FROM {src} a JOIN {src} b ON a.ord <> b.ord AND {DIST} <= 8 * exp(greatest(a.scale_0, a.scale_1, a.scale_2))
  WHERE a.layer <> 2 AND b.layer <> 2 GROUP BY a.ord HAVING count(*) >= 4))"""


def _merged(src: str, name: str, factor: float) -> str:
    return f"""{name}d AS (SELECT a.ord, {DIST} AS dist, exp(greatest(b.scale_0, b.scale_1, b.scale_2)) AS radius, row_number() OVER (PARTITION BY a.ord ORDER BY {DIST}, b.ord) AS n FROM {src} a, {src} b WHERE a.layer = 1 AND b.layer = 0),
{name} AS (SELECT * FROM {src} WHERE ord NOT IN (SELECT ord FROM {name}d WHERE n = 1 AND dist < {factor} * radius))"""


@query(f"WITH {SP}, {FLOOR} SELECT ord, layer FROM fl")
def opacity_floor(spark, sf_dir):
    return prune.opacity_floor(views.splat(spark, sf_dir)).select("ord", "layer")


@query(f"WITH {SP}, {_isolated('splat', 'iso')} SELECT ord, layer FROM iso")
def isolation_prune(spark, sf_dir):
    return prune.isolation_prune(views.splat(spark, sf_dir)).select("ord", "layer")


@query(f"WITH {SP}, {_merged('splat', 'mg', 40.0)} SELECT ord, layer FROM mg")
def merge_duplicates(spark, sf_dir):
    return prune.merge_duplicates(views.splat(spark, sf_dir), 40.0).select("ord", "layer")


@query(f"WITH {SP}, {FLOOR}, {_isolated('fl', 'iso')}, {_merged('iso', 'mg', 0.25)} SELECT ord, layer FROM mg")
def prune_chain(spark, sf_dir):
    return prune.prune_chain(views.splat(spark, sf_dir)).select("ord", "layer")


@query(f"WITH {SP} SELECT layer, count(*) AS n, min(ord) AS first_ord FROM (SELECT * FROM splat WHERE layer = 0 UNION ALL SELECT * FROM splat WHERE layer = 1 UNION ALL SELECT * FROM splat WHERE layer = 2) GROUP BY layer")
def splat_union(spark, sf_dir):
    s = views.splat(spark, sf_dir)
    parts = s.where("layer = 0").unionByName(s.where("layer = 1")).unionByName(s.where("layer = 2"))
    return parts.groupBy("layer").agg(F.count("*").alias("n"), F.min("ord").alias("first_ord"))


@query(f"WITH {SP} SELECT ord, round(CASE WHEN layer = 2 THEN (1 - 0.5) / 0.28209479177387814 ELSE f_dc_0 END, 6) AS f_dc_0, round(CASE WHEN layer = 2 THEN (0 - 0.5) / 0.28209479177387814 ELSE f_dc_1 END, 6) AS f_dc_1 FROM splat")
def magenta_shell(spark, sf_dir):
    s = views.splat(spark, sf_dir)
    return s.select("ord", *[F.round(F.when(F.col("layer") == 2, F.expr(sp.to_dc(v))).otherwise(F.col(c)), 6).alias(c) for c, v in (("f_dc_0", "1e0"), ("f_dc_1", "0e0"))])


VIEW = [("front", 0.0, 0.0, -6.0, 0.0, 0.0, 90.0, 32, 32), ("side", 6.0, 0.5, 0.0, -90.0, -10.0, 90.0, 32, 32)]


def _views(spark: SparkSession) -> DataFrame:
    return spark.sql("select * from values " + ", ".join(f"('{v}', {x}e0, {y}e0, {z}e0, {yaw}e0, {p}e0, {f}e0, {w}, {h})" for v, x, y, z, yaw, p, f, w, h in VIEW) + " as v(view, px, py, pz, yaw, pitch, fov, vw, vh)")


VIEWS = "vw(view, px, py, pz, yaw, pitch, fov, vw, vh) AS (VALUES " + ", ".join(f"('{v}', {x}::DOUBLE, {y}::DOUBLE, {z}::DOUBLE, {yaw}::DOUBLE, {p}::DOUBLE, {f}::DOUBLE, {w}, {h})" for v, x, y, z, yaw, p, f, w, h in VIEW) + ")"
EWA = f"""{SP}, {VIEWS}, ro AS (SELECT *, cos(radians(yaw)) AS cy, sin(radians(yaw)) AS sy, cos(radians(pitch)) AS cp, sin(radians(pitch)) AS sp_, x - px AS qx, y - py AS qy, z - pz AS qz FROM splat, vw),
cm AS (SELECT *, qx * cy - qz * sy AS tx, -qx * sy * sp_ + qy * cp - qz * cy * sp_ AS ty, qx * sy * cp + qy * sp_ + qz * cy * cp AS tz, (vw / 2.0::DOUBLE) / tan(radians(fov) / 2) AS f, 1.3::DOUBLE * tan(radians(fov) / 2) AS lim FROM ro),
jc AS (SELECT *, f * tx / tz + vw / 2.0::DOUBLE - 0.5 AS u, vh / 2.0::DOUBLE - 0.5 - f * ty / tz AS v, greatest(-lim, least(lim, tx / tz)) * tz AS xj, greatest(-lim, least(lim, ty / tz)) * tz AS yj,
    1 - 2 * (rot_2 * rot_2 + rot_3 * rot_3) AS m00, 2 * (rot_1 * rot_2 - rot_0 * rot_3) AS m01, 2 * (rot_1 * rot_3 + rot_0 * rot_2) AS m02, 2 * (rot_1 * rot_2 + rot_0 * rot_3) AS m10, 1 - 2 * (rot_1 * rot_1 + rot_3 * rot_3) AS m11, 2 * (rot_2 * rot_3 - rot_0 * rot_1) AS m12,
    2 * (rot_1 * rot_3 - rot_0 * rot_2) AS m20, 2 * (rot_2 * rot_3 + rot_0 * rot_1) AS m21, 1 - 2 * (rot_1 * rot_1 + rot_2 * rot_2) AS m22, exp(2 * scale_0) AS e0, exp(2 * scale_1) AS e1, exp(2 * scale_2) AS e2 FROM cm WHERE tz > 0.05),
wk AS (SELECT *, m00 * e0 * m00 + m01 * e1 * m01 + m02 * e2 * m02 AS w00, m00 * e0 * m10 + m01 * e1 * m11 + m02 * e2 * m12 AS w01, m00 * e0 * m20 + m01 * e1 * m21 + m02 * e2 * m22 AS w02, m10 * e0 * m10 + m11 * e1 * m11 + m12 * e2 * m12 AS w11, m10 * e0 * m20 + m11 * e1 * m21 + m12 * e2 * m22 AS w12, m20 * e0 * m20 + m21 * e1 * m21 + m22 * e2 * m22 AS w22,
    f / tz * cy - f * xj / (tz * tz) * (sy * cp) AS a0, 0 - f * xj / (tz * tz) * sp_ AS a1, f / tz * (-sy) - f * xj / (tz * tz) * (cy * cp) AS a2,
    -(f / tz * (-sy * sp_) - f * yj / (tz * tz) * (sy * cp)) AS b0, -(f / tz * cp - f * yj / (tz * tz) * sp_) AS b1, -(f / tz * (-cy * sp_) - f * yj / (tz * tz) * (cy * cp)) AS b2 FROM jc),
cv AS (SELECT *, a0 * (w00 * a0 + w01 * a1 + w02 * a2) + a1 * (w01 * a0 + w11 * a1 + w12 * a2) + a2 * (w02 * a0 + w12 * a1 + w22 * a2) + 0.3 AS sa,
    a0 * (w00 * b0 + w01 * b1 + w02 * b2) + a1 * (w01 * b0 + w11 * b1 + w12 * b2) + a2 * (w02 * b0 + w12 * b1 + w22 * b2) AS sb,
    b0 * (w00 * b0 + w01 * b1 + w02 * b2) + b1 * (w01 * b0 + w11 * b1 + w12 * b2) + b2 * (w02 * b0 + w12 * b1 + w22 * b2) + 0.3 AS sc FROM wk),
bx AS (SELECT *, sa * sc - sb * sb AS det, floor(u - 3 * sqrt(sa)) AS bx0, ceil(u + 3 * sqrt(sa)) AS bx1, floor(v - 3 * sqrt(sc)) AS by0, ceil(v + 3 * sqrt(sc)) AS by1 FROM cv),
ew AS (SELECT view, ord, vw, vh, u, v, tz AS z, sc / det AS ca, -sb / det AS cb, sa / det AS cc, greatest(0, least(vw - 1, bx0))::INT AS x0, greatest(0, least(vw - 1, bx1))::INT AS x1, greatest(0, least(vh - 1, by0))::INT AS y0, greatest(0, least(vh - 1, by1))::INT AS y1,
    1 / (1 + exp(-opacity)) AS alpha0, greatest(0, least(1, f_dc_0 * 0.28209479177387814 + 0.5)) AS red, greatest(0, least(1, f_dc_1 * 0.28209479177387814 + 0.5)) AS grn, greatest(0, least(1, f_dc_2 * 0.28209479177387814 + 0.5)) AS blu FROM bx WHERE det > 1e-12 AND bx1 >= 0 AND bx0 <= vw - 1 AND by1 >= 0 AND by0 <= vh - 1)"""
FOOT = """fp AS (SELECT view, ord, z, red, grn, blu, py, px, least(0.99, alpha0 * exp(-0.5 * (ca * (px - u) * (px - u) + cc * (py - v) * (py - v) + 2 * cb * (px - u) * (py - v)))) AS alpha
  FROM ew, LATERAL (SELECT unnest(range(y0, y1 + 1)) AS py) y, LATERAL (SELECT unnest(range(x0, x1 + 1)) AS px) x), ft AS (SELECT * FROM fp WHERE alpha >= 1 / 255.0::DOUBLE)"""


@query(f"WITH {EWA} SELECT view, ord, round(u, 4) AS u, round(v, 4) AS v, round(z, 5) AS z, round(ca, 4) AS ca, round(cb, 4) + 0.0::DOUBLE AS cb, round(cc, 4) AS cc, x0, x1, y0, y1 FROM ew")
def ewa_project(spark, sf_dir):
    seen = render.projected(views.splat(spark, sf_dir), _views(spark))
    return seen.select("view", "ord", F.round("u", 4).alias("u"), F.round("v", 4).alias("v"), F.round("z", 5).alias("z"), F.round("ca", 4).alias("ca"), (F.round("cb", 4) + 0.0).alias("cb"), F.round("cc", 4).alias("cc"), "x0", "x1", "y0", "y1")


@query(f"WITH {EWA}, {FOOT} SELECT view, count(*) AS n, count(DISTINCT ord) AS splats, round(sum(alpha), 3) AS total FROM ft GROUP BY view")
def splat_footprint(spark, sf_dir):
    at = render.footprints(render.projected(views.splat(spark, sf_dir), _views(spark)))
    return at.groupBy("view").agg(F.count("*").alias("n"), F.count_distinct("ord").alias("splats"), F.round(F.sum("alpha"), 3).alias("total"))


COMPOSITE = f"""{EWA}, {FOOT}, lt AS (SELECT *, coalesce(product(1 - alpha) OVER (PARTITION BY view, py, px ORDER BY z, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) * alpha AS light FROM ft),
im AS (SELECT view, py, px, sum(light) AS alpha, sum(light * red) AS red, sum(light * z) AS dz FROM lt GROUP BY ALL)"""


@query(f"WITH {COMPOSITE} SELECT view, py::INT AS py, px::INT AS px, round(alpha, 5) AS alpha, round(red, 5) AS red, CASE WHEN alpha < 1e-3 THEN NULL ELSE round(dz / greatest(alpha, 1e-6), 3) END AS depth FROM im")
def composite_relational(spark, sf_dir):
    out = render.composited(render.projected(views.splat(spark, sf_dir), _views(spark)))
    return out.select("view", "py", "px", F.round("alpha", 5).alias("alpha"), F.round("red", 5).alias("red"), F.when(F.col("alpha") >= 1e-3, F.round("depth", 3)).alias("depth"))


RENDER = f"""{EWA}, {FOOT}, lt AS (SELECT *, coalesce(product(1 - alpha) OVER (PARTITION BY view, py, px ORDER BY z, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS rest FROM ft),
im AS (SELECT view, py, px, sum(rest * alpha) AS alpha, sum(rest * alpha * red) AS red, sum(rest * alpha * grn) AS grn, sum(rest * alpha * blu) AS blu FROM lt WHERE rest >= 1e-3 GROUP BY ALL),
gd AS (SELECT view, y.py, x.px FROM vw, LATERAL (SELECT unnest(range(0, vh)) AS py) y, LATERAL (SELECT unnest(range(0, vw)) AS px) x)"""


@query(f"WITH {RENDER} SELECT view, py::INT AS py, px::INT AS px, " + ", ".join(f"round_even(least(1, coalesce({c}, 0)) * 255, 0)::SMALLINT AS {c}" for c in ("red", "grn", "blu")) + ", round(coalesce(alpha, 0), 4) AS alpha FROM gd LEFT JOIN im USING (view, py, px)")
def render_exact(spark, sf_dir):
    return render.rendered(views.splat(spark, sf_dir), _views(spark)).select("view", "py", "px", "red", "grn", "blu", F.round("alpha", 4).alias("alpha"))


MOVED = f"mv AS (SELECT r, c, h, w, (red + k) % 256 AS red, grn, (blu + 3) % 256 AS blu, d + (k % 3) * 0.01::DOUBLE AS d FROM pixel)"


def _moved(px: DataFrame) -> DataFrame:
    """A second image of the raster: colours and depth a little changed."""
    return px.withColumns({"red": (F.col("red") + F.col("k")) % 256, "blu": (F.col("blu") + 3) % 256, "d": F.col("d") + (F.col("k") % 3) * 0.01})


@query(f"WITH {PX}, {MOVED} SELECT round(avg(abs(a.red - b.red) + abs(a.grn - b.grn) + abs(a.blu - b.blu)) / (3 * 255.0::DOUBLE), 6) AS energy FROM pixel a JOIN mv b USING (r, c)")
def jitter_energy(spark, sf_dir):
    px = views.pixel(spark, sf_dir)
    return metrics.mean_difference(px, _moved(px)).select(r6("energy"))


GRAD = """SELECT a.r, a.c, a.h, sqrt(pow(CASE WHEN l.g IS NULL THEN q.g - a.g WHEN q.g IS NULL THEN a.g - l.g ELSE (q.g - l.g) / 2 END, 2) + pow(CASE WHEN t.g IS NULL THEN b.g - a.g WHEN b.g IS NULL THEN a.g - t.g ELSE (b.g - t.g) / 2 END, 2)) AS gr
  FROM {0} a LEFT JOIN {0} l ON l.r = a.r AND l.c = a.c - 1 LEFT JOIN {0} q ON q.r = a.r AND q.c = a.c + 1 LEFT JOIN {0} t ON t.r = a.r - 1 AND t.c = a.c LEFT JOIN {0} b ON b.r = a.r + 1 AND b.c = a.c"""


@query(f"""WITH {PX}, {MOVED}, la AS (SELECT r, c, h, (red + grn + blu) / 3.0::DOUBLE AS g FROM pixel), lb AS (SELECT r, c, h, (red + grn + blu) / 3.0::DOUBLE AS g FROM mv), ga AS ({GRAD.format('la')}), gb AS ({GRAD.format('lb')})
SELECT dy::INT AS dy, round(avg(abs(ga.gr - gb.gr)), 5) AS cost FROM ga, range(-2, 3) s(dy) JOIN gb ON true WHERE gb.r = ga.r + dy AND gb.c = ga.c AND ga.r >= 2 AND ga.r < ga.h - 2 GROUP BY dy""")
def vdisp_cost(spark, sf_dir):
    px = views.pixel(spark, sf_dir)
    mean = F.expr("(red + grn + blu) / 3e0")
    return metrics.vertical_costs(px.withColumn("g", mean), _moved(px).withColumn("g", mean), "g").select("dy", F.round("cost", 5).alias("cost"))


@query(f"""WITH {PX}, {MOVED} SELECT round(avg((abs(a.d - b.d) <= 0.2 * a.d)::INT), 6) AS consistent, count(*) AS n FROM pixel a JOIN mv b ON b.r = a.r AND b.c = (a.c - round_even(256 * 0.063::DOUBLE / a.d, 0)::BIGINT) WHERE a.d > 0""")
def order_consistency(spark, sf_dir):
    px = views.pixel(spark, sf_dir)
    return metrics.order_consistency(px, _moved(px), 256.0, 0.063).select(r6("consistent"), "n")


@query(f"WITH {PX} SELECT coalesce(min(d) FILTER (WHERE isfinite(d)), 1e9) AS near_m, coalesce(min(d) FILTER (WHERE isfinite(d)), 1e9) >= 0.75 AS pass FROM pixel WHERE r >= 2 AND r < h - 2 AND c >= 2 AND c < w - 2")
def near_limit(spark, sf_dir):
    inner = views.pixel(spark, sf_dir).where("r >= 2 and r < h - 2 and c >= 2 and c < w - 2")
    near = F.coalesce(F.min(F.when(F.expr(g.finite("d")), F.col("d"))), F.lit(1e9))
    return inner.agg(near.alias("near_m"), (near >= 0.75).alias("pass"))


KERNEL = "kn(i, k) AS (VALUES " + ", ".join(f"({i - 5}, {k!r}::DOUBLE)" for i, k in enumerate(metrics.gaussian())) + ")"
TILE = "tl AS (SELECT r, c, h, w, red / 255.0::DOUBLE AS a, ((red + k) % 256) / 255.0::DOUBLE AS b FROM pixel)"
MIRROR = "CASE WHEN {0} < 0 THEN -{0} - 1 WHEN {0} >= {1} THEN 2 * {1} - 1 - {0} ELSE {0} END"


@query(f"""WITH {PX}, {KERNEL}, {TILE}, ct AS (SELECT t.r, t.c, y.k * x.k AS k, {MIRROR.format('(t.r + y.i)', 't.h')} AS r2, {MIRROR.format('(t.c + x.i)', 't.w')} AS c2 FROM tl t, kn y, kn x),
m AS (SELECT ct.r, ct.c, sum(k * a) AS ma, sum(k * b) AS mb, sum(k * a * a) AS aa, sum(k * b * b) AS bb, sum(k * a * b) AS ab FROM ct JOIN tl ON tl.r = r2 AND tl.c = c2 GROUP BY ALL)
SELECT r, c, round((2 * ma * mb + 1e-4) * (2 * (ab - ma * mb) + 9e-4) / ((ma * ma + mb * mb + 1e-4) * ((aa - ma * ma) + (bb - mb * mb) + 9e-4)), 5) AS ssim FROM m""")
def ssim_map(spark, sf_dir):
    px = views.pixel(spark, sf_dir).withColumns({"a": F.col("red") / 255.0, "b": ((F.col("red") + F.col("k")) % 256) / 255.0})
    return metrics.ssim(px, "a", "b").select("r", "c", F.round("ssim", 5).alias("ssim"))


@query(f"""WITH {PX}, b AS (SELECT red / 255.0::DOUBLE AS red, grn / 255.0::DOUBLE AS grn, blu / 255.0::DOUBLE AS blu, k / 100.0::DOUBLE AS alpha FROM pixel WHERE degrees({g.LAT}) < -2)
SELECT round(avg((red > 0.6 AND blu > 0.6 AND grn < 0.35)::INT), 6) AS magenta, round(avg((alpha < 0.05)::INT), 6) AS hole, count(*) AS n FROM b""")
def hole_fracs(spark, sf_dir):
    from quarry.plans.gates import hole_pixels

    px = views.pixel(spark, sf_dir).withColumn("alpha", F.col("k") / 100.0).withColumns({c: F.col(c) / 255.0 for c in ("red", "grn", "blu")})
    at = hole_pixels(px, g.PITCH_DEG).where("below")
    return at.agg(F.round(F.avg(F.col("magenta").cast("int")), 6).alias("magenta"), F.round(F.avg(F.col("hole").cast("int")), 6).alias("hole"), F.count("*").alias("n"))


@query(f"""WITH RECURSIVE {PX}, m AS (SELECT r, c, r * w + c AS id FROM pixel WHERE k < 20), e AS (SELECT a.id AS a, b.id AS b FROM m a JOIN m b ON abs(a.r - b.r) + abs(a.c - b.c) = 1),
l AS (SELECT id, id AS least FROM m UNION SELECT e.b, l.least FROM l JOIN e ON l.id = e.a AND l.least < e.b), o AS (SELECT id, min(least) AS least FROM l GROUP BY id)
SELECT max(n) AS blob FROM (SELECT count(*) AS n FROM o GROUP BY least)""")
def max_blob(spark, sf_dir):
    return metrics.largest_blob(views.pixel(spark, sf_dir), "k < 20")
