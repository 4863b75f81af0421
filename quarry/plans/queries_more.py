"""Queries over what stages hand on: scaling, mosaics, overlays, seams, tiles, gates of whole stages, report text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import views
from quarry.functions import geometry as g
from quarry.operators import metrics, raster, stats
from quarry.plans import gates
from quarry.plans.queries_raster import FACE_PX, FACES, OVERLAP, PX, VISIBLE, overlap, r6
from quarry.plans.queries_splats import KERNEL, MIRROR, TILE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(f"WITH {FACES} SELECT face, round(cos(radians(yaw)), 6) + 0.0::DOUBLE AS m00, round(-sin(radians(yaw)) * sin(radians(pitch)), 6) + 0.0::DOUBLE AS m01, round(sin(radians(yaw)) * cos(radians(pitch)), 6) + 0.0::DOUBLE AS m02, round(cos(radians(pitch)), 6) + 0.0::DOUBLE AS m11, round(sin(radians(pitch)), 6) + 0.0::DOUBLE AS m12, round(-sin(radians(yaw)), 6) + 0.0::DOUBLE AS m20 FROM f")
def rotation_matrix(spark, sf_dir):
    m = g.rotation("yaw", "pitch")
    faces = spark.sql("select * from values " + ", ".join(f"(cast({i} as bigint), {y}e0, {p}e0)" for i, y, p, _ in g.ring_faces()) + " as f(face, yaw, pitch)")
    return faces.select("face", *[(F.round(F.expr(m[i][j]), 6) + 0.0).alias(f"m{i}{j}") for i, j in ((0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 0))])


@query(f"WITH {PX} SELECT r, c, round(-ln(d + 1e-6), 6) AS log_depth, CASE WHEN sky THEN NULL ELSE (d * 2.5)::FLOAT END AS metric FROM pixel")
def depth_scaling(spark, sf_dir):
    """Disparity to log depth, and metric scaling at a stage's boundary."""
    return views.pixel(spark, sf_dir).select("r", "c", r6("log_depth", "-ln(d + 1e-6)"), F.when(~F.col("sky"), (F.col("d") * 2.5).cast("float")).alias("metric"))


@query(f"""WITH {PX}, s AS (SELECT unnest(range(0, w - 31, 24)) AS s FROM dim UNION SELECT w - 32 FROM dim), t AS (SELECT s.s, r, c, d + s.s * 0.1::DOUBLE AS v, least(c - s.s + 1, 32 - (c - s.s))::DOUBLE AS wt FROM pixel, s WHERE c >= s.s AND c < s.s + 32)
SELECT r, c, round(sum(v * wt) / greatest(sum(wt), 1e-12), 6) AS v, count(*) AS tiles FROM t GROUP BY r, c""")
def tile_mosaic(spark, sf_dir):
    """Overlapping tiles of what a model gives, feathered into one field."""
    px = views.pixel(spark, sf_dir)
    width = px.select("w").first()
    starts = g.tile_starts(width["w"] if width else 32, 32, 8)
    px = px.withColumn("s", F.explode(F.array(*[F.lit(s) for s in starts]))).where("c >= s and c < s + 32")
    px = px.withColumns({"v": F.col("d") + F.col("s") * 0.1, "wt": F.expr("cast(least(c - s + 1, 32 - (c - s)) as double)")})
    return px.groupBy("r", "c").agg(F.round(F.sum(F.col("v") * F.col("wt")) / F.greatest(F.sum("wt"), F.lit(1e-12)), 6).alias("v"), F.count("*").alias("tiles"))


@query(f"""WITH {PX}, o AS (SELECT dy, dx FROM range(-2, 3) y(dy), range(-2, 3) x(dx) WHERE abs(dy) + abs(dx) <= 2), m AS (SELECT r, c, h, w FROM pixel WHERE sky AND k < 20),
n AS (SELECT DISTINCT m.r + dy AS r, m.c + dx AS c FROM m, o) SELECT p.r, p.c, CASE WHEN p.sky AND p.k < 20 THEN round_even(0.5::DOUBLE * red + 0.5::DOUBLE * 255, 0)::INT WHEN n.r IS NOT NULL THEN 255 ELSE red END AS red,
  CASE WHEN p.sky AND p.k < 20 THEN round_even(0.5::DOUBLE * grn, 0)::INT WHEN n.r IS NOT NULL THEN 0 ELSE grn END AS grn FROM pixel p LEFT JOIN n ON n.r = p.r AND n.c = p.c""")
def overlay(spark, sf_dir):
    """A mask tinted red by half, with a red ring two steps wide."""
    px = raster.dilated(views.pixel(spark, sf_dir).withColumn("m", F.expr("sky and k < 20")), "m", 2)
    ring = F.col("m_dilated") & ~F.col("m")
    tint = lambda c, to: F.when(F.col("m"), F.rint(F.col(c) * 0.5 + 0.5 * to)).when(ring, to).otherwise(F.col(c)).cast("int")
    return px.select("r", "c", tint("red", 255).alias("red"), tint("grn", 0).alias("grn"))


@query(f"""WITH {OVERLAP}, p AS (SELECT abs(xi - xj) AS step, greatest(xi, xj) AS depth, base AS wt FROM overlap WHERE face_i < 8 AND face_j < 8), q AS (SELECT quantile_cont(depth, 0.9) AS cut FROM p),
n AS (SELECT step, wt FROM p, q WHERE depth <= cut), o AS (SELECT step, sum(wt) OVER (ORDER BY step, wt ROWS UNBOUNDED PRECEDING) AS run, sum(wt) OVER () AS total FROM n)
SELECT round(min(step) FILTER (WHERE run >= 0.5 * total), 6) AS step_log FROM o""")
def interface_step(spark, sf_dir):
    """The typical seam between neighbours of the ring."""
    ring = overlap(spark, sf_dir).where("face_i < 8 and face_j < 8")
    pairs = ring.select(F.abs(F.col("xi") - F.col("xj")).alias("step"), F.greatest("xi", "xj").alias("depth"), F.col("base").alias("wt"))
    return stats.interface_step(pairs).select(r6("step_log"))


@query(f"WITH {FACE_PX}, p AS (SELECT face, quantile_cont(exp(x), 0.9) AS cut FROM face_px GROUP BY face) SELECT f.face, count(*) AS n, count(*) FILTER (WHERE exp(f.x) > cut AND degrees({g.LAT.replace('r +', 'f.r +')}) > 0) AS far FROM face_px f JOIN p ON p.face = f.face, dim WHERE true GROUP BY f.face")
def face_sky(spark, sf_dir):
    """For each face, how much of it is farther than its own 90th percentile and above the horizon."""
    from quarry.plans.queries_raster import log_depth, weighted_px

    each = F.array(*[F.struct(F.lit(i).cast("long").alias("face"), log_depth(i).alias("x"), F.col(f"wt_{i}").alias("wt")) for i, *_ in g.ring_faces()])
    at = weighted_px(spark, sf_dir).select("r", "c", "h", F.inline(each)).where("wt > 0")
    cut = at.groupBy("face").agg(F.percentile(F.exp("x"), 0.9).alias("cut"))
    return at.join(F.broadcast(cut), "face").groupBy("face").agg(F.count("*").alias("n"), F.count_if((F.exp("x") > F.col("cut")) & (F.expr(g.PITCH_DEG) > 0)).alias("far"))


@query(f"""WITH {PX}, {VISIBLE}, v AS (SELECT * FROM vis WHERE edge AND parallax > pi() / h), o AS (SELECT dy, dx FROM range(-2, 3) y(dy), range(-2, 3) x(dx) WHERE abs(dy) + abs(dx) <= 2),
n AS (SELECT DISTINCT v.r + dy AS r, (v.c + dx + v.w) % v.w AS c FROM v, o)
SELECT round(sum(CASE WHEN n.r IS NOT NULL AND NOT sky THEN cos({g.LAT.replace('r +', 'p.r +')}) ELSE 0 END) / sum(cos({g.LAT.replace('r +', 'p.r +')})), 6) AS fraction, sum(CASE WHEN n.r IS NOT NULL AND NOT sky THEN cos({g.LAT.replace('r +', 'p.r +')}) ELSE 0 END) / sum(cos({g.LAT.replace('r +', 'p.r +')})) <= 0.05 AS pass
FROM pixel p LEFT JOIN n ON n.r = p.r AND n.c = p.c""")
def bg_solid_angle_gate(spark, sf_dir):
    from quarry.operators import layers

    px = layers.visible_edges(layers.occlusion_edges(views.pixel(spark, sf_dir), ieee=True))
    share = layers.background_band(px, 2).agg(stats.solid_angle("band").alias("fraction"))
    return gates.verdict(share, "bg_solid_angle").select(F.round(F.element_at("metrics", "fraction"), 6).alias("fraction"), "pass")


@query(f"""WITH {PX}, {KERNEL}, {TILE}, ct AS (SELECT t.r, t.c, y.k * x.k AS k, {MIRROR.format('(t.r + y.i)', 't.h')} AS r2, {MIRROR.format('(t.c + x.i)', 't.w')} AS c2 FROM tl t, kn y, kn x),
m AS (SELECT ct.r, ct.c, sum(k * a) AS ma, sum(k * b) AS mb, sum(k * a * a) AS aa, sum(k * b * b) AS bb, sum(k * a * b) AS ab FROM ct JOIN tl ON tl.r = r2 AND tl.c = c2 GROUP BY ALL),
s AS (SELECT r * 4 // z.h AS tj, c * 8 // z.w AS ti, avg((2 * ma * mb + 1e-4) * (2 * (ab - ma * mb) + 9e-4) / ((ma * ma + mb * mb + 1e-4) * ((aa - ma * ma) + (bb - mb * mb) + 9e-4))) AS s FROM m, dim d, LATERAL (SELECT d.h AS h, d.w AS w) z GROUP BY 1, 2)
SELECT round(min(s), 5) AS ssim_worst, round(avg(s), 5) AS ssim_mean, min(s) >= 0.30 AND avg(s) >= 0.55 AS pass FROM s""")
def fidelity_gate(spark, sf_dir):
    """Worst and mean tile of an image against its source."""
    px = views.pixel(spark, sf_dir).withColumns({"a": F.col("red") / 255.0, "b": ((F.col("red") + F.col("k")) % 256) / 255.0})
    size = F.broadcast(px.agg(F.max("h").alias("h"), F.max("w").alias("w")))
    tiles = metrics.ssim(px, "a", "b").crossJoin(size).groupBy(F.expr("r * 4 div h").alias("tj"), F.expr("c * 8 div w").alias("ti")).agg(F.avg("ssim").alias("s"))
    measured = tiles.agg(F.min("s").alias("ssim_worst"), F.avg("s").alias("ssim_mean"))
    out = gates.verdict(measured, "fidelity_at_origin")
    return out.select(*[F.round(F.element_at("metrics", k), 5).alias(k) for k in ("ssim_worst", "ssim_mean")], "pass")


@query(f"WITH {views.DETECTION_SQL}, s AS (SELECT face, max(score) FILTER (WHERE label = 'person') AS top FROM detection GROUP BY face) SELECT max(top) AS worst_score, (SELECT face FROM s WHERE top IS NOT NULL ORDER BY top DESC, face LIMIT 1) AS face, coalesce(max(top) < 0.5, false) AS pass FROM s")
def people_gate(spark, sf_dir):
    top = views.detection(spark, sf_dir).groupBy("face").agg(F.max(F.when(F.col("label") == "person", F.col("score"))).alias("top")).where("top is not null")
    worst = top.agg(*gates.worst(F.col("top"), F.col("face"), F.col("face")))
    return worst.select(F.col("worst").alias("worst_score"), F.col("worst_key").alias("face"), F.coalesce(F.col("worst") < 0.5, F.lit(False)).alias("pass"))


@query("""SELECT p_partkey AS id, CASE WHEN p_size <= 25 THEN 'n/a' ELSE printf('%.2fx', p_retailprice / (p_size + 0.1234::DOUBLE)) END AS ratio, 'brand=' || p_brand || ', size=' || p_size AS kv, to_base64(p_name::BLOB) AS name64 FROM part""")
def report_text(spark, sf_dir):
    """Ratios, key-value lines and embedded bytes of a report."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    ratio = F.when(F.col("p_size") <= 25, "n/a").otherwise(F.format_string("%.2fx", F.col("p_retailprice") / (F.col("p_size") + 0.1234)))
    pairs = F.array_sort(F.array(F.concat(F.lit("brand="), "p_brand"), F.concat(F.lit("size="), F.col("p_size").cast("string"))))
    return part.select(F.col("p_partkey").alias("id"), ratio.alias("ratio"), F.array_join(pairs, ", ").alias("kv"), F.base64(F.col("p_name").cast("binary")).alias("name64"))


@query(f"WITH {views.RECEIPT_SQL}, a AS (SELECT row_number() OVER (ORDER BY stage_idx) AS n, stage_idx FROM receipt WHERE status = 'F'), b AS (SELECT row_number() OVER (ORDER BY stage_idx) AS n, stage_idx FROM receipt WHERE status = 'O') SELECT n::INT AS n, a.stage_idx AS a, b.stage_idx AS b FROM a FULL JOIN b USING (n)")
def zip_longest_stages(spark, sf_dir):
    """Two runs' stages side by side by their place, the longer one going on alone."""
    from pyspark.sql import Window as W

    of = lambda s, c: views.receipt(spark, sf_dir).where(f"status = '{s}'").select(F.row_number().over(W.orderBy("stage_idx")).alias("n"), F.col("stage_idx").alias(c))
    return of("F", "a").join(of("O", "b"), "n", "full_outer")


@query(f"WITH {PX} SELECT event_type, count(*) AS n, round(quantile_cont(d, 0.01), 6) AS p1, round(quantile_cont(d, 0.1), 6) AS p10, round(median(d), 6) AS p50, round(quantile_cont(d, 0.9), 6) AS p90, round(quantile_cont(d, 0.99), 6) AS p99 FROM pixel GROUP BY event_type")
def depth_percentiles(spark, sf_dir):
    q = F.percentile("d", F.array(*[F.lit(v) for v in (0.01, 0.1, 0.5, 0.9, 0.99)])).alias("q")
    at = views.pixel(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("n"), q)
    return at.select("event_type", "n", *[F.round(F.element_at("q", i + 1), 6).alias(k) for i, k in enumerate(("p1", "p10", "p50", "p90", "p99"))])


@query(f"WITH {PX}, m AS (SELECT median(d) AS med FROM pixel) SELECT round(med, 6) AS median_d, round((SELECT median(abs(d - med)) FROM pixel), 6) AS mad FROM m")
def median_mad(spark, sf_dir):
    px = views.pixel(spark, sf_dir)
    med = px.agg(F.percentile("d", 0.5).alias("med"))
    return px.crossJoin(F.broadcast(med)).groupBy("med").agg(F.percentile(F.abs(F.col("d") - F.col("med")), 0.5).alias("mad")).select(F.round("med", 6).alias("median_d"), F.round("mad", 6).alias("mad"))
