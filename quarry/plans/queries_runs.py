"""Queries over provenance, gates, dimension tables and sweeps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import views
from quarry.functions import geometry as g
from quarry.plans import gates, provenance, sweep
from quarry.plans.queries_raster import PX

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
RC = views.RECEIPT_SQL


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small dimension table in the plan itself."""
    text = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}e0" if isinstance(v, float) else str(v) for v in row) + ")" for row in rows)
    return spark.sql(f"select * from values {text} as t({schema})")


@query("WITH f(face) AS (SELECT unnest(range(0, 8))) SELECT face::INT AS face, face * 45.0::DOUBLE AS yaw, 0.0::DOUBLE AS pitch, 100.0::DOUBLE AS fov FROM f UNION ALL VALUES (8, 0.0::DOUBLE, 90.0::DOUBLE, 100.0::DOUBLE), (9, 0.0::DOUBLE, -90.0::DOUBLE, 100.0::DOUBLE)")
def ring_faces(spark, sf_dir):
    return _values(spark, g.ring_faces(), "face, yaw, pitch, fov")


@query("WITH f AS (SELECT unnest(range(0, 8)) AS i) SELECT i::INT AS i, ((i + 1) % 8)::INT AS j FROM f UNION ALL SELECT i::INT, 8 FROM f UNION ALL SELECT i::INT, 9 FROM f")
def face_adjacency(spark, sf_dir):
    return _values(spark, g.ring_adjacency(), "i, j")


@query("VALUES ('center', 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE), ('xpos', 0.5, 0, 0), ('xneg', -0.5, 0, 0), ('zpos', 0, 0, 0.5), ('zneg', 0, 0, -0.5), ('up', 0, 0.2, 0), ('squat', 0, -0.9, 0)".replace("VALUES", "SELECT * FROM (VALUES", 1) + ") t(pose, x, y, z)")
def head_poses(spark, sf_dir):
    return _values(spark, g.head_poses(), "pose, x, y, z")


@query("SELECT i::INT AS i, j::INT AS j, -180 + (i + 0.5::DOUBLE) * 45 AS yaw, 90 - (j + 0.5::DOUBLE) * 45 AS pitch, 51.0::DOUBLE AS fov FROM range(0, 8) a(i), range(0, 4) b(j)")
def tile_views(spark, sf_dir):
    return _values(spark, g.tile_views(), "i, j, yaw, pitch, fov")


@query("SELECT unnest([0, 454, 482])::INT AS start, 518 AS size")
def tile_plan(spark, sf_dir):
    return _values(spark, [(s, 518) for s in g.tile_starts(1000, 518, 64)], "start, size")


RAY = "SELECT u::INT AS u, v::INT AS v, (u - 7.5::DOUBLE) / 8 AS x, (7.5::DOUBLE - v) / 8 AS y FROM range(0, 16) a(u), range(0, 16) b(v)"


@query(f"WITH q AS ({RAY}) SELECT u, v, round(x / sqrt(x * x + y * y + 1), 6) AS dx, round(y / sqrt(x * x + y * y + 1), 6) AS dy, round(1 / sqrt(x * x + y * y + 1), 6) AS dz FROM q")
def perspective_rays(spark, sf_dir):
    """Unit rays of a 16-pixel camera of 90 degrees."""
    grid = spark.range(256).select((F.col("id") % 16).cast("int").alias("u"), F.floor(F.col("id") / 16).cast("int").alias("v"))
    focal = 8.0
    grid = grid.withColumns({"x": (F.col("u") - 7.5) / focal, "y": (7.5 - F.col("v")) / focal}).withColumn("n", F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + 1))
    return grid.select("u", "v", F.round(F.col("x") / F.col("n"), 6).alias("dx"), F.round(F.col("y") / F.col("n"), 6).alias("dy"), F.round(1 / F.col("n"), 6).alias("dz"))


@query(f"""WITH {RC}, i AS (SELECT * FROM artifact WHERE kind = 'input'), o AS (SELECT * FROM artifact WHERE kind = 'output'),
j AS (SELECT i.stage_idx, i.path, i.sha, i.line, (SELECT max(o.stage_idx) FROM o WHERE o.path = i.path AND o.stage_idx < i.stage_idx) AS producer FROM i)
SELECT stage_idx, path, line FROM j WHERE producer IS NULL""")
def missing_producer(spark, sf_dir):
    return provenance.incoherent(views.artifact(spark, sf_dir)).where("fault = 'no producer'").select("stage_idx", "path", "line")


@query(f"""WITH {RC}, i AS (SELECT *, row_number() OVER () AS id FROM artifact WHERE kind = 'input'), o AS (SELECT * FROM artifact WHERE kind = 'output'),
j AS (SELECT i.stage_idx, i.path, i.sha, i.line, o.stage_idx AS producer, o.sha AS made, row_number() OVER (PARTITION BY i.id ORDER BY o.stage_idx DESC, o.line DESC) AS n FROM i JOIN o ON o.path = i.path AND o.stage_idx < i.stage_idx)
SELECT stage_idx, path, line, producer FROM j WHERE n = 1 AND made <> sha""")
def stale_chain(spark, sf_dir):
    return provenance.incoherent(views.artifact(spark, sf_dir)).where("fault = 'stale'").select("stage_idx", "path", "line", "producer")


OTHER = "b AS (SELECT stage_idx, kind, path, CASE WHEN state = 'O' AND flag = 'A' THEN sha + 1 ELSE sha END AS sha, line FROM artifact WHERE flag <> 'R')"


@query(f"""WITH {RC}, {OTHER} SELECT stage_idx, kind, path, line, a.sha AS sha_a, b.sha AS sha_b FROM artifact a FULL JOIN b USING (stage_idx, kind, path, line) WHERE a.sha IS DISTINCT FROM b.sha""")
def run_diff(spark, sf_dir):
    a = views.artifact(spark, sf_dir)
    b = a.where("flag <> 'R'").withColumn("sha", F.when((F.col("state") == "O") & (F.col("flag") == "A"), F.col("sha") + 1).otherwise(F.col("sha")))
    return provenance.run_difference(a, b)


@query(f"WITH {RC} SELECT s.o_orderkey AS stage_idx FROM (SELECT o_orderkey FROM orders) s WHERE o_orderkey NOT IN (SELECT stage_idx FROM receipt WHERE status <> 'P')")
def missing_receipts(spark, sf_dir):
    registry = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("stage_idx"))
    return provenance.missing_stages(registry, views.receipt(spark, sf_dir).where("status <> 'P'"))


@query("""WITH pin AS (SELECT c_custkey AS name FROM customer), f AS (SELECT DISTINCT l_partkey AS name FROM lineitem)
SELECT name, 'missing' AS fault FROM pin WHERE name NOT IN (SELECT name FROM f) UNION ALL SELECT name, 'unpinned' FROM f WHERE name NOT IN (SELECT name FROM pin)""")
def pins_anti(spark, sf_dir):
    pinned = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("name"))
    found = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_partkey").alias("name")).distinct()
    return provenance.pin_faults(pinned, found)


@query(f"WITH {RC} SELECT count(*) AS total, count(*) FILTER (WHERE passed) AS passed, bool_and(passed) AS all_pass, count(*) > 0 AND count(*) = count(*) FILTER (WHERE passed) AS shippable FROM receipt")
def gate_summary(spark, sf_dir):
    return gates.summary(views.receipt(spark, sf_dir).select(F.col("passed").alias("pass")))


@query("SELECT p_partkey AS id, sha256(p_name) AS sha, regexp_full_match(p_name, '[a-z ]+') AS plain FROM part")
def sha_rows(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("id"), F.sha2("p_name", 256).alias("sha"), F.col("p_name").rlike("^[a-z ]+$").alias("plain"))


@query("""WITH p AS (SELECT p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN '/' || p_type WHEN 1 THEN 'a/../' || p_type WHEN 2 THEN 'a\\' || p_type WHEN 3 THEN '..' ELSE p_type END AS path,
  CASE p_partkey % 6 WHEN 4 THEN upper(sha256(p_name)) ELSE sha256(p_name) END AS sha FROM part)
SELECT id, path FROM p WHERE path = '' OR starts_with(path, '/') OR list_contains(string_split(path, '/'), '..') OR contains(path, '\\') OR NOT regexp_full_match(sha, '[0-9a-f]{64}')""")
def receipt_policy(spark, sf_dir):
    """Five of six rows break a rule: absolute, upwards (twice), a backslash, a digest in capitals."""
    path = "case p_partkey % 6 when 0 then concat('/', p_type) when 1 then concat('a/../', p_type) when 2 then concat('a', chr(92), p_type) when 3 then '..' else p_type end"
    sha = "case p_partkey % 6 when 4 then upper(sha2(p_name, 256)) else sha2(p_name, 256) end"
    part = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr("p_partkey as id", f"{path} as path", f"{sha} as sha256")
    return provenance.receipt_faults(part).select("id", "path")


GRID = "g AS (SELECT ((a.i * 2 + b.i) * 3 + c.i) * 2 + d.i AS idx, [0.85, 1.15, 1.35][a.i + 1]::DOUBLE AS scale, [0.1, 0.15][b.i + 1]::DOUBLE AS flatten, [1, 2, 3][c.i + 1]::DOUBLE AS stride, [0.02, 0.05][d.i + 1]::DOUBLE AS floor FROM range(0, 3) a(i), range(0, 2) b(i), range(0, 3) c(i), range(0, 2) d(i))"


@query(f"WITH {GRID} SELECT idx, scale, flatten, stride, floor FROM g")
def sweep_grid(spark, sf_dir):
    of = lambda k: F.element_at("overrides", k)
    return sweep.grid(spark).select("idx", of("s4.scale_multiplier").alias("scale"), of("s4.flatten").alias("flatten"), of("s4.base_stride").alias("stride"), of("s6.opacity_floor").alias("floor"))


SCORES = f"{PX}, sc AS (SELECT (r * w + c) % 36 AS idx, round(avg(k) / 100, 2) AS ssim_mean, min(d) AS ssim_worst, count(*) AS final_count FROM pixel GROUP BY 1)"


@query(f"WITH {SCORES} SELECT idx, ssim_mean, ssim_worst, (row_number() OVER (ORDER BY ssim_mean DESC NULLS LAST, ssim_worst DESC NULLS LAST, idx))::INT AS rank FROM sc")
def sweep_rank(spark, sf_dir):
    return sweep.ranked(_scores(spark, sf_dir)).select("idx", "ssim_mean", "ssim_worst", "rank")


@query(f"WITH {SCORES} SELECT idx, ssim_mean FROM sc ORDER BY ssim_mean DESC NULLS LAST, ssim_worst DESC NULLS LAST, idx LIMIT 1")
def sweep_best(spark, sf_dir):
    return sweep.best(_scores(spark, sf_dir)).select("idx", "ssim_mean")


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = views.pixel(spark, sf_dir).groupBy(F.expr("(r * w + c) % 36").alias("idx"))
    return at.agg(F.round(F.avg("k") / 100, 2).alias("ssim_mean"), F.min("d").alias("ssim_worst"), F.count("*").alias("final_count"))


@query("""SELECT event_id AS id, coalesce(json_extract_string(props, '$.ssim_mean')::DOUBLE, json_extract_string(props, '$.k')::DOUBLE) AS score, coalesce(json_extract_string(props, '$.k')::DOUBLE, 0) / nullif(value, 0) AS ratio FROM events""")
def override_lookup(spark, sf_dir):
    """A metric by the first of its names that a document has."""
    props = F.from_json("props", "map<string,double>").alias("m")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "value", props).select(F.col("event_id").alias("id"), sweep.score("m", "ssim_mean", "k").alias("score"), F.try_divide(sweep.score("m", "k"), "value").alias("ratio"))


MEASURED = f"{PX}, ms AS (SELECT event_type AS run, avg(k) / 1000 AS edge_density, count(*) AS final_count, 1000000 AS sog_bytes, max(d) / 1e5 AS worst_energy FROM pixel GROUP BY 1)"


@query(f"WITH {MEASURED} SELECT run, 'watermark' AS gate, edge_density <= 0.10 AS pass FROM ms UNION ALL SELECT run, 'budgets', final_count <= 1000000 AND sog_bytes <= 60 * 1048576 FROM ms UNION ALL SELECT run, 'jitter', worst_energy <= 0.02 FROM ms")
def gate_verdicts(spark, sf_dir):
    at = views.pixel(spark, sf_dir).groupBy(F.col("event_type").alias("run"))
    ms = at.agg((F.avg("k") / 1000).alias("edge_density"), F.count("*").alias("final_count"), F.lit(1000000).alias("sog_bytes"), (F.max("d") / 1e5).alias("worst_energy"))
    out = None
    for name in ("watermark", "budgets", "jitter"):
        one = ms.select("run", F.lit(name).alias("gate"), F.coalesce(F.expr(gates.GATES[name][1]), F.lit(False)).alias("pass"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"WITH {PX}, v AS (SELECT event_type AS view, avg(k) AS score, min(r * w + c) AS place FROM pixel GROUP BY 1) SELECT max(score) AS worst, (SELECT view FROM v ORDER BY score DESC, place LIMIT 1) AS worst_key FROM v")
def worst_view(spark, sf_dir):
    v = views.pixel(spark, sf_dir).groupBy(F.col("event_type").alias("view")).agg(F.avg("k").alias("score"), F.min(F.expr("r * w + c")).alias("place"))
    return v.agg(*gates.worst(F.col("score"), F.col("view"), F.col("place")))


SIDES = """a AS (SELECT (k % 5)::VARCHAR AS gate, avg(d) AS m, avg(k) > 50 AS good FROM pixel WHERE k % 5 <> 0 GROUP BY 1), b AS (SELECT (k % 5)::VARCHAR AS gate, avg(d) + 1 AS m, avg(k) > 49 AS good FROM pixel WHERE k % 5 <> 1 GROUP BY 1)"""


@query(f"WITH {PX}, {SIDES} SELECT coalesce(a.gate, b.gate) AS gate, 'mean' AS metric, round(a.m, 6) AS value, round(b.m, 6) AS accepted, a.good AS pass, b.good AS accepted_pass FROM a FULL JOIN b ON a.gate = b.gate")
def versus_accepted(spark, sf_dir):
    """Two runs' verdicts side by side; each lacks a gate that the other has."""
    from quarry.plans.runner import versus_accepted as beside

    px = views.pixel(spark, sf_dir).withColumn("gate", (F.col("k") % 5).cast("string"))
    side = lambda gone, more, least: px.where(f"gate <> '{gone}'").groupBy("gate").agg(F.create_map(F.lit("mean"), F.round(F.avg("d") + more, 6)).alias("metrics"), (F.avg("k") > least).alias("pass"))
    return beside(side("0", 0, 50), side("1", 1, 49))
