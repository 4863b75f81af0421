"""The engine's tables as views over the star schema, for queries and benchmarks.

``pixel`` is a dense raster of all events, ``splat`` a cloud from embeddings,
``detection`` boxes from labels, ``receipt`` and ``artifact`` provenance rows
from orders and their lines.  Each has the same definition in Spark and, as a
common table expression, in SQL for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PIXEL_SQL = """num AS (SELECT count(*)::BIGINT AS n FROM events),
dim AS (SELECT max(t.h)::BIGINT AS h, max(n)::BIGINT // max(t.h)::BIGINT AS w FROM num, range(1, (SELECT floor(sqrt(n / 2.0))::BIGINT + 2 FROM num)) t(h) WHERE n % t.h = 0 AND 2 * t.h * t.h <= greatest(n, 2)),
pixel AS (SELECT event_id // w AS r, event_id % w AS c, h, w, value AS d,
    floor((value * 7) % 256)::INT AS red, ((json_extract_string(props, '$.k')::BIGINT * 2) % 256)::INT AS grn, ((event_id * 31) % 256)::INT AS blu,
    (event_type = 'error' AND event_id // w < h / 2.0) AS sky, event_type, json_extract_string(props, '$.k')::BIGINT AS k
  FROM events, dim)"""


def raster_size(n: int) -> tuple[int, int]:
    """Height and width of a raster of exactly n pixels: the largest height that divides n, at most half the width."""
    h = next((h for h in range(int((n / 2) ** 0.5), 0, -1) if n % h == 0), 1)
    return h, n // h


def pixel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(r, c, h, w, d, red, grn, blu, sky, event_type, k): every event is a pixel; height and width come from one count."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    h, w = raster_size(events.count())
    k = F.get_json_object("props", "$.k").cast("long")
    px = events.select(
        F.expr(f"event_id div {max(w, 1)}").alias("r"), (F.col("event_id") % max(w, 1)).alias("c"), F.lit(h).cast("long").alias("h"), F.lit(w).cast("long").alias("w"), F.col("value").alias("d"),
        F.floor((F.col("value") * 7) % 256).cast("int").alias("red"), ((k * 2) % 256).cast("int").alias("grn"), ((F.col("event_id") * 31) % 256).cast("int").alias("blu"), "event_type", k.alias("k"),
    )
    return px.withColumn("sky", (F.col("event_type") == "error") & (F.col("r") < F.col("h") / 2))


SPLAT_SQL = """splat AS (SELECT vec_id AS ord, e[1]::DOUBLE * 10 AS x, e[2]::DOUBLE * 10 AS y, e[3]::DOUBLE * 10 AS z,
    e[4]::DOUBLE / nn AS nx, e[5]::DOUBLE / nn AS ny, e[6]::DOUBLE / nn AS nz, e[7]::DOUBLE AS f_dc_0, e[8]::DOUBLE AS f_dc_1, e[9]::DOUBLE AS f_dc_2,
    e[10]::DOUBLE * 20 AS opacity, -3 + e[11]::DOUBLE AS scale_0, -3 + e[12]::DOUBLE AS scale_1, -3 + e[13]::DOUBLE AS scale_2,
    sg * e[14]::DOUBLE / qn AS rot_0, sg * e[15]::DOUBLE / qn AS rot_1, sg * e[16]::DOUBLE / qn AS rot_2, sg * e[17]::DOUBLE / qn AS rot_3, (label % 3)::INT AS layer
  FROM (SELECT vec_id, label, embedding AS e, greatest(sqrt(embedding[4]::DOUBLE * embedding[4]::DOUBLE + embedding[5]::DOUBLE * embedding[5]::DOUBLE + embedding[6]::DOUBLE * embedding[6]::DOUBLE), 1e-12) AS nn,
      greatest(sqrt(embedding[14]::DOUBLE * embedding[14]::DOUBLE + embedding[15]::DOUBLE * embedding[15]::DOUBLE + embedding[16]::DOUBLE * embedding[16]::DOUBLE + embedding[17]::DOUBLE * embedding[17]::DOUBLE), 1e-12) AS qn,
      CASE WHEN embedding[14] < 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS sg FROM embeddings) t)"""


def splat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ord, x, y, z, nx, ny, nz, f_dc_0..2, opacity, scale_0..2, rot_0..3, layer)."""
    raw = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("vec_id is not null and size(embedding) >= 17")
    e = [F.element_at("embedding", i + 1).cast("double").alias(f"e{i + 1}") for i in range(17)]
    v = raw.select(F.col("vec_id").alias("ord"), (F.col("label") % 3).cast("int").alias("layer"), *e)
    v = v.withColumns({"nn": F.expr("greatest(sqrt(e4 * e4 + e5 * e5 + e6 * e6), 1e-12)"), "qn": F.expr("greatest(sqrt(e14 * e14 + e15 * e15 + e16 * e16 + e17 * e17), 1e-12)"), "sg": F.expr("if(e14 < 0, -1e0, 1e0)")})
    return v.selectExpr(
        "ord", "e1 * 10 as x", "e2 * 10 as y", "e3 * 10 as z", "e4 / nn as nx", "e5 / nn as ny", "e6 / nn as nz", "e7 as f_dc_0", "e8 as f_dc_1", "e9 as f_dc_2", "e10 * 20 as opacity",
        "-3 + e11 as scale_0", "-3 + e12 as scale_1", "-3 + e13 as scale_2", *[f"sg * e{14 + i} / qn as rot_{i}" for i in range(4)], "layer",
    )


DETECTION_SQL = """detection AS (SELECT l.doc_id % 10 AS face, l.doc_id AS box, ((l.doc_id * 37) % 100) / 100.0::DOUBLE AS score, CASE WHEN l.doc_id % 3 = 0 THEN 'chair' ELSE 'person' END AS label,
    ((l.doc_id * 13) % 500)::DOUBLE AS x0, ((l.doc_id * 29) % 500)::DOUBLE AS y0, ((l.doc_id * 13) % 500 + 20 + n_chars % 60)::DOUBLE AS x1, ((l.doc_id * 29) % 500 + 20 + n_chars % 90)::DOUBLE AS y1
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(face, box, score, label, x0, y0, x1, y1): boxes on faces of 640 pixels."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "n_chars")
    both = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id").join(docs, "doc_id")
    return both.selectExpr(
        "doc_id % 10 as face", "doc_id as box", "((doc_id * 37) % 100) / 100e0 as score", "if(doc_id % 3 = 0, 'chair', 'person') as label",
        "cast((doc_id * 13) % 500 as double) as x0", "cast((doc_id * 29) % 500 as double) as y0", "cast((doc_id * 13) % 500 + 20 + n_chars % 60 as double) as x1", "cast((doc_id * 29) % 500 + 20 + n_chars % 90 as double) as y1",
    )


RECEIPT_SQL = """receipt AS (SELECT o_orderkey AS stage_idx, o_orderstatus AS status, (o_totalprice > 100000) AS passed FROM orders),
artifact AS (SELECT l_orderkey AS stage_idx, CASE WHEN l_linenumber % 2 = 0 THEN 'input' ELSE 'output' END AS kind, l_partkey AS path, l_suppkey AS sha, l_linenumber AS line, l_returnflag AS flag, l_linestatus AS state FROM lineitem)"""


def receipt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(stage_idx, status, passed): one row for each stage that has run."""
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("stage_idx"), F.col("o_orderstatus").alias("status"), (F.col("o_totalprice") > 100000).alias("passed"))


def artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(stage_idx, kind, path, sha, line, flag, state): inputs and outputs of stages."""
    kind = F.when(F.col("l_linenumber") % 2 == 0, "input").otherwise("output").alias("kind")
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_orderkey").alias("stage_idx"), kind, F.col("l_partkey").alias("path"), F.col("l_suppkey").alias("sha"), F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("state"))
