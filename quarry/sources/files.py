"""Rasters, masks, arrays and JSON documents as tables, from any store that Spark reads."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Schemas of documents.
SIDECAR = "source string, license_id string, scope_note string, camera_height_m double"
PANO_META = "width int, height int, source_sha256 string, license struct<source: string, license_id: string, scope_note: string>, camera_height_m double"
BOXES = "total_hits int, views array<struct<name: string, yaw_deg: double, pitch_deg: double, fov_deg: double, boxes: array<struct<xyxy: array<double>, score: double>>>>"
RECEIPT = "stage string, code struct<git_sha: string, dirty: boolean>, inputs map<string, struct<path: string, sha256: string>>, outputs map<string, struct<path: string, sha256: string>>, params_hash string, gates array<struct<gate: string, pass: boolean>>"


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(name, r, c, h, w, red, grn, blu) of images, by Spark's image source; metadata is ignored."""
    img = spark.read.format("image").option("dropInvalid", False).load(path).select("image.*").where("nChannels in (1, 3, 4)")
    at = img.select(F.col("origin").alias("name"), F.col("height").cast("long").alias("h"), F.col("width").cast("long").alias("w"), "nChannels", "data").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("h") * F.col("w") - 1)).alias("i"))
    byte = lambda k: F.conv(F.hex(F.substring("data", (F.col("i") * F.col("nChannels") + k + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    one = F.col("nChannels") == 1
    return at.select("name", F.expr("i div w").alias("r"), F.expr("i % w").alias("c"), "h", "w", F.when(one, byte(0)).otherwise(byte(2)).alias("red"), F.when(one, byte(0)).otherwise(byte(1)).alias("grn"), byte(0).alias("blu"))


def mask_of(gray: str = "gray"):
    """A mask of 8-bit values: 128 and more."""
    return F.col(gray) >= 128


def read_npy(spark: SparkSession, path: str) -> DataFrame:
    """(name, r, c, h, w, d) of two-dimensional arrays; infinities stay."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a = np.load(io.BytesIO(content), allow_pickle=False)
                if a.ndim != 2:
                    raise ValueError(f"{name}: {a.ndim} dimensions")
                r, c = np.divmod(np.arange(a.size), a.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array([name] * a.size), pa.array(r), pa.array(c), pa.array(np.full(a.size, a.shape[0])), pa.array(np.full(a.size, a.shape[1])), pa.array(a.ravel().astype(np.float64))], ["name", "r", "c", "h", "w", "d"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(parse, "name string, r bigint, c bigint, h bigint, w bigint, d double")


def to_npy(px: DataFrame, by: str, value: str = "d") -> DataFrame:
    """(by, content): a 32-bit array file for each raster."""

    def pack(rows: pa.Table) -> pa.Table:
        a = np.zeros((rows.column("h")[0].as_py(), rows.column("w")[0].as_py()), np.float32)
        a[rows.column("r").to_numpy(), rows.column("c").to_numpy()] = rows.column(value).to_numpy()
        held = io.BytesIO()
        np.save(held, a)
        return pa.table({by: rows.column(by)[:1], "content": pa.array([held.getvalue()], pa.binary())})

    return px.select(by, "r", "c", "h", "w", value).groupBy(by).applyInArrow(pack, f"{by} {dict(px.dtypes)[by]}, content binary")


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents of a declared schema; a document that doesn't fit fails the read."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def sources_without_sidecar(sources: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Sources that must not be used: no sidecar, or one without a license id or with a camera height out of (0, 10]."""
    good = sidecars.where("license_id is not null and license_id <> '' and (camera_height_m is null or (camera_height_m > 0 and camera_height_m <= 10))")
    return sources.join(good.select("source"), "source", "left_anti")


def verified_files(spark: SparkSession, path: str, pins: DataFrame) -> DataFrame:
    """(name, sha256, ok) of files held against pinned digests (name, sha256)."""
    found = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("found"))
    return pins.join(found, "name", "left").select("name", "sha256", F.coalesce(F.col("found") == F.col("sha256"), F.lit(False)).alias("ok"))
