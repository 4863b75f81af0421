"""PLY files of splats: scan and sink, with a fixed record and a strict header.

Files are read with Spark's binary reader, so they can lie in any store Spark
reaches; a file is a task, and many scenes are many files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The record's properties in order.
FLOATS = ("x", "y", "z", "nx", "ny", "nz", "f_dc_0", "f_dc_1", "f_dc_2", "opacity", "scale_0", "scale_1", "scale_2", "rot_0", "rot_1", "rot_2", "rot_3")
BYTES = ("layer", "origin_stage")
SCHEMA = "name string, ord bigint, " + ", ".join(f"{c} float" for c in FLOATS) + ", layer tinyint, origin_stage tinyint"


def record(standard: bool = False) -> np.dtype:
    """70 bytes; without the two of ours, 68."""
    return np.dtype([(c, "<f4") for c in FLOATS] + ([] if standard else [(c, "u1") for c in BYTES]))


def header(n: int, standard: bool = False) -> bytes:
    lines = ["ply", "format binary_little_endian 1.0", f"element vertex {n}", *[f"property float {c}" for c in FLOATS], *([] if standard else [f"property uchar {c}" for c in BYTES]), "end_header"]
    return ("\n".join(lines) + "\n").encode()


def decode(content: bytes) -> np.ndarray:
    """Records of a file; ValueError for any other header or a size that doesn't fit."""
    head, mark, body = content.partition(b"end_header\n")
    lines = head.decode("ascii", "replace").split("\n")
    n = next((int(x.split()[2]) for x in lines if x.startswith("element vertex ")), -1)
    for standard in (False, True):
        if n >= 0 and head + mark == header(n, standard):
            if len(body) != n * record(standard).itemsize:
                raise ValueError("PLY body has the wrong size")
            return np.frombuffer(body, record(standard))
    raise ValueError("PLY header isn't the fixed one")


def encode(rows: dict[str, np.ndarray], standard: bool = False) -> bytes:
    """A file's bytes; quaternions become canonical. ValueError for non-finite numbers."""
    n = len(rows["x"])
    out = np.zeros(n, record(standard))
    quat = np.stack([np.asarray(rows[f"rot_{i}"], np.float64) for i in range(4)], 1)
    quat /= np.maximum(np.linalg.norm(quat, axis=1, keepdims=True), 1e-12)
    quat[quat[:, 0] < 0] *= -1
    for c in out.dtype.names or ():
        out[c] = quat[:, int(c[-1])] if c.startswith("rot_") else rows[c]
        if c in FLOATS and not np.isfinite(out[c]).all():
            raise ValueError(f"PLY column {c} isn't finite")
    return header(n, standard) + out.tobytes()


def read_ply(spark: SparkSession, path: str) -> DataFrame:
    """(name, ord, ...) of all files under a path; ``ord`` is the place in the file, which is data."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = decode(content)
                cols = [pa.array([name] * len(rows)), pa.array(np.arange(len(rows)))] + [pa.array(np.ascontiguousarray(rows[c])) for c in FLOATS]
                cols += [pa.array(rows[c].astype(np.int8) if c in (rows.dtype.names or ()) else np.zeros(len(rows), np.int8)) for c in BYTES]
                yield pa.RecordBatch.from_arrays(cols, ["name", "ord", *FLOATS, *BYTES])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(parse, SCHEMA)


def to_ply(splats: DataFrame, by: str, standard: bool = False) -> DataFrame:
    """(by, content): a file's bytes for each scene, in order of ``ord``."""

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("ord")
        content = encode({c: rows.column(c).to_numpy() for c in (*FLOATS, *BYTES)}, standard)
        return pa.table({by: rows.column(by)[:1], "content": pa.array([content], pa.binary())})

    kind = dict(splats.dtypes)[by]
    return splats.select(by, "ord", *[F.col(c).cast("float") for c in FLOATS], *[F.col(c).cast("tinyint") for c in BYTES]).groupBy(by).applyInArrow(pack, f"{by} {kind}, content binary")


def write_ply(splats: DataFrame, path: str, standard: bool = False) -> None:
    """One scene to one file, through the driver: a scene is bounded by its cap on splats."""
    rows = splats.withColumn("scene", F.lit(0)).transform(lambda d: to_ply(d, "scene", standard)).collect()
    content = bytes(rows[0]["content"]) if rows else header(0, standard)
    jvm = splats.sparkSession._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(splats.sparkSession._jsparkSession.sessionState().newHadoopConf()).create(target, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()
