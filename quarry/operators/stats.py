"""Aggregates over rasters: exact percentiles, weighted percentiles, robust fits, solid angles."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.functions import geometry as g


def exact_percentile(value: Column | str, q: float) -> Column:
    """With linear interpolation; infinities take part."""
    return F.percentile(value, q)


def weighted_percentile(df: DataFrame, value: str, weight: str, q: float, by: Sequence[str] = ()) -> DataFrame:
    """(by, ``percentile``): the first value, in order, whose running weight reaches q of the total.

    The plain median if the total isn't positive, 0 if there are no rows (without ``by``).
    """
    order = W.partitionBy(*by).orderBy(value, weight)
    run = F.sum(weight).over(order.rowsBetween(W.unboundedPreceding, 0))
    total = F.sum(weight).over(W.partitionBy(*by))
    at = df.withColumns({"_run": run, "_total": total})
    found = F.min(F.when(F.col("_run") >= F.lit(q) * F.col("_total"), F.col(value)))
    out = at.groupBy(*by).agg(F.when(F.max("_total") > 0, found).otherwise(F.percentile(value, 0.5)).alias("percentile"))
    return out if by else out.select(F.coalesce("percentile", F.lit(0.0)).alias("percentile"))


def solid_angle(mask: str) -> Column:
    """Share of the sphere that a mask covers."""
    return F.sum(F.when(F.expr(mask), F.cos(F.expr(g.LAT))).otherwise(0.0)) / F.greatest(F.sum(F.cos(F.expr(g.LAT))), F.lit(1e-12))


def share(condition: Column, empty: float) -> Column:
    """Share of rows that meet a condition; ``empty`` if there are none."""
    return F.coalesce(F.avg(condition.cast("double")), F.lit(empty))


def interface_step(pairs: DataFrame) -> DataFrame:
    """(``step_log``): the weighted median seam of pairs (``step``, ``depth``, ``wt``), without the farthest tenth."""
    cut = pairs.agg(F.percentile("depth", 0.9).alias("cut"))
    near = pairs.crossJoin(F.broadcast(cut)).where("depth <= cut")
    return weighted_percentile(near, "step", "wt", 0.5).withColumnRenamed("percentile", "step_log")


def dynamic_range(value: str = "d") -> Column:
    return F.percentile(value, 0.99) / F.greatest(F.percentile(value, 0.01), F.lit(1e-9))


def _moments(df: DataFrame, weight: Column) -> dict[str, float]:
    terms = {"w": F.lit(1.0), "xx": F.col("x") * F.col("x"), "xz": F.col("x") * F.col("z"), "zz": F.col("z") * F.col("z"), "x": F.col("x"), "z": F.col("z"), "xy": F.col("x") * F.col("y"), "zy": F.col("z") * F.col("y"), "y": F.col("y")}
    row = df.agg(*[F.sum(weight * v).alias(k) for k, v in terms.items()]).first()
    return {k: row[k] or 0.0 for k in terms}


def _solved(m: dict[str, float]) -> np.ndarray:
    a = np.array([[m["xx"], m["xz"], m["x"]], [m["xz"], m["zz"], m["z"]], [m["x"], m["z"], m["w"]]])
    return np.linalg.lstsq(a, np.array([m["xy"], m["zy"], m["y"]]), rcond=None)[0]


def ground_plane(points: DataFrame, rounds: int = 20) -> tuple[tuple[float, float, float], DataFrame]:
    """Coefficients (a, b, c) of y = a x + b z + c by Tukey's biweight, and the points with ``res`` and ``inlier``.

    Each round is one median and one set of nine sums; only these reach the driver.
    """
    points = points.select("x", "y", "z").persist()
    coef = _solved(_moments(points, F.lit(1.0)))
    res = lambda k: F.col("y") - (F.lit(float(k[0])) * F.col("x") + F.lit(float(k[1])) * F.col("z") + F.lit(float(k[2])))
    spread = lambda k: 4.685 * 1.4826 * max(points.agg(F.percentile(F.abs(res(k)), 0.5)).first()[0] or 0.0, 1e-9)
    for _ in range(rounds):
        u = res(coef) / spread(coef)
        m = _moments(points, F.when(F.abs(u) < 1, F.pow(1 - u * u, 2)).otherwise(0.0))
        if m["w"] < 1e-12:
            break
        coef = _solved(m)
    limit = spread(coef)
    return tuple(float(v) for v in coef), points.withColumn("res", res(coef)).withColumn("inlier", F.abs("res") < limit)  # type: ignore[return-value]


def plane_measures(coef: tuple[float, float, float]) -> dict[str, float]:
    """The plane's unit normal (y positive) and offset ``d``, the origin's height over it, its tilt in degrees."""
    a, b, c = coef
    n = math.sqrt(a * a + 1 + b * b)
    return {"nx": -a / n, "ny": 1 / n, "nz": -b / n, "d": -c / n, "h_rel": abs(c) / n, "tilt_deg": math.degrees(math.acos(min(1.0, 1.0 / n)))}


def pair_moments(overlap: DataFrame) -> DataFrame:
    """For pairs of faces, the six weighted sums of the normal equations of a_i x_i + b_i = a_j x_j + b_j."""
    w, i, j = F.col("wt"), F.col("xi"), F.col("xj")
    return overlap.groupBy("face_i", "face_j").agg(
        F.sum(w).alias("s1"), F.sum(w * i).alias("si"), F.sum(w * j).alias("sj"), F.sum(w * i * i).alias("sii"), F.sum(w * j * j).alias("sjj"), F.sum(w * i * j).alias("sij")
    )


def align_faces(overlap: DataFrame, faces: int, delta: float = 0.15, rounds: int = 8, reg: float = 1e-3, anchor: float = 1e6) -> tuple[np.ndarray, float]:
    """Scale and offset of each face (rows a, b) by Huber-weighted least squares, and the overlaps' RMS.

    ``overlap`` has (face_i, face_j, xi, xj, base): the same pixel on two
    faces.  Each round is one grouped sum; the system of twice as many
    unknowns as faces is solved on the driver.
    """
    overlap = overlap.persist()
    theta = np.tile([1.0, 0.0], faces)

    def values(at: str, col: str) -> Column:
        pick = F.create_map(*[F.lit(v) for f in range(faces) for v in (f, F.struct(F.lit(float(theta[2 * f])).alias("a"), F.lit(float(theta[2 * f + 1])).alias("b")))])
        return pick[F.col(at)]["a"] * F.col(col) + pick[F.col(at)]["b"]

    for _ in range(rounds):
        res = F.abs(values("face_i", "xi") - values("face_j", "xj"))
        wt = F.col("base") * F.when(res <= delta, 1.0).otherwise(F.lit(delta) / res)
        m, rhs = np.zeros((2 * faces, 2 * faces)), np.zeros(2 * faces)
        for r in pair_moments(overlap.withColumn("wt", wt)).collect():
            k = [2 * r["face_i"], 2 * r["face_i"] + 1, 2 * r["face_j"], 2 * r["face_j"] + 1]
            m[np.ix_(k, k)] += np.array(
                [[r["sii"], r["si"], -r["sij"], -r["si"]], [r["si"], r["s1"], -r["sj"], -r["s1"]], [-r["sij"], -r["sj"], r["sjj"], r["sj"]], [-r["si"], -r["s1"], r["sj"], r["s1"]]]
            )
        m[np.diag_indices(2 * faces)] += reg
        rhs[::2] += reg
        m[0, 0] += anchor
        m[1, 1] += anchor
        rhs[0] += anchor
        try:
            theta = np.linalg.solve(m, rhs)
        except np.linalg.LinAlgError:
            theta = np.linalg.lstsq(m, rhs, rcond=None)[0]
    res = values("face_i", "xi") - values("face_j", "xj")
    row = overlap.agg(F.sum(F.col("base") * res * res), F.sum("base")).first()
    rms = math.sqrt(row[0] / row[1]) if row[1] else 0.0
    return theta.reshape(faces, 2), rms
