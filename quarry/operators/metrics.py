"""Image measures: gradients, SSIM, stereo consistency, differences, connected blobs."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.raster import central_difference, padded, shifted, weighted_line

#: SSIM's constants, its Gaussian's width and reach.
C1, C2, SIGMA, REACH = 1e-4, 9e-4, 1.5, 5


def gaussian(sigma: float = SIGMA, reach: int = REACH) -> list[float]:
    raw = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(-reach, reach + 1)]
    return [v / sum(raw) for v in raw]


def sobel(px: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """``magnitude`` of the Sobel gradient over 4; borders mirror."""
    out = px
    for axis in ("x", "y"):
        out = padded(out, 1, axis, "reflect")
    out = out.withColumns({"dx": shifted(value, "x", 1, by=by) - shifted(value, "x", -1, by=by), "sx": shifted(value, "x", 1, by=by) + 2 * F.col(value) + shifted(value, "x", -1, by=by)})
    gx = shifted("dx", "y", 1, by=by) + 2 * F.col("dx") + shifted("dx", "y", -1, by=by)
    gy = shifted("sx", "y", 1, by=by) - shifted("sx", "y", -1, by=by)
    out = out.withColumns({"gx": gx / 4, "gy": gy / 4}).where("r >= 0 and r < h and c >= 0 and c < w")
    return out.withColumn("magnitude", F.expr("sqrt(gx * gx + gy * gy)")).drop("dx", "sx", "gx", "gy")


def gradient(px: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """``gradient``: length of the central differences, one-sided at borders."""
    return px.withColumns({"gx": central_difference(value, "x", by), "gy": central_difference(value, "y", by)}).withColumn("gradient", F.expr("sqrt(gx * gx + gy * gy)")).drop("gx", "gy")


def ssim(px: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """``ssim`` of two images of 0..1 by pixel; Gaussian windows, borders mirror. Two one-dimensional passes of all five means."""
    keys = [*by, "r", "c"]
    parts = {"ma": F.col(a), "mb": F.col(b), "aa": F.col(a) * F.col(a), "bb": F.col(b) * F.col(b), "ab": F.col(a) * F.col(b)}
    out = px.select(*keys, "h", "w", *[v.cast("double").alias(k) for k, v in parts.items()])
    for axis in ("x", "y"):
        out = weighted_line(out, list(parts), gaussian(), axis, "reflect", by)
    top = "((2e0 * ma * mb + 1e-4) * (2e0 * (ab - ma * mb) + 9e-4))"
    return out.withColumn("ssim", F.expr(f"{top} / ((ma * ma + mb * mb + 1e-4) * ((aa - ma * ma) + (bb - mb * mb) + 9e-4))")).select(*keys, "ssim")


def mean_difference(a: DataFrame, b: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, ``energy``): mean absolute difference of two images' channels, in parts of full scale."""
    both = a.select(*by, "r", "c", *[F.col(v).alias(f"a_{v}") for v in ("red", "grn", "blu")]).join(b.select(*by, "r", "c", *[F.col(v).alias(f"b_{v}") for v in ("red", "grn", "blu")]), [*by, "r", "c"])
    total = sum((F.abs(F.col(f"a_{v}") - F.col(f"b_{v}")) for v in ("red", "grn", "blu")), F.lit(0))
    return both.groupBy(*by).agg((F.avg(total) / (3 * 255.0)).alias("energy"))


def vertical_costs(left: DataFrame, right: DataFrame, value: str, reach: int = 2, by: Sequence[str] = ()) -> DataFrame:
    """(by, dy, ``cost``): mean absolute difference of gradients when the right image is moved by dy rows, ``reach`` rows off the edges."""
    a = gradient(left, value, by).where(f"r >= {reach} and r < h - {reach}").select(*by, "r", "c", F.col("gradient").alias("ga"))
    moved = gradient(right, value, by).select(*by, "r", "c", F.col("gradient").alias("gb")).withColumn("dy", F.explode(F.sequence(F.lit(-reach), F.lit(reach)))).withColumn("r", F.col("r") - F.col("dy"))
    return a.join(moved, [*by, "r", "c"]).groupBy(*by, "dy").agg(F.avg(F.abs(F.col("ga") - F.col("gb"))).alias("cost"))


def disparity(costs: dict[int, float]) -> float:
    """The shift of least cost, refined by a parabola through its neighbours; 0 where costs hardly differ."""
    if max(costs.values()) - min(costs.values()) < 1e-12:
        return 0.0
    best = min(costs, key=lambda k: (costs[k], k))
    if best - 1 in costs and best + 1 in costs:
        a, b, c = costs[best - 1], costs[best], costs[best + 1]
        bend = a - 2 * b + c
        return best + (0.5 * (a - c) / bend if abs(bend) > 1e-12 else 0.0)
    return float(best)


def order_consistency(left: DataFrame, right: DataFrame, focal: float, ipd: float, tolerance: float = 0.2, by: Sequence[str] = ()) -> DataFrame:
    """(by, ``consistent``, ``n``): share of the left image's pixels whose depth the right image has, within the tolerance, where they should appear; 1 if none do."""
    seen = left.where("d is not null and abs(d) < 1e300 and d > 0").select(*by, "r", F.expr(f"cast(c - rint({focal}e0 * {ipd}e0 / d) as bigint)").alias("c"), "d")
    both = seen.join(right.where("d is not null and abs(d) < 1e300").select(*by, "r", "c", F.col("d").alias("d2")), [*by, "r", "c"])
    return both.groupBy(*by).agg(F.coalesce(F.avg((F.abs(F.col("d") - F.col("d2")) <= tolerance * F.col("d")).cast("double")), F.lit(1.0)).alias("consistent"), F.count("*").alias("n"))


def largest_blob(px: DataFrame, mask: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, ``blob``): pixels of the largest 4-connected part of a mask, image by image; masks have at most an image's pixels."""

    def widest(one: pd.DataFrame) -> pd.DataFrame:
        left, most = set(zip(one["r"].tolist(), one["c"].tolist(), strict=True)), 0
        while left:
            stack, n = [left.pop()], 0
            while stack:
                r, c = stack.pop()
                n += 1
                for q in ((r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1)):
                    if q in left:
                        left.remove(q)
                        stack.append(q)
            most = max(most, n)
        return pd.DataFrame({**{k: [one[k].iloc[0]] for k in keys}, "blob": [most]})

    keys = list(by) or ["_all"]
    rows = px.where(mask).select(*by, *([] if by else [F.lit(0).alias("_all")]), "r", "c")
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    out = rows.groupBy(*keys).applyInPandas(widest, ", ".join(f"{k} {types[k]}" for k in keys) + ", blob long")
    return out if by else out.select("blob")
