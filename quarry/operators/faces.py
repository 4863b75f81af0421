"""Square faces over a panorama, pixel by pixel: weights, fused values and overlaps without a shuffle.

All faces of a pixel are columns of its row, so fusing them or pairing adjacent
ones is a projection.  ``faces`` is a short list of constants (face, yaw, pitch,
fov), whose trigonometry Catalyst folds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import geometry as g

Face = tuple[int, float, float, float]


def weighted(px: DataFrame, faces: Sequence[Face], least: float) -> DataFrame:
    """The raster with ``wt_<face>`` (the feathered weight, 0 below ``least`` or outside) and ``fb_<face>`` (the fallback: the squared cosine to the centre, inside)."""
    at = g.with_directions(px)
    for axis, place in (("cx", 0), ("cy", 1), ("cz", 2)):
        at = at.withColumns({f"{axis}_{i}": F.expr(g.into_camera("dx", "dy", "dz", f"{yaw}e0", f"{pitch}e0")[place]) for i, yaw, pitch, _ in faces})
    weights = {}
    for i, _, _, fov in faces:
        half, edge = f"tan(radians({fov}e0) / 2e0)", f"cos(radians({fov}e0) / 2e0)"
        u, v = f"((cx_{i} / cz_{i} / {half} + 1e0) / 2e0)", f"((1e0 - cy_{i} / cz_{i} / {half}) / 2e0)"
        inside = f"{u} between 0e0 and 1e0 and {v} between 0e0 and 1e0"
        w = f"power(greatest(0e0, least(1e0, (cz_{i} - {edge}) / (1e0 - {edge}))), 2)"
        weights[f"wt_{i}"] = F.expr(f"case when cz_{i} > 1e-9 then case when {inside} and {w} >= {least}e0 then {w} else 0e0 end else 0e0 end")
        weights[f"fb_{i}"] = F.expr(f"case when cz_{i} > 1e-9 then case when {inside} then cz_{i} * cz_{i} else 0e0 end else 0e0 end")
    return at.withColumns(weights).drop(*[f"{a}_{i}" for a in ("cx", "cy", "cz") for i, *_ in faces])


def fused(px: DataFrame, faces: Sequence[Face], value: Callable[[int], Column], name: str = "fused") -> DataFrame:
    """Rows of ``weighted`` with the weighted mean of the faces' values, and ``n``, how many have a weight.

    Where no face has one, the fallback weights decide; where none is inside, the mean is null.
    """
    total = lambda kind, of: sum((F.col(f"{kind}_{i}") * of(i) for i, *_ in faces), F.lit(0.0))
    one = lambda i: F.lit(1.0)
    n = sum(((F.col(f"wt_{i}") > 0).cast("long") for i, *_ in faces), F.lit(0).cast("long"))
    mean = lambda kind: F.try_divide(total(kind, value), F.nullif(total(kind, one), F.lit(0.0)))
    return px.withColumns({name: F.coalesce(mean("wt"), mean("fb")), "n": n})


def overlaps(px: DataFrame, pairs: Sequence[tuple[int, int]], value: Callable[[int], Column]) -> DataFrame:
    """(face_i, face_j, xi, xj, base): rows of ``weighted`` that both faces of a pair weigh."""
    each = [F.struct(F.lit(i).cast("long").alias("face_i"), F.lit(j).cast("long").alias("face_j"), value(i).alias("xi"), value(j).alias("xj"), (F.col(f"wt_{i}") * F.col(f"wt_{j}")).alias("base")) for i, j in pairs]
    return px.select(F.inline(F.array(*each))).where("base > 0")


def fused_rows(depth: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, r, c, ``ld``) of rows (r, c, face, value, wt[, fallback]): weighted means, by the fallback weights where the others are all 0."""
    fallback = F.col("fallback") if "fallback" in depth.columns else F.lit(0.0)
    rows = depth.select(*by, "r", "c", "value", "wt", fallback.alias("fb"))
    mean = lambda w: F.try_divide(F.sum(F.col(w) * F.col("value")), F.nullif(F.sum(w), F.lit(0.0)))
    return rows.groupBy(*by, "r", "c").agg(F.coalesce(mean("wt"), mean("fb")).alias("ld"))


#: Cells along a face's side, in which boxes and pixels meet.
CELLS = 16


def in_boxes(px: DataFrame, views: DataFrame, boxes: DataFrame) -> DataFrame:
    """Distinct (r, c) of pixels inside some box of a view.

    ``views`` (face, yaw, pitch, fov) are a few dozen and broadcast; ``boxes``
    (face, u0, u1, v0, v1, in parts of a side) may be many: the range join is an
    equi-join on cells of a face.
    """
    of = g.face("dx", "dy", "dz", "yaw", "pitch", "fov")
    seen = g.with_directions(px.select("r", "c", "h", "w")).crossJoin(F.broadcast(views)).select("face", "r", "c", *[F.expr(of[k]).alias(k) for k in ("u01", "v01", "inside")]).where("inside")
    cell = lambda x: F.floor(F.greatest(F.lit(0.0), F.least(F.lit(0.999), x)) * CELLS).cast("int")
    edges = {"u0": F.greatest("u0", F.lit(0.0)), "u1": F.least("u1", F.lit(1.0)), "v0": F.greatest("v0", F.lit(0.0)), "v1": F.least("v1", F.lit(1.0))}
    spread = boxes.select(F.col("face").alias("of"), *[v.alias(k) for k, v in edges.items()]).where("u0 <= u1 and v0 <= v1")
    for axis in "uv":
        spread = spread.withColumn(f"c{axis}", F.explode(F.sequence(cell(F.col(f"{axis}0")), cell(F.col(f"{axis}1")))))
    seen = seen.withColumns({"pu": cell(F.col("u01")), "pv": cell(F.col("v01"))})
    hit = (F.col("face") == F.col("of")) & (F.col("pu") == F.col("cu")) & (F.col("pv") == F.col("cv")) & F.col("u01").between(F.col("u0"), F.col("u1")) & F.col("v01").between(F.col("v0"), F.col("v1"))
    return seen.join(spread, hit, "left_semi").select("r", "c").distinct()
