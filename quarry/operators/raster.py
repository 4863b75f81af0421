"""Neighbour operators on dense rasters: shifts, differences, boxes, dilations, samples.

A raster is a DataFrame with one row for each ``(r, c)`` of every combination of
``by`` columns (for example a panorama's id), and its size in ``h`` and ``w``.
One-dimensional passes are windows over a row or a column, so they need one
shuffle each and no join; ``by`` and the row or column number spread them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _line(axis: str, by: Sequence[str]):
    along, across = ("c", "r") if axis == "x" else ("r", "c")
    return W.partitionBy(*by, across).orderBy(along)


def shifted(value: Column | str, axis: str, step: int, border: str = "none", by: Sequence[str] = ()) -> Column:
    """The value ``step`` places to the right (x) or down (y), left or up if negative.

    ``border``: ``none`` gives null beyond the edge, ``wrap`` goes round, ``edge`` repeats the edge.
    """
    v = F.col(value) if isinstance(value, str) else value
    w = _line(axis, by)
    inside = F.lead(v, step).over(w) if step >= 0 else F.lag(v, -step).over(w)
    if border == "none" or step == 0:
        return inside
    at, size = (F.col("c"), F.col("w")) if axis == "x" else (F.col("r"), F.col("h"))
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    beyond = (at + step >= size) | (at + step < 0)
    if border == "edge":
        return F.when(beyond, F.last(v).over(whole) if step > 0 else F.first(v).over(whole)).otherwise(inside)
    n = abs(step)
    far = F.nth_value(v, n).over(whole) if n == 1 else F.element_at(F.collect_list(v).over(whole), F.pmod(at + step, size).cast("int") + 1)
    return F.when(beyond, (F.first(v).over(whole) if step > 0 else F.last(v).over(whole)) if n == 1 else far).otherwise(inside)


def padded(px: DataFrame, radius: int, axis: str, border: str) -> DataFrame:
    """The raster with ``radius`` more places at both ends of an axis: of the other end (wrap), of the edge (edge), or mirrored (reflect)."""
    at, size = ("c", "w") if axis == "x" else ("r", "h")
    places = {
        "wrap": F.array(F.col(at), F.when(F.col(at) < radius, F.col(at) + F.col(size)), F.when(F.col(at) >= F.col(size) - radius, F.col(at) - F.col(size))),
        "reflect": F.array(F.col(at), F.when(F.col(at) < radius, -F.col(at) - 1), F.when(F.col(at) >= F.col(size) - radius, 2 * F.col(size) - 1 - F.col(at))),
    }
    if border == "edge":
        low = F.when(F.col(at) == 0, F.transform(F.sequence(F.lit(1), F.lit(radius)), lambda i: -i.cast("long"))).otherwise(F.array().cast("array<bigint>"))
        high = F.when(F.col(at) == F.col(size) - 1, F.transform(F.sequence(F.lit(0), F.lit(radius - 1)), lambda i: F.col(size) + i)).otherwise(F.array().cast("array<bigint>"))
        every = F.concat(F.array(F.col(at)), low, high)
    else:
        every = F.filter(places[border], lambda x: x.isNotNull())
    return px.withColumn(at, F.explode(every))


def box_sum(px: DataFrame, values: Sequence[str], radius: int, x_border: str = "wrap", y_border: str = "clip", by: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """``sum_<v>`` over the square of side 2 * radius + 1 and ``sum_n``, its number of pixels; borders ``clip``, ``wrap``, ``edge`` or ``reflect``.

    Two passes of running frames, along rows and then along columns.  Columns to
    ``carry`` come along, so that sums need no join with their pixels.
    """
    keep = [*by, "r", "c", "h", "w", *carry]
    out = px.select(*keep, *[F.col(v).alias(f"sum_{v}") for v in values], F.lit(1).cast("long").alias("sum_n"))
    values = [f"sum_{v}" for v in [*values, "n"]]
    for axis, border in (("x", x_border), ("y", y_border)):
        at, size = ("c", "w") if axis == "x" else ("r", "h")
        wide = out if border == "clip" else padded(out, radius, axis, border)
        frame = _line(axis, by).rowsBetween(-radius, radius)
        out = wide.select(*keep, *[F.sum(v).over(frame).alias(v) for v in values]).where((F.col(at) >= 0) & (F.col(at) < F.col(size)))
    return out


def weighted_line(px: DataFrame, values: Sequence[str], weights: Sequence[float], axis: str, border: str = "reflect", by: Sequence[str] = ()) -> DataFrame:
    """The values convolved along an axis with symmetric weights of odd number, all in one pass."""
    radius = len(weights) // 2
    at, size = ("c", "w") if axis == "x" else ("r", "h")
    w = _line(axis, by)
    total = lambda v: sum((F.lit(k) * (F.lag(v, radius - i).over(w) if i < radius else F.lead(v, i - radius).over(w)) for i, k in enumerate(weights)), F.lit(0.0))
    wide = padded(px, radius, axis, border)
    return wide.withColumns({v: total(v) for v in values}).where((F.col(at) >= 0) & (F.col(at) < F.col(size)))


def central_difference(value: str, axis: str, by: Sequence[str] = ()) -> Column:
    """Half the difference of both neighbours, one-sided at the ends, no wrap."""
    after, before = shifted(value, axis, 1, by=by), shifted(value, axis, -1, by=by)
    return F.when(before.isNull(), after - F.col(value)).when(after.isNull(), F.col(value) - before).otherwise((after - before) / 2)


def dilated(px: DataFrame, mask: str, radius: int, metric: str = "l1", wrap: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """The raster with ``<mask>_dilated``: within ``radius`` of a pixel of the mask.

    ``metric`` is ``l1`` (as many steps to a side neighbour) or ``linf`` (a
    square); ``wrap`` goes round in x.  Only the mask's pixels are spread.
    """
    keys = [*by, "r", "c"]
    r = F.explode(F.sequence(F.col("r") - radius, F.col("r") + radius))
    seeds = px.where(mask).select(*by, "c", "h", "w", F.col("r").alias("r0"), r.alias("r"))
    reach = F.lit(radius) - (F.abs(F.col("r") - F.col("r0")) if metric == "l1" else F.lit(0))
    spread = seeds.where("r >= 0 and r < h").select(*by, "r", "w", F.explode(F.sequence(F.col("c") - reach, F.col("c") + reach)).alias("c"))
    spread = spread.withColumn("c", F.pmod("c", "w")) if wrap else spread.where("c >= 0 and c < w")
    hit = spread.select(*keys).distinct().withColumn("hit", F.lit(True))
    return px.join(hit, keys, "left").withColumn(f"{mask}_dilated", F.coalesce("hit", F.lit(False))).drop("hit")


def opened_closed(px: DataFrame, mask: str, by: Sequence[str] = ()) -> DataFrame:
    """3 x 3 opening, then closing; beyond the edge nothing is set. Adds ``<mask>_clean``."""
    out = px.withColumn("m", F.col(mask).cast("int"))
    for lowest in (True, False, False, True):
        for axis in ("x", "y"):
            near = [F.coalesce(shifted("m", axis, s, by=by), F.lit(0)) for s in (-1, 0, 1)]
            out = out.withColumn("m", F.least(*near) if lowest else F.greatest(*near))
    return out.withColumn(f"{mask}_clean", F.col("m") == 1).drop("m")


def bilinear(points: DataFrame, raster: DataFrame, values: Sequence[str], wrap_x: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Values of a raster at ``u``, ``v`` of each point (``pid``), from the four pixels around: one join on the pixel.

    x goes round or stops at the edge, y stops at the edge.  Points bring the raster's ``h`` and ``w``.
    """
    taps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
    p = points.withColumns({"u0": F.floor("u"), "v0": F.floor("v")}).withColumn("tap", taps)
    fu, fv = F.col("u") - F.col("u0"), F.col("v") - F.col("v0")
    weight = F.when(F.col("tap.i") == 1, fu).otherwise(1 - fu) * F.when(F.col("tap.j") == 1, fv).otherwise(1 - fv)
    x, y = F.col("u0") + F.col("tap.i"), F.col("v0") + F.col("tap.j")
    column = F.pmod(x, F.col("w")) if wrap_x else F.greatest(F.lit(0), F.least(F.col("w") - 1, x))
    p = p.select("pid", *by, weight.alias("weight"), column.alias("c"), F.greatest(F.lit(0), F.least(F.col("h") - 1, y)).alias("r"))
    return p.join(raster.select(*by, "r", "c", *values), [*by, "r", "c"]).groupBy("pid", *by).agg(*[F.sum(F.col("weight") * F.col(v)).alias(v) for v in values])


def box_filter_guided(px: DataFrame, guide: str, src: str, radius: int, eps: float, by: Sequence[str] = ()) -> DataFrame:
    """The guided filter: ``<src>_guided`` is locally linear in the guide. x goes round, y is clipped."""
    products = px.withColumns({"g": F.col(guide), "s": F.col(src), "gg": F.col(guide) * F.col(guide), "gs": F.col(guide) * F.col(src)})
    own = [c for c in px.columns if c not in (*by, "r", "c", "h", "w")]
    m = box_sum(products, ["g", "s", "gg", "gs"], radius, by=by, carry=own)
    mean = {v: F.col(f"sum_{v}") / F.col("sum_n") for v in ("g", "s", "gg", "gs")}
    a = (mean["gs"] - mean["g"] * mean["s"]) / (mean["gg"] - mean["g"] * mean["g"] + eps)
    lin = m.withColumn("a", a).withColumn("b", mean["s"] - F.col("a") * mean["g"])
    m2 = box_sum(lin, ["a", "b"], radius, by=by, carry=own)
    return m2.withColumn(f"{src}_guided", F.col("sum_a") / F.col("sum_n") * F.col(guide) + F.col("sum_b") / F.col("sum_n")).select(*px.columns, f"{src}_guided")
