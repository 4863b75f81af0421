"""Pruning of splat clouds: opacity floor, isolated splats, duplicates of the foreground."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import splats as sp
from quarry.params import DEFAULTS

RADIUS = "exp(greatest(scale_0, scale_1, scale_2))"


def opacity_floor(splats: DataFrame, floor: float = DEFAULTS["s6"]["opacity_floor"]) -> DataFrame:
    return splats.where(F.expr(f"{sp.from_logit('opacity')} >= {floor}e0"))


def isolation_prune(splats: DataFrame, k: int = DEFAULTS["s6"]["knn_k"], factor: float = DEFAULTS["s6"]["isolation_factor"]) -> DataFrame:
    """Without splats whose k-th nearest neighbour (shell aside) is farther than ``factor`` radii.

    Said as a count: a splat stays if at least k others lie within its reach,
    so no neighbour list is sorted.  Space is cut in cells; as reach varies by
    orders of magnitude, each power of two of it has cells of its own size,
    and a splat looks at the 27 cells around it in a join on the cell.  With
    fewer than k others, k is what there is; a lone splat stays.
    """
    inner = splats.where("layer <> 2").withColumn("reach", F.expr(f"{factor}e0 * {RADIUS}"))
    n = inner.count()
    kk = min(k, n - 1)
    if kk < 1:
        return splats
    sized = inner.withColumn("level", F.ceil(F.log2(F.greatest("reach", F.lit(1e-300)))).cast("int"))
    levels = F.broadcast(sized.select("level").distinct())  # one row per power of two of a double: at most 2,100
    cell = lambda v, lv: F.floor(F.col(v) / F.pow(F.lit(2.0), F.col(lv)))
    near = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    seek = sized.select("ord", *"xyz", "reach", "level", *[cell(v, "level").alias(f"c{v}") for v in "xyz"])
    for v in "xyz":
        seek = seek.withColumn("step", F.explode(near)).withColumn(f"c{v}", F.col(f"c{v}") + F.col("step")).drop("step")
    there = sized.select(F.col("ord").alias("o"), *[F.col(v).alias(f"o{v}") for v in "xyz"]).crossJoin(levels)
    there = there.select("o", "ox", "oy", "oz", "level", *[cell(f"o{v}", "level").alias(f"c{v}") for v in "xyz"])
    pairs = seek.join(there, ["level", "cx", "cy", "cz"]).where("o <> ord and sqrt((x - ox) * (x - ox) + (y - oy) * (y - oy) + (z - oz) * (z - oz)) <= reach")
    held = pairs.groupBy("ord").agg(F.count("*").alias("near")).where(F.col("near") >= kk).select("ord")
    return splats.where("layer = 2").unionByName(splats.where("layer <> 2").join(held, "ord", "left_semi"))


def _settled(df: DataFrame) -> DataFrame:
    """The rows without their lineage, in ``spark.checkpoint.dir`` if it is set."""
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df.localCheckpoint()


def _cells(width: float, names: tuple[str, ...] = ("x", "y", "z")) -> list[Column]:
    return [F.floor(F.col(v) / width).alias(f"c{a}") for a, v in zip("xyz", names, strict=True)]


def _nearest(places: DataFrame, front: DataFrame, limit: float) -> DataFrame:
    """(x, y, z, dist, o, radius): the nearest of ``front`` to each place, smaller ``o`` first, if it is not beyond ``limit``.

    The first cells are so narrow that a splat shares its own with few others;
    a place looks at the eight cells around its nearest corner, which hold all
    within half a width.  Places that find nothing so near go on to cells of
    twice the width, until half a width is the limit.
    """
    few, top, found = 8.0, 2.000001 * limit, []
    width, n, far = top, *front.agg(F.count("*"), F.max(F.greatest(*[F.abs(v) for v in "xyz"]))).first()
    while far < width * 2.0**26 and front.groupBy(*_cells(width)).count().agg(F.sum(F.col("count") * F.col("count"))).first()[0] > few * n:
        width /= 2
    there = front.select("o", "radius", *[F.col(v).alias(f"o{v}") for v in "xyz"])
    while True:
        seek = places
        for v in "xyz":
            seek = seek.withColumn(f"c{v}", F.explode(F.array(*[F.floor(F.col(v) / width + half) for half in (-0.5, 0.5)])))
        pairs = seek.join(there.select("*", *_cells(width, ("ox", "oy", "oz"))), ["cx", "cy", "cz"], "left")
        pairs = pairs.withColumn("dist", F.expr("sqrt((x - ox) * (x - ox) + (y - oy) * (y - oy) + (z - oz) * (z - oz))"))
        # a little less than half a width, so that no rounding hides one that lies as near
        near = F.min(F.when(F.col("dist") <= width * 0.4999999, F.struct("dist", "o", "radius"))).alias("n")
        sought = _settled(pairs.groupBy(*"xyz").agg(near))  # no level carries the plans of those before
        found.append(sought.where("n is not null").select(*"xyz", "n.*"))
        places = sought.where("n is null").select(*"xyz")
        if width >= top or not places.count():
            return reduce(DataFrame.unionByName, found)
        width *= 2


def merge_duplicates(splats: DataFrame, factor: float = DEFAULTS["s6"]["merge_factor"]) -> DataFrame:
    """Without background splats nearer to the nearest foreground splat than ``factor`` of *its* radius.

    Only the nearest decides.  Any foreground splat within ``factor`` of the
    smallest radius settles it, whichever is nearest: sharing a cell of that
    diagonal is enough.  For the others the nearest itself is sought.
    """
    finite = " and ".join(f"{v} is not null and not isnan({v}) and abs({v}) < 1e300" for v in "xyz")
    slim = splats.where(f"layer in (0, 1) and {finite}").select("ord", "layer", *"xyz", F.expr(RADIUS).alias("radius")).persist()
    front, back = slim.where("layer = 0").drop("layer"), slim.where("layer = 1").select("ord", *"xyz")
    size = slim.agg(
        F.max(F.greatest(*[F.abs(v) for v in "xyz"])).alias("far"), F.max(F.expr("if(layer = 0, radius, null)")).alias("most"), F.min(F.expr("if(layer = 0, coalesce(radius, 0e0), null)")).alias("least")
    ).first()
    if size["most"] is None or not factor * size["most"] > 0:
        return splats
    # no two are farther apart than four times the largest coordinate, whatever the radii
    limit = max(4.0 * size["far"], 1e-9)
    limit = min(factor * size["most"], limit) if math.isfinite(size["most"]) else limit
    gone, width = None, 0.577 * min(factor * size["least"], limit)
    if size["far"] < width * 2.0**30:
        taken = front.select(*_cells(width)).distinct()
        cell = back.select("*", *_cells(width))
        gone, back = cell.join(taken, ["cx", "cy", "cz"], "left_semi").select("ord"), _settled(cell.join(taken, ["cx", "cy", "cz"], "left_anti").drop("cx", "cy", "cz"))
    if back.count():
        places = back.select(*"xyz").distinct()
        once = _settled(front.groupBy(*"xyz").agg(F.min(F.struct(F.col("ord").alias("o"), "radius")).alias("s")).select(*"xyz", "s.*"))
        near = back.join(_nearest(places, once, limit), [*"xyz"]).groupBy("ord").agg(F.min(F.struct("dist", "o", "radius")).alias("n"))
        near = near.where(F.col("n.dist") < factor * F.col("n.radius")).select("ord")
        gone = near if gone is None else gone.unionByName(near)
    return splats if gone is None else splats.join(gone, "ord", "left_anti")


def prune_chain(splats: DataFrame, p: dict = DEFAULTS["s6"]) -> DataFrame:
    """Floor, isolation, duplicates: each on what the one before left."""
    return merge_duplicates(isolation_prune(opacity_floor(splats, p["opacity_floor"]), p["knn_k"], p["isolation_factor"]), p["merge_factor"])


def fit_cap(placed: Callable[[float], DataFrame], cap: int, p: dict = DEFAULTS["s6"]) -> tuple[DataFrame, list[dict]]:
    """Prunes what ``placed`` gives for a stride multiplier, enlarging it until the count fits or the tries are used up."""
    multiplier, tries = 1.0, []
    while True:
        out = prune_chain(placed(multiplier), p).persist()
        n = out.count()
        tries.append({"multiplier": multiplier, "count": n})
        if n <= cap or len(tries) > p["retries"]:
            return out, tries
        out.unpersist()
        multiplier *= p["retry_factor"]


def layer_counts(splats: DataFrame) -> DataFrame:
    return splats.groupBy("layer").agg(F.count("*").alias("n"))


def reach_bits(x: float) -> int:
    """The power of two that isolation files a reach under."""
    return math.ceil(math.log2(max(x, 1e-300)))
