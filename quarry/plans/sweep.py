"""Parameter sweeps: the grid, its scores, the ranking."""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.params import with_overrides

#: The default axes, 36 cells.
AXES: dict[str, list[float]] = {"s4.scale_multiplier": [0.85, 1.15, 1.35], "s4.flatten": [0.1, 0.15], "s4.base_stride": [1, 2, 3], "s6.opacity_floor": [0.02, 0.05]}


def grid(spark: SparkSession, axes: dict[str, list[float]] = AXES) -> DataFrame:
    """(idx, overrides): the cross product of the axes, the last one fastest."""
    out = spark.range(1).select(F.lit(0).cast("long").alias("idx"), F.create_map().cast("map<string,double>").alias("overrides"))
    for name, values in axes.items():
        axis = F.posexplode(F.array(*[F.lit(float(v)) for v in values])).alias("at", "value")
        out = out.select("idx", "overrides", axis)
        out = out.select((F.col("idx") * len(values) + F.col("at")).alias("idx"), F.map_concat("overrides", F.create_map(F.lit(name), F.col("value"))).alias("overrides"))
    return out


def score(metrics: str, *names: str) -> Column:
    """The first of some metric names that a map has."""
    return F.coalesce(*[F.element_at(F.col(metrics), n) for n in names])


def ranked(cells: DataFrame) -> DataFrame:
    """``rank`` from 1: by mean, then worst tile, both highest first, then index; cells without scores last."""
    order = W.orderBy(F.col("ssim_mean").desc_nulls_last(), F.col("ssim_worst").desc_nulls_last(), "idx")
    return cells.withColumn("rank", F.row_number().over(order))


def best(cells: DataFrame) -> DataFrame:
    return cells.orderBy(F.col("ssim_mean").desc_nulls_last(), F.col("ssim_worst").desc_nulls_last(), "idx").limit(1)


def run_sweep(spark: SparkSession, params: dict, scorer: Callable[[dict], dict[str, float]], axes: dict[str, list[float]] = AXES, first: int | None = None) -> DataFrame:
    """Scores each cell (the first few, if asked) and ranks them; a cell is a whole run, so the loop is the driver's."""
    cells = []
    for idx, values in enumerate(product(*axes.values())):
        if first is not None and idx >= first:
            break
        found = scorer(with_overrides(params, dict(zip(axes, values, strict=True))))
        cells.append((idx, {k: float(v) for k, v in zip(axes, values, strict=True)}, found.get("ssim_mean", found.get("mean_ssim", found.get("ssim"))), found.get("ssim_worst_tile", found.get("worst_tile_ssim")), found.get("final_count")))
    return ranked(spark.createDataFrame(cells, "idx long, overrides map<string,double>, ssim_mean double, ssim_worst double, final_count long"))
