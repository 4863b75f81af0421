"""Gate verdicts: each a projection over aggregates, with its measures and thresholds. None aborts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.params import DEFAULTS as P

S0, S2, S2B, S3, S6, S7 = (P[k] for k in ("s0", "s2", "s2b", "s3", "s6", "s7"))

#: Every gate: its measures, and when it passes.
GATES: dict[str, tuple[list[str], str]] = {
    "watermark": (["edge_density"], f"edge_density <= {S0['edge_density_max']}e0"),
    "cleanplate_detector": (["hits"], "hits = 0"),
    "cleanplate_containment": (["outside_px"], "outside_px = 0"),
    "interface_step": (["step_log", "dynamic_range"], f"step_log <= {S2['step_max_log']}e0 and dynamic_range >= {S2['range_min']}e0"),
    "ground_plane": (["residual_rel", "tilt_deg", "explicit_scale"], f"explicit_scale or (residual_rel <= {S2B['residual_max']}e0 and tilt_deg <= {S2B['tilt_max_deg']}e0)"),
    "min_content_distance": (["near_m"], f"near_m is not null and near_m >= {P['min_content_m']}e0"),
    "bg_solid_angle": (["fraction"], f"fraction <= {S3['bg_max_frac']}e0"),
    "hole": (["worst_magenta", "worst_alpha", "worst_blob_px"], f"worst_magenta <= {S7['hole_max_frac']}e0 and worst_alpha <= {S7['hole_max_frac']}e0 and worst_blob_px <= {S7['blob_max_px']}"),
    "jitter": (["worst_energy"], f"worst_energy <= {S7['jitter_max']}e0"),
    "stereo": (["vdisp_px", "min_depth_m", "order"], f"abs(vdisp_px) <= {S7['vdisp_max_px']}e0 and min_depth_m >= {S7['near_min_m']}e0 and order >= {S7['order_min']}e0".replace("order >=", "`order` >=")),
    "people": (["worst_score"], f"worst_score < {S7['people_score_min']}e0"),
    "budgets": (["final_count", "sog_bytes"], f"final_count <= {S6['cap']} and sog_bytes <= {S6['sog_max_mb']} * 1048576"),
    "fidelity_at_origin": (["ssim_worst", "ssim_mean"], f"ssim_worst >= {S7['ssim_worst_min']}e0 and ssim_mean >= {S7['ssim_mean_min']}e0"),
}


def verdict(measures: DataFrame, gate: str) -> DataFrame:
    """(gate, pass, metrics, thresholds): a row for each row of measures; a null comparison fails."""
    names, passes = GATES[gate]
    metrics = F.create_map(*[x for n in names for x in (F.lit(n), F.col(f"`{n}`").cast("double"))])
    return measures.select(F.lit(gate).alias("gate"), F.coalesce(F.expr(passes), F.lit(False)).alias("pass"), metrics.alias("metrics"), F.lit(passes).alias("thresholds"))


def worst(score: Column, key: Column, place: Column, largest: bool = True) -> list[Column]:
    """The worst score and whose it is; of equals the first in place."""
    order = F.struct(score, -place) if largest else F.struct(score, place)
    return [(F.max if largest else F.min)(score).alias("worst"), (F.max_by if largest else F.min_by)(key, order).alias("worst_key")]


def summary(verdicts: DataFrame) -> DataFrame:
    """(total, passed, all_pass, shippable): nothing ships without gates."""
    passed = F.count_if(F.col("pass"))
    return verdicts.agg(F.count("*").alias("total"), passed.alias("passed"), F.coalesce(F.bool_and("pass"), F.lit(True)).alias("all_pass"), ((F.count("*") > 0) & (passed == F.count("*"))).alias("shippable"))


def hole_pixels(px: DataFrame, pitch_deg: str) -> DataFrame:
    """``below`` (the pixel's ray lies under the skyline), ``magenta`` and ``hole`` of a view's pixels (colours 0..1, alpha)."""
    return px.withColumns(
        {"below": F.expr(f"{pitch_deg} < -2e0"), "magenta": F.expr("red > 0.6e0 and blu > 0.6e0 and grn < 0.35e0"), "hole": F.expr("alpha < 0.05e0")}
    )


def central_window(size: int, share: float = S7["center_frac"]) -> tuple[int, int]:
    """First and end of the middle part of a side."""
    return round(size * (1 - share) / 2), round(size * (1 + share) / 2)
