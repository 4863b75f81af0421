"""Placement of splats: routing, strides, thinning, assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import geometry as g
from quarry.functions import splats as sp
from quarry.operators.raster import box_sum, dilated, shifted
from quarry.params import DEFAULTS

#: Bit-exact pseudo-random number of a pixel in [0, 1).
THIN = "((((cast(r as bigint) * 73856093) ^ (cast(c as bigint) * 19349663)) & 16777215) / 16777216e0)"


def stride(base: float, multiplier: float, boost: float = 1.0) -> int:
    """At least 1, halves to even."""
    return max(1, round(base * multiplier / boost**0.5))


def strides(p: dict, multiplier: float = 1.0) -> dict[str, int]:
    return {
        "edge": stride(p["base_stride"], multiplier, p["edge_boost"]),
        "ground": stride(p["base_stride"], multiplier, p["ground_boost"]),
        "base": stride(p["base_stride"], multiplier),
        "bg": stride(p["base_stride"], multiplier),
        "shell": stride(p["shell_stride"], multiplier),
    }


def routed(px: DataFrame, p: dict = DEFAULTS["s4"], min_content: float = DEFAULTS["min_content_m"]) -> DataFrame:
    """The raster with where each pixel goes: ``content``, ``near``, ``too_far``, ``backdrop``, ``shell``."""
    fin = g.finite("d")
    return px.withColumns(
        {
            "content": F.expr(f"({fin} and not sky and d <= {p['shell_m']}e0)"),
            "near": F.expr(f"({fin} and not sky and d < {min_content}e0)"),
            "too_far": F.expr(f"({fin} and not sky and d > {p['shell_m']}e0)"),
            "backdrop": F.expr(f"(sky or not {fin} or d > {p['shell_m'] - p['feather_m']}e0)"),
            "shell": F.expr(f"(sky or not {fin} or d > {p['shell_m']}e0)"),
        }
    )


def classed(px: DataFrame, edge: str, p: dict = DEFAULTS["s4"], multiplier: float = 1.0) -> DataFrame:
    """``class`` (edge, ground, base) and its ``stride``."""
    s = strides(p, multiplier)
    ground = f"({g.PITCH_DEG} < {p['ground_pitch_deg']}e0 and {g.finite('d')})"
    px = px.withColumn("class", F.expr(f"case when {edge} then 'edge' when {ground} then 'ground' else 'base' end"))
    return px.withColumn("stride", F.expr(f"case class when 'edge' then {s['edge']} when 'ground' then {s['ground']} else {s['base']} end"))


def on_grid(step: str) -> str:
    return f"(r % {step} = floor({step} / 2) and c % {step} = floor({step} / 2))"


def color_variance(px: DataFrame, half: int = DEFAULTS["s4"]["var_window_px"], by: tuple = ()) -> DataFrame:
    """The raster with ``variance``: the largest of the channels' variances of 0..1 values in the square around; x goes round, y repeats its edge."""
    names = ("red", "grn", "blu")
    wide = px.withColumns({f"v_{n}": F.col(n) / 255.0 for n in names}).withColumns({f"v_{n}2": F.col(f"v_{n}") * F.col(f"v_{n}") for n in names})
    own = [c for c in px.columns if c not in (*by, "r", "c", "h", "w")]
    sums = box_sum(wide, [f"v_{n}{k}" for n in names for k in ("", "2")], half, "wrap", "edge", by, own)
    mean = lambda v: F.col(f"sum_v_{v}") / F.col("sum_n")
    return sums.withColumn("variance", F.greatest(*[F.greatest(mean(f"{n}2") - mean(n) * mean(n), F.lit(0.0)) for n in names])).select(*px.columns, "variance")


def thinned(px: DataFrame, p: dict = DEFAULTS["s4"]) -> DataFrame:
    """``keep``: where the pixel's fixed number lies under its share; needs ``variance``."""
    boost = f"(1e0 + {p['var_boost'] - 1}e0 * greatest(0e0, least(1e0, variance / {p['var_ref']}e0)))"
    return px.withColumn("keep", F.expr(f"{THIN} < {boost} / {p['var_boost']}e0"))


def normals(px: DataFrame, by: tuple = ()) -> DataFrame:
    """``nx, ny, nz``: unit normals of the points dir * d that face the origin; the direction back where they can't be told."""
    px = g.with_directions(px).withColumn("ok", F.expr(g.finite("d")))
    pts = px.withColumns({f"p{a}": F.when(F.col("ok"), F.col(f"d{a}") * F.col("d")).otherwise(0.0) for a in "xyz"})
    edge_row = (F.col("r") == 0) | (F.col("r") == F.col("h") - 1)
    d = {}
    for a in "xyz":
        d[f"a{a}"] = shifted(f"p{a}", "x", 1, "wrap", by) - shifted(f"p{a}", "x", -1, "wrap", by)
        d[f"b{a}"] = F.when(edge_row, F.lit(0.0)).otherwise(shifted(f"p{a}", "y", 1, by=by) - shifted(f"p{a}", "y", -1, by=by))
    sides = shifted("ok", "x", 1, "wrap", by) & shifted("ok", "x", -1, "wrap", by)
    d["all_ok"] = F.col("ok") & sides & (edge_row | (shifted("ok", "y", 1, by=by) & shifted("ok", "y", -1, by=by)))
    n = pts.withColumns(d).withColumns({"cx": F.expr("ay * bz - az * by"), "cy": F.expr("az * bx - ax * bz"), "cz": F.expr("ax * by - ay * bx")})
    n = n.withColumn("norm", F.expr("sqrt(cx * cx + cy * cy + cz * cz)"))
    good = F.col("all_ok") & (F.col("norm") > 1e-12)
    n = n.withColumns({f"n{a}": F.when(good, F.col(f"c{a}") / F.greatest(F.col("norm"), F.lit(1e-12))).otherwise(-F.col(f"d{a}")) for a in "xyz"})
    flip = F.when(F.expr("nx * dx + ny * dy + nz * dz") > 0, -1.0).otherwise(1.0)
    return n.withColumn("flip", flip).select(*px.drop("ok").columns, *[(F.col("flip") * F.col(f"n{a}")).alias(f"n{a}") for a in "xyz"])


def log_gradient_edges(px: DataFrame, least: float, by: tuple = (), ieee: bool = False) -> DataFrame:
    """``log_edge``: the depth's log changes by more than ``least`` to a side neighbour (x goes round); the stand-in where no band is known.

    Depths that have no finite log have no edges.  With ``ieee`` theirs is
    infinite or NaN, and NaN exceeds every number, as in SQL.
    """
    ld = px.withColumn("ld", F.expr(g.log("d") if ieee else f"case when {g.finite('d')} then ln(d) end"))
    steps = [F.abs(F.col("ld") - shifted("ld", axis, s, border, by)) for axis, border in (("x", "wrap"), ("y", "none")) for s in (-1, 1)]
    return ld.withColumn("log_edge", F.coalesce(F.greatest(*steps) > least, F.lit(False))).drop("ld")


def edge_class(px: DataFrame, band: str, by: tuple = ()) -> DataFrame:
    """``edge``: within a square of 2 pixels of the band, round the seam."""
    return dilated(px, band, 2, "linf", True, by).withColumnRenamed(f"{band}_dilated", "edge")


def assembled(rows: DataFrame, layer: int, radius: str, opacity: str, flatten: float = DEFAULTS["s4"]["flatten"], stage: int = 4) -> DataFrame:
    """Splats of rows with ``ord``, point ``x, y, z``, normal, colour and what ``radius`` and ``opacity`` (expressions) need."""
    f = sp.frame("nx", "ny", "nz")
    m = [["t1x", "t2x", "nx"], ["t1y", "t2y", "ny"], ["t1z", "t2z", "nz"]]
    q = sp.quat_of(m)
    rows = rows.withColumns({k: F.expr(v) for k, v in f.items()}).withColumns({"radius": F.expr(radius), "alpha": F.expr(opacity)})
    return rows.select(
        "ord", *"xyz", "nx", "ny", "nz", *[F.expr(sp.to_dc(f"({c} / 255e0)")).alias(f"f_dc_{i}") for i, c in enumerate(("red", "grn", "blu"))], F.expr(sp.to_logit("alpha")).alias("opacity"),
        F.expr("ln(radius)").alias("scale_0"), F.expr("ln(radius)").alias("scale_1"), F.expr(f"ln(radius * {flatten}e0)").alias("scale_2"),
        *[F.expr(v).alias(f"rot_{i}") for i, v in enumerate(q)], F.lit(layer).cast("byte").alias("layer"), F.lit(stage).cast("byte").alias("origin_stage"),
    )


def place(px: DataFrame, p: dict = DEFAULTS["s4"], multiplier: float = 1.0, band: str | None = None, by: tuple = ()) -> DataFrame:
    """All splats of a raster with depth, sky, colour and, if ``band`` is named, background colour and depth (``bg_*``).

    Foreground, then background, then shell, each row-major: ``ord`` is a
    sparse key in that order, so nothing is sorted.
    """
    s = strides(p, multiplier)
    px = routed(px, p)
    px = edge_class(px, band, by) if band else log_gradient_edges(px, DEFAULTS["s3"]["log_grad_min"], by).withColumnRenamed("log_edge", "edge")
    px = classed(px, "edge", p, multiplier)
    px = thinned(color_variance(px, p["var_window_px"], by), p)
    at = normals(px, by).withColumn("at", F.expr("r * w + c"))
    size = f"(d * {g.PIXEL} * %s * {p['scale_multiplier']}e0)"
    fade = f"greatest(0e0, least(1e0, ({p['shell_m']}e0 - d) / {p['feather_m']}e0))"
    front = at.where(F.expr(f"content and {on_grid('stride')} and keep")).withColumns({a: F.expr(f"d{a} * d") for a in "xyz"}).withColumn("ord", F.col("at"))
    out = assembled(front, 0, size % "stride", f"{p['fg_opacity']}e0 * {fade}", p["flatten"])
    if band:
        back = at.where(F.expr(f"{band} and {on_grid(str(s['bg']))} and keep and {g.finite('bg_d')} and bg_d <= {p['shell_m']}e0"))
        back = back.withColumns({"red": F.col("bg_red"), "grn": F.col("bg_grn"), "blu": F.col("bg_blu"), "d": F.col("bg_d")}).withColumns({a: F.expr(f"d{a} * d") for a in "xyz"}).withColumn("ord", F.expr("h * w + at"))
        out = out.unionByName(assembled(back, 1, size % f"least({s['bg']}, stride)", f"{p['bg_opacity']}e0", p["flatten"]))
    far = at.where(F.expr(f"backdrop and {on_grid(str(s['shell']))}")).withColumns({f"n{a}": -F.col(f"d{a}") for a in "xyz"}).withColumns({a: F.expr(f"d{a} * {p['shell_radius_m']}e0") for a in "xyz"})
    far = far.withColumn("d", F.lit(p["shell_radius_m"])).withColumn("ord", F.expr("2 * h * w + at"))
    return out.unionByName(assembled(far, 2, size % str(s["shell"]), f"{p['shell_opacity']}e0", p["flatten"]))
