"""Spherical and pinhole geometry as SQL expressions over columns.

Conventions: right-handed, +Y up, longitude 0 looks along +Z.  A raster has
columns ``r``, ``c`` and its height and width ``h``, ``w``.  The expressions are
text that Spark's parser and other engines read alike (``e0`` marks doubles).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LON = "((c + 0.5e0) / w * 2e0 * pi() - pi())"
LAT = "(pi() / 2e0 - (r + 0.5e0) / h * pi())"
PITCH_DEG = f"degrees({LAT})"
DX, DY, DZ = f"(cos({LAT}) * sin({LON}))", f"sin({LAT})", f"(cos({LAT}) * cos({LON}))"
#: Angular size of a pixel.
PIXEL = "(pi() / h)"


def finite(x: str) -> str:
    """Neither null, NaN nor infinite."""
    return f"({x} is not null and not isnan({x}) and abs({x}) < 1e300)"


def log(x: str) -> str:
    """The natural logarithm as IEEE has it: -Infinity of 0 and NaN below, where ``ln`` gives null."""
    return f"(case when {x} = 0e0 then double('-Infinity') when {x} < 0e0 then double('NaN') else ln({x}) end)"


def to_uv(x: str, y: str, z: str) -> tuple[str, str]:
    """Raster coordinates of a direction."""
    norm = f"sqrt({x} * {x} + {y} * {y} + {z} * {z})"
    return f"((atan2({x}, {z}) + pi()) / (2e0 * pi()) * w - 0.5e0)", f"((pi() / 2e0 - asin(greatest(-1e0, least(1e0, {y} / {norm})))) / pi() * h - 0.5e0)"


def rotation(yaw_deg: str, pitch_deg: str) -> list[list[str]]:
    """Rows of the matrix that takes camera to world directions: yaw after pitch."""
    cy, sy, cp, sp = f"cos(radians({yaw_deg}))", f"sin(radians({yaw_deg}))", f"cos(radians({pitch_deg}))", f"sin(radians({pitch_deg}))"
    return [[cy, f"({sy} * -({sp}))", f"({sy} * {cp})"], ["0e0", cp, sp], [f"(-({sy}))", f"({cy} * -({sp}))", f"({cy} * {cp})"]]


def into_camera(x: str, y: str, z: str, yaw_deg: str, pitch_deg: str) -> tuple[str, str, str]:
    """A world direction in camera axes."""
    m = rotation(yaw_deg, pitch_deg)
    return tuple(f"({x} * {m[0][i]} + {y} * {m[1][i]} + {z} * {m[2][i]})" for i in range(3))  # type: ignore[return-value]


def into_world(x: str, y: str, z: str, yaw_deg: str, pitch_deg: str) -> tuple[str, str, str]:
    m = rotation(yaw_deg, pitch_deg)
    return tuple(f"({m[i][0]} * {x} + {m[i][1]} * {y} + {m[i][2]} * {z})" for i in range(3))  # type: ignore[return-value]


def face(x: str, y: str, z: str, yaw_deg: str, pitch_deg: str, fov_deg: str) -> dict[str, str]:
    """A unit direction on a square face: ``u01`` to the right, ``v01`` down, ``inside`` and ``center_cos``."""
    cx, cy, cz = into_camera(x, y, z, yaw_deg, pitch_deg)
    ahead, half = f"({cz} > 1e-9)", f"tan(radians({fov_deg}) / 2e0)"
    u = f"(case when {ahead} then ({cx} / ({cz}) / {half} + 1e0) / 2e0 else 0e0 end)"
    v = f"(case when {ahead} then (1e0 - ({cy}) / ({cz}) / {half}) / 2e0 else 0e0 end)"
    return {"u01": u, "v01": v, "inside": f"({ahead} and {u} >= 0e0 and {u} <= 1e0 and {v} >= 0e0 and {v} <= 1e0)", "center_cos": f"(case when {cz} > 0e0 then {cz} else 0e0 end)"}


def feather(center_cos: str, inside: str, fov_deg: str, least: float) -> str:
    """A face's weight: falls to 0 at the half-angle, and is 0 below ``least`` or outside."""
    c = f"cos(radians({fov_deg}) / 2e0)"
    w = f"power(greatest(0e0, least(1e0, ({center_cos} - {c}) / (1e0 - {c}))), 2)"
    return f"(case when {inside} and {w} >= {least}e0 then {w} else 0e0 end)"


def with_directions(px: DataFrame) -> DataFrame:
    """A raster with ``lon``, ``lat``, ``dx``, ``dy`` and ``dz``."""
    return px.withColumns({"lon": F.expr(LON), "lat": F.expr(LAT)}).withColumns({"dx": F.expr("cos(lat) * sin(lon)"), "dy": F.expr("sin(lat)"), "dz": F.expr("cos(lat) * cos(lon)")})


def ring_faces(count: int = 8, fov: float = 100.0) -> list[tuple[int, float, float, float]]:
    """(face, yaw, pitch, fov): a ring along the horizon, then zenith and nadir."""
    return [(i, 360.0 / count * i, 0.0, fov) for i in range(count)] + [(count, 0.0, 90.0, fov), (count + 1, 0.0, -90.0, fov)]


def ring_adjacency(count: int = 8) -> list[tuple[int, int]]:
    """Which faces overlap: neighbours in the ring, and each of the ring with both caps."""
    return [(i, (i + 1) % count) for i in range(count)] + [(i, count + cap) for cap in (0, 1) for i in range(count)]


def head_poses(lateral: float = 0.5, up: float = 0.2, squat: float = -0.9) -> list[tuple[str, float, float, float]]:
    """(name, x, y, z): the centre, the head box's extremes and a squat."""
    return [("center", 0.0, 0.0, 0.0), ("xpos", lateral, 0.0, 0.0), ("xneg", -lateral, 0.0, 0.0), ("zpos", 0.0, 0.0, lateral), ("zneg", 0.0, 0.0, -lateral), ("up", 0.0, up, 0.0), ("squat", 0.0, squat, 0.0)]


def tile_views(lon: int = 8, lat: int = 4) -> list[tuple[int, int, float, float, float]]:
    """(i, j, yaw, pitch, fov) of the tiles that cover a panorama, rows from the top."""
    dy, dp = 360.0 / lon, 180.0 / lat
    return [(i, j, -180.0 + (i + 0.5) * dy, 90.0 - (j + 0.5) * dp, max(dy, dp) + 6.0) for j in range(lat) for i in range(lon)]


def tile_starts(size: int, tile: int, overlap: int) -> list[int]:
    """Where tiles begin that cover ``size`` with at least this overlap; the last one ends at the edge."""
    if size <= tile:
        return [0]
    n = math.ceil((size - overlap) / (tile - overlap))
    return sorted({min(i * (tile - overlap), size - tile) for i in range(n)})


def taper(n: int) -> list[float]:
    """Triangular weights of a tile's places."""
    return [float(min(i + 1, n - i)) for i in range(n)]
