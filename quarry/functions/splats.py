"""Codecs and frames of splats as SQL expressions."""

from __future__ import annotations

#: Fixed value: the constant spherical harmonic.
SH0 = "0.28209479177387814e0"
#: Weights of luma.
LUMA = "(0.299e0 * red + 0.587e0 * grn + 0.114e0 * blu) / 255e0"


def to_dc(x: str) -> str:
    return f"(({x} - 0.5e0) / {SH0})"


def from_dc(x: str) -> str:
    return f"({x} * {SH0} + 0.5e0)"


def to_logit(a: str) -> str:
    a = f"greatest(1e-6, least(1e0 - 1e-6, {a}))"
    return f"ln({a} / (1e0 - {a}))"


def from_logit(x: str) -> str:
    return f"(1e0 / (1e0 + exp(-({x}))))"


def to_byte(x: str, rint: str = "rint") -> str:
    """0..1 as 0..255, halves to even."""
    return f"{rint}(greatest(0e0, least(255e0, {x} * 255e0)))"


def canonical_quat(w: str, x: str, y: str, z: str) -> list[str]:
    """Unit length, w not negative."""
    norm = f"greatest(sqrt({w} * {w} + {x} * {x} + {y} * {y} + {z} * {z}), 1e-12)"
    return [f"((case when {w} < 0e0 then -1e0 else 1e0 end) * {v} / {norm})" for v in (w, x, y, z)]


def frame(nx: str, ny: str, nz: str) -> dict[str, str]:
    """Unit tangents of a unit normal: t1 = up x n, t2 = n x t1; up is +X where the normal is nearly vertical."""
    steep = f"(abs({ny}) > 0.9e0)"
    # up x n for up = (0, 1, 0): (nz, 0, -nx); for up = (1, 0, 0): (0, -nz, ny)
    ax, ay, az = f"(case when {steep} then 0e0 else {nz} end)", f"(case when {steep} then -({nz}) else 0e0 end)", f"(case when {steep} then {ny} else -({nx}) end)"
    norm = f"greatest(sqrt({ax} * {ax} + {ay} * {ay} + {az} * {az}), 1e-12)"
    t = [f"({v} / {norm})" for v in (ax, ay, az)]
    return {"t1x": t[0], "t1y": t[1], "t1z": t[2], "t2x": f"({ny} * {t[2]} - {nz} * {t[1]})", "t2y": f"({nz} * {t[0]} - {nx} * {t[2]})", "t2z": f"({nx} * {t[1]} - {ny} * {t[0]})"}


def rotation_of(w: str, x: str, y: str, z: str) -> dict[str, str]:
    """The matrix of a unit quaternion."""
    return {
        "m00": f"(1e0 - 2e0 * ({y} * {y} + {z} * {z}))", "m01": f"(2e0 * ({x} * {y} - {w} * {z}))", "m02": f"(2e0 * ({x} * {z} + {w} * {y}))",
        "m10": f"(2e0 * ({x} * {y} + {w} * {z}))", "m11": f"(1e0 - 2e0 * ({x} * {x} + {z} * {z}))", "m12": f"(2e0 * ({y} * {z} - {w} * {x}))",
        "m20": f"(2e0 * ({x} * {z} - {w} * {y}))", "m21": f"(2e0 * ({y} * {z} + {w} * {x}))", "m22": f"(1e0 - 2e0 * ({x} * {x} + {y} * {y}))",
    }


def quat_of(m: list[list[str]]) -> list[str]:
    """The canonical quaternion of a rotation matrix, by its largest component (the first of equals)."""
    (a, b, c), (d, e, f), (g, h, i) = m
    squares = [f"(1e0 + {a} + {e} + {i})", f"(1e0 + {a} - {e} - {i})", f"(1e0 - {a} + {e} - {i})", f"(1e0 - {a} - {e} + {i})"]
    products = [
        ["q", f"({h} - {f})", f"({c} - {g})", f"({d} - {b})"],
        [f"({h} - {f})", "q", f"({b} + {d})", f"({c} + {g})"],
        [f"({c} - {g})", f"({b} + {d})", "q", f"({f} + {h})"],
        [f"({d} - {b})", f"({c} + {g})", f"({f} + {h})", "q"],
    ]
    most = f"greatest({', '.join(squares)})"
    raw = []
    for k in range(4):
        cases = " ".join(f"when {squares[p]} >= {most} then {squares[p] if products[p][k] == 'q' else products[p][k]}" for p in range(4))
        raw.append(f"(case {cases} end / (2e0 * sqrt({most})))")
    sign = f"(case when {raw[0]} < 0e0 then -1e0 else 1e0 end)"
    return [f"({sign} * {v})" for v in raw]
