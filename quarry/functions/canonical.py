"""Canonical JSON: sorted keys, no NaN or infinity, the same bytes for the same value."""

from __future__ import annotations

import hashlib
import json
import math
from typing import Any


def _finite(x: Any) -> None:
    if isinstance(x, float) and not math.isfinite(x):
        raise ValueError("canonical JSON holds finite numbers only")
    for v in x.values() if isinstance(x, dict) else x if isinstance(x, list | tuple) else ():
        _finite(v)


def canonical_json(x: Any) -> bytes:
    """UTF-8 bytes without white space."""
    _finite(x)
    return json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False).encode()


def sha256_json(x: Any) -> str:
    return hashlib.sha256(canonical_json(x)).hexdigest()


def pretty_json(x: Any) -> str:
    """The form that files have: sorted keys, two spaces, one line end."""
    _finite(x)
    return json.dumps(x, sort_keys=True, indent=2, ensure_ascii=False, allow_nan=False) + "\n"


def number_or_text(x: float) -> float | str:
    """Non-finite numbers as text."""
    return x if math.isfinite(x) else repr(x)
