"""Small files at the end of a run, made on the driver: PNG images, archives, a page of verdicts."""

from __future__ import annotations

import base64
import html
import io
import struct
import zipfile
import zlib

import numpy as np


def png(image: np.ndarray) -> bytes:
    """8-bit gray or RGB, no metadata, the same bytes for the same pixels; masks become 0 and 255."""
    if image.dtype == bool:
        image = image.astype(np.uint8) * 255
    if image.dtype != np.uint8 or image.ndim not in (2, 3):
        raise TypeError("8-bit images only")
    h, w = image.shape[:2]
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    lines = np.zeros((h, image.size // max(h, 1) + 1), np.uint8)
    lines[:, 1:] = image.reshape(h, -1)
    head = struct.pack(">IIBBBBB", w, h, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def archive(files: dict[str, bytes]) -> bytes:
    """A zip that depends on names and contents alone."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=6) as z:
        for name in sorted(files):
            info = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
            info.compress_type = zipfile.ZIP_DEFLATED
            z.writestr(info, files[name])
    return out.getvalue()


def page(title: str, verdicts: list[dict], images: dict[str, bytes]) -> str:
    """A self-contained page: a row for each verdict (gate, pass, metrics, thresholds), then the images."""
    text = lambda d: ", ".join(f"{k}={d[k]!r}" for k in sorted(d)) or "-"
    rows = "".join(f"<tr><td>{html.escape(v['gate'])}</td><td>{'pass' if v['pass'] else 'fail'}</td><td>{html.escape(text(v['metrics']))}</td><td>{html.escape(str(v['thresholds']))}</td></tr>" for v in sorted(verdicts, key=lambda v: v["gate"]))
    shown = "".join(f'<figure><img alt="{html.escape(n)}" src="data:image/png;base64,{base64.b64encode(images[n]).decode()}"><figcaption>{html.escape(n)}</figcaption></figure>' for n in sorted(images))
    return f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><table><tr><th>gate<th>result<th>metrics<th>thresholds</tr>{rows}</table>{shown}\n"


def text_table(rows: list[dict], columns: list[str]) -> str:
    """Columns of equal width; floats with four places, nothing as a dash."""
    shown = [[("-" if r.get(c) is None else f"{r[c]:.4f}" if isinstance(r[c], float) else str(r[c])) for c in columns] for r in rows]
    width = [max(len(x) for x in (c, *[s[i] for s in shown])) for i, c in enumerate(columns)]
    return "\n".join("  ".join(x.ljust(n) for x, n in zip(line, width, strict=True)).rstrip() for line in (columns, *shown)) + "\n"
