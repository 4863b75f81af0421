"""Word shingles of texts as 64-bit hashes, many texts at a time."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from quarry.llm.common import lower_bytes, mix64

SHINGLE = 5
#: Bytes whose words are hashed at a time; what a long text costs besides is a few bytes for each of its own.
SEGMENT = 1 << 19
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD6E8FEB86659FD93
_STEP = np.uint64(0xA0761D6478BD642F)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.ones(1, np.uint64)
        while len(p) < n:
            p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
        out.append(p[:n])
    return out[0], out[1]


def _cuts(gaps: np.ndarray, size: int) -> list[int]:
    """Bounds of pieces of about ``SEGMENT`` bytes that end behind white space; a longer word is one piece."""
    out = [0]
    while out[-1] < size:
        end = out[-1] + SEGMENT
        if end < size:
            at = np.searchsorted(gaps, end)
            if not at or gaps[at - 1] < out[-1]:  # a word longer than a piece: on to the next white space
                at = min(at + 1, len(gaps))
            end = int(gaps[at - 1]) + 1 if at and gaps[at - 1] >= out[-1] else size
        out.append(min(end, size))
    return out


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts with A-Z in lower case, and how many words each text has."""
    raw = [lower_bytes(t) for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    space = _SPACE[data]
    cuts, found, begins = _cuts(np.flatnonzero(space), len(data)), [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        part, gap = data[a:b], space[a:b]
        starts = np.flatnonzero(~gap & np.r_[True, gap[:-1]])
        stops = np.flatnonzero(~gap & np.r_[gap[1:], True]) + 1
        up, down = _powers(1 << max(20, len(part).bit_length()))
        sums = np.r_[np.uint64(0), np.cumsum(_BYTE[part] * up[: len(part)], dtype=np.uint64)]
        found.append(mix64((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64) * _STEP))
        begins.append(starts + a)
    ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
    return np.concatenate(found), np.diff(np.searchsorted(np.concatenate(begins), ends), prepend=0)


def shingle_sets(texts: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingles of each text: of fewer words, the whole sequence as one; of none, no shingle."""
    words, counts = word_hashes(texts)
    rolled = words
    if len(words) >= size:
        rolled = np.zeros(len(words) - size + 1, np.uint64)
        for i in range(size):
            rolled = mix64(rolled * _STEP + words[i : len(words) - size + 1 + i])
    out, at = [], 0
    for n in counts.tolist():
        if n >= size:
            out.append(np.unique(rolled[at : at + n - size + 1]))
        elif n:
            short = np.full(1, n, np.uint64)
            for w in words[at : at + n]:
                short = mix64(short * _STEP + w)
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out
