"""How much work language-model scoring does for a block and a shard."""

from __future__ import annotations

import math
import random
import tracemalloc
from collections import Counter

import numpy as np

from quarry.llm import lm_scoring
from quarry.llm.common import planes, squeeze


def test_strings_of_a_block_are_sorted_once(monkeypatch):
    """Before, each piece's strings were merged with those of all pieces before it; strings of larger blocks are merged a few times."""
    rng, merges, merged = random.Random(7), [], lm_scoring.sums_by
    bodies = [bytes(rng.choice(b"ab c\xc3\xa9") for _ in range(rng.randrange(300))) for _ in range(30)] + [b""]
    monkeypatch.setattr(lm_scoring, "AT_ONCE", 64)
    monkeypatch.setattr(lm_scoring, "sums_by", lambda *a: merges.append(1) or merged(*a))
    places = lm_scoring.Places(bodies, 3)
    want = Counter(int.from_bytes((b"\n\n\n" + b + b"\n")[i : i + 4][2::-1] + (b"\n\n\n" + b + b"\n")[i + 3 : i + 4], "big") for b in bodies for i in range(len(b) + 1))
    keys, counts = places.counted()
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == want and keys.tolist() == sorted(want) and not merges
    monkeypatch.setattr(lm_scoring, "SORTED", 200)
    assert all(np.array_equal(a, b) for a, b in zip(places.counted(), (keys, counts), strict=True)) and merges


def test_words_of_lists_are_added_up_by_number():
    """A list's answer takes its words' numbers; before, it was unpacked and looked up a second time."""
    lists = [{b"a": 3, b"b": 0}, {}, {b"": 5, b"b": 2, b"c": 0}]
    cells = [{"words": squeeze(b"\n".join(sorted(x))), "word_counts": squeeze(np.array([x[w] for w in sorted(x)], np.int64))} for x in lists]
    numbers, sums = lm_scoring._word_sums(cells)
    assert [sums[at].tolist() for at in numbers] == [[3, 2], [], [5, 2, 0]] and int(sums.sum()) == 10


def test_estimates_of_small_and_large_counts():
    zeros, ones = np.array([0, 1, 4096, 4097, 3, 10**9]), np.array([0, 0, 4096, 4096, 9000, 10**8])
    want = [math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1) for a, b in zip(zeros.tolist(), ones.tolist(), strict=True)]
    assert np.allclose(lm_scoring.log_kt(zeros, ones), want, rtol=1e-9, atol=1e-9)


def _replies(x: dict, bounds: list[int], depth: int) -> list[dict]:
    """Answers to a block's lists: a string's log-probability is a number made of it, the last shard's come first."""
    cells = list(lm_scoring._list_block(x, bounds, depth))[::-1]
    return [{"shard": s, "logs": squeeze(planes(_made(lm_scoring._grams(grams)))), "counts": counts} for s, _, grams, _, _, counts in cells]


def _made(strings: np.ndarray) -> np.ndarray:
    return -(strings % np.uint64(1009)).astype(float) / 7


def _block(bodies: list[bytes]) -> dict:
    return {"block": 0, "ids": list(range(len(bodies))), "ends": squeeze(np.cumsum([len(b) for b in bodies])), "data": squeeze(b"".join(bodies))}


def test_scoring_a_block_holds_no_number_for_each_place(monkeypatch):
    """Before, all places of a block had their order and their log-probability in memory at once: 16.6 bytes for each here, 3.0 now."""
    monkeypatch.setattr(lm_scoring, "AT_ONCE", 1 << 14)
    monkeypatch.setattr(lm_scoring, "SORTED", 1 << 14)
    rng = random.Random(3)
    words = [bytes(rng.choice(b"abcdef") for _ in range(5)) for _ in range(300)]
    bodies = [b" ".join(rng.choices(words, k=3000)) for _ in range(60)]
    x, bounds, places = _block(bodies), [98 << 16, 101 << 16], sum(len(b) + 1 for b in bodies)
    replies = _replies(x, bounds, 3)
    tracemalloc.start()
    rows = list(lm_scoring._score_block(x, replies, len(bounds) + 1, 3, 10**6, 10**4))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(rows) == 60 and peak < 8 * places


def test_a_cut_text_scores_the_same_in_any_block(monkeypatch):
    """Pieces end with texts; before, they ended at places of the block, wherever these lay in a text."""
    rng, depth, bounds = random.Random(5), 3, [98 << 16]
    bodies = [b" ".join(bytes(rng.choice(b"abc\xc3\xa9") for _ in range(rng.randrange(1, 9))) for _ in range(rng.choice([0, 3, 9, 200]))) for _ in range(40)]

    def scores(some: list[bytes]) -> list[float]:
        x = _block(some)
        return [row[6] for row in lm_scoring._score_block(x, _replies(x, bounds, depth), len(bounds) + 1, depth, 100, 10)]

    whole = scores(bodies)
    for body, score in zip(bodies, whole, strict=True):
        at = lm_scoring.Places([body], depth)
        assert math.isclose(score, math.fsum(_made(at.strings(np.flatnonzero(at.told))).tolist()), rel_tol=1e-12)
    monkeypatch.setattr(lm_scoring, "AT_ONCE", 64)
    monkeypatch.setattr(lm_scoring, "SORTED", 100)
    assert np.allclose(scores(bodies), whole, rtol=1e-12, atol=0)
    assert scores(bodies) == [scores([b])[0] for b in bodies] == scores(bodies[::-1])[::-1]
    places = lm_scoring.Places(bodies, depth)
    at, lengths = np.cumsum([len(p) for p in places.pieces()]), np.diff(places.ends, prepend=0)
    inside = np.setdiff1d(at, places.ends)  # where a piece ends within a text
    assert at[-1] == places.ends[-1] and len(inside) and lengths[np.searchsorted(places.ends, inside)].min() > 64 - depth


def test_distinct_strings_are_known_from_small_tables(monkeypatch):
    rng = random.Random(11)
    bodies = [bytes(rng.choice(b"ab c\xc3\xa9") for _ in range(rng.randrange(300))) for _ in range(30)] + [b""]
    places = lm_scoring.Places(bodies, 3)
    want = places.counted()[0]
    for at_once, most in ((1 << 20, 1 << 21), (64, 1), (64, 200), (7, 5000)):
        monkeypatch.setattr(lm_scoring, "AT_ONCE", at_once)
        monkeypatch.setattr(lm_scoring, "SORTED", most)
        assert np.array_equal(places.known(), want)
    assert not len(lm_scoring.Places([], 3).known())
