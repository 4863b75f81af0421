"""How much work byte-level BPE does, and what it remembers."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import tiktoken

from quarry.llm import byte_bpe, registry


@pytest.fixture(scope="module")
def bpe():
    with open(public_tokenizers.path(registry.VOCABULARY), "rb") as f:
        made = byte_bpe.tokenizer.__wrapped__(f.read(), public_tokenizers.PATTERN)
    return made


def test_pairs_are_looked_up_for_merges_only(bpe, monkeypatch):
    """Two lookups a merge at most; stale entries and bytes side by side need none."""

    class Counted(dict):
        n = 0

        def get(self, *a):
            Counted.n += 1
            return dict.get(self, *a)

    rng = random.Random(4)
    pieces = ["".join(rng.choice("aeiounrst") for _ in range(n)) for n in (1, 2, 9, 15, 24, 400)] + ["a" * 999, "é" * 50, " \U0001f600x"]
    whole = tiktoken.Encoding("t", pat_str=r"[\s\S]+", mergeable_ranks=bpe.ranks, special_tokens={})
    monkeypatch.setattr(bpe, "pair", Counted(bpe.pair))
    for piece in pieces:
        Counted.n, raw = 0, piece.encode()
        ids = bpe.merge(raw)
        assert ids == whole.encode_ordinary(piece) and Counted.n <= 2 * (len(raw) - len(ids))


def test_pieces_are_in_one_table(bpe, monkeypatch):
    """A pre-token of the older table moves to the newer one; before, both held it, each with a key of its own."""
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 100)
    bpe.known, bpe.older = {}, {}
    for i in (*range(150), *range(40)):
        bpe.known.get(f"q{i}") or bpe._ids(f"q{i}")
    assert len(bpe.known) == 90 and len(bpe.older) == 60 and not bpe.known.keys() & bpe.older.keys()


def test_new_pieces_share_a_queue(bpe, monkeypatch):
    """Before, each new pre-token had a queue of its own."""
    rng, calls, merged = random.Random(5), [], bpe.merged
    texts = [" ".join("".join(rng.choice("aeioénrst") for _ in range(rng.randrange(1, 40))) for _ in range(rng.randrange(60))) for _ in range(80)]
    monkeypatch.setattr(bpe, "merged", lambda pieces: calls.append(len(pieces)) or merged(pieces))
    bpe.known, bpe.older = {}, {}
    whole = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    assert [memoryview(ids).cast("I").tolist() for ids in bpe.encode_all(texts)] == [whole.encode_ordinary(t) for t in texts]
    assert sum(calls) > 2000 and len(calls) < 10


def test_lower_ranks_come_first_in_a_shared_queue():
    """Tokens in any order: a merge may make a pair of a lower rank, which comes before what is left of its own."""
    rng = random.Random(6)
    for _ in range(60):
        longer = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))) for _ in range(rng.randrange(1, 60))})
        rng.shuffle(longer)
        ranks = {t: r for r, t in enumerate([bytes([i]) for i in range(256)] + longer)}
        made = byte_bpe.ByteBpe(ranks, r"\S+|\s+")
        whole = tiktoken.Encoding("t", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
        texts = ["".join(rng.choice("aabbcc d") for _ in range(rng.randrange(300))) for _ in range(5)]
        assert [memoryview(ids).cast("I").tolist() for ids in made.encode_all(texts)] == [whole.encode_ordinary(t) for t in texts]
        assert not any(made.leaf) and not any(made.middle)
