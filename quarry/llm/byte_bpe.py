"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is split by the tokenizer's pattern; each match (pre-token) is merged
on its own, but many of them share a queue.  The queue holds, for each merge
rank, the linked-list positions at which that merge is possible.  Three levels
of 64-bit words mark the ranks that have positions, so find-first-set gives the
next rank in three steps however long the pre-tokens are.  Merging a pair leaves stale entries behind;
they are recognised when they come up and skipped.  Pre-tokens of n bytes in
all take O(n log n) steps at worst, which keeps very long ones cheap.

Short pre-tokens repeat, so each worker keeps the ids of those it has merged
in a table of bounded size.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache, partial
from heapq import heappop, heappush
from itertools import islice, pairwise
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import columns, runs, texts_of

#: Pre-tokens of up to so many characters are remembered, so many of them in each of two generations in a worker.
SHORT, REMEMBERED = 24, 1 << 18
#: Characters of texts that are split at a time, and bytes of their new pre-tokens that share a queue (more leave the processor's cache).
AT_ONCE, QUEUED = 1 << 17, 1 << 14
#: Texts longer than this are split piece by piece, with bounded memory.
LONG = 1 << 20


class ByteBpe:
    """``ranks``: bytes of each token with its rank, which is its id. Every single byte must be a token.

    ``merged`` keeps its queue in plain local variables, since most pre-tokens
    are short: ``buckets`` has the positions of each rank (a heap, leftmost
    first), ``leaf`` a bit for each rank, ``middle`` a bit for each word of
    ``leaf`` that isn't 0, and ``top`` a bit for each such word of ``middle``.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.pieces = regex.compile(pattern)
        self.token = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.byte = np.array([ranks[bytes([i])] for i in range(256)])
        #: What two adjacent tokens merge to: the rank of their joined bytes, by both ids in one integer.
        self.pair = {left << 32 | right: rank for t, rank in ranks.items() for i in range(1, len(t)) if (left := ranks.get(t[:i])) is not None and (right := ranks.get(t[i:])) is not None}
        #: The same of two bytes.
        self.two = np.array([[self.pair.get(a << 32 | b, -1) for b in self.byte.tolist()] for a in self.byte.tolist()])
        #: Whether a token begins a pair, ends one, and whether one of its pairs has a lower rank than its own.
        self.begins, self.ends, self.lower = (bytearray(len(self.token)) for _ in range(3))
        for both, rank in self.pair.items():
            left, right = both >> 32, both & 0xFFFFFFFF
            self.begins[left] = self.ends[right] = 1
            self.lower[left] |= rank < left
            self.lower[right] |= rank < right
        self.bit = [1 << i for i in range(64)]
        self.leaf = [0] * ((len(self.token) >> 6) + 1)  # all 0 between calls
        self.middle = [0] * ((len(self.token) >> 12) + 1)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        return np.frombuffer(self.merged([piece])[0], "<u4").tolist()

    def merged(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each of some pre-tokens that are no tokens, four bytes each, by one queue for all of them.

        They lie one after the other with a gap on both sides of each, which pairs with nothing.
        What comes up next anywhere is next in its own pre-token too.
        """
        gap, bit, leaf, middle, rank_of = len(self.token), self.bit, self.leaf, self.middle, self.pair.get
        raw = np.frombuffer(b"\0".join([b"", *pieces, b""]), np.uint8)
        gaps = np.cumsum([0, *[len(p) + 1 for p in pieces]])
        ids, pairs = self.byte[raw], np.append(self.two[raw[:-1], raw[1:]], -1)  # what a position and the next one merge to; -1 for nothing
        ids[gaps], pairs[gaps], pairs[gaps[1:] - 1] = gap, -1, -1
        part, due, n = ids.tolist(), pairs.tolist(), len(raw)  # ids by position; -1 once merged into the left
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        at = np.flatnonzero(pairs >= 0)
        at = at[np.argsort(pairs[at], kind="stable")]
        first = np.flatnonzero(np.diff(pairs[at], prepend=-1))
        places, cuts = at.tolist(), [*first.tolist(), len(at)]
        buckets = {r: places[a:b] for r, a, b in zip(pairs[at[first]].tolist(), cuts, cuts[1:], strict=False)}
        top = 0
        for rank in buckets:
            leaf[rank >> 6] |= bit[rank & 63]
            middle[rank >> 12] |= bit[rank >> 6 & 63]
            top |= bit[rank >> 12]
        while top:
            word = (top & -top).bit_length() - 1
            mask = middle[word]
            word = word << 6 | (mask & -mask).bit_length() - 1
            mask = leaf[word]
            rank = word << 6 | (mask & -mask).bit_length() - 1
            held, begins, ends, lower, opened = buckets[rank], self.begins[rank], self.ends[rank], self.lower[rank], []
            if lower:
                take = partial(heappop, held)
            else:  # nothing can come before the rest of these
                held.sort(reverse=True)
                take = held.pop
            while held:
                i = take()
                if due[i] != rank:
                    continue  # stale
                j = after[i]
                after[i] = k = after[j]
                before[k] = i
                part[i] = rank
                part[j] = due[i] = due[j] = -1
                if begins and (r := rank_of(rank << 32 | part[k], -1)) >= 0:
                    due[i] = r
                    if r in buckets:
                        heappush(buckets[r], i)
                    else:
                        buckets[r] = [i]
                        opened.append(r)
                h = before[i]
                due[h] = r = rank_of(part[h] << 32 | rank, -1) if ends else -1
                if r >= 0:
                    if r in buckets:
                        heappush(buckets[r], h)
                    else:
                        buckets[r] = [h]
                        opened.append(r)
                if lower and opened and min(opened[-2:]) < rank:
                    break  # that comes first
            if not held:
                del buckets[rank]
                leaf[word] = mask = mask & mask - 1
                if not mask:
                    middle[word >> 6] = mask = middle[word >> 6] ^ bit[word & 63]
                    if not mask:
                        top ^= bit[word >> 6]
            for r in opened:
                leaf[r >> 6] |= bit[r & 63]
                middle[r >> 12] |= bit[r >> 6 & 63]
                top |= bit[r >> 12]
        ids = np.array(part)
        left = (ids >= 0) & (ids < gap)
        ends = (4 * np.cumsum(left)[gaps]).tolist()
        out = ids[left].astype("<u4").tobytes()
        return [out[a:b] for a, b in pairwise(ends)]

    def _learned(self, pieces: set[str]) -> dict[str, bytes]:
        """The ids of pre-tokens that the newer table hasn't; short ones are remembered."""
        new: dict[str, bytes] = {}
        queued, raws, n = [], [], 0
        for piece in pieces:
            if (out := self.older.pop(piece, None)) is not None:  # it moves to the newer table
                new[piece] = out
                continue
            raw = piece.encode("utf-8")
            if (whole := self.ranks.get(raw)) is not None:
                new[piece] = pack("<I", whole)
                continue
            queued.append(piece)
            raws.append(raw)
            n += len(raw)
            if n >= QUEUED:
                new.update(zip(queued, self.merged(raws), strict=True))
                queued, raws, n = [], [], 0
        if queued:
            new.update(zip(queued, self.merged(raws), strict=True))
        if len(self.known) >= REMEMBERED:
            self.older, self.known = self.known, {}
        self.known.update((p, out) for p, out in new.items() if len(p) <= SHORT)
        return new

    def _joined(self, lists: list[list[str]]) -> list[bytes]:
        """The ids of each of some lists of pre-tokens."""
        found = [list(map(self.known.get, pieces)) for pieces in lists]
        new = self._learned({p for pieces, outs in zip(lists, found, strict=True) for p, out in zip(pieces, outs, strict=True) if out is None})
        return [b"".join([new[p] if out is None else out for p, out in zip(pieces, outs, strict=True)]) for pieces, outs in zip(lists, found, strict=True)]

    def _ids(self, piece: str) -> bytes:
        return self._joined([[piece]])[0]

    def encode(self, text: str) -> bytes:
        """The ids, each as four bytes with the lowest first."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as ``encode`` gives them."""
        out: list[bytes] = []
        for some in runs(texts, len, AT_ONCE):
            if len(some) == 1 and len(some[0]) > LONG:
                found, parts = self.pieces.finditer(some[0]), []
                while held := [m.group() for m in islice(found, 1 << 16)]:
                    parts += self._joined([held])
                out.append(b"".join(parts))
            else:
                out += self._joined(list(map(self.pieces.findall, some)))
        return out

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def read_ranks(spark: SparkSession, path: str) -> bytes:
    """The vocabulary file's content: base64 token and rank on each line. Read on the driver, sent with the tasks."""
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def tokenizer(vocabulary: bytes, pattern: str) -> ByteBpe:
    lines = (line.split() for line in vocabulary.splitlines() if line.strip())
    return ByteBpe({base64.b64decode(token): int(rank) for token, rank in lines}, pattern)


def _arrow_in_place(df: DataFrame, column: str, new: str, make) -> DataFrame:
    """The rows with a binary column that ``make`` derives from a column, batch by batch."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = make()
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                yield batch.append_column(new, pa.array(of(batch), pa.binary()))

    return df.mapInArrow(work, df.select("*", F.lit(b"").alias(new)).schema)


def encode(docs: DataFrame, vocabulary: bytes, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The rows with the ids of their whole text in a binary column, four bytes each, lowest first.

    No special tokens.  Null and empty texts have no ids.  Repeated rows are
    encoded each.  ``ids_col`` must not be a column already.
    """
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        bpe = tokenizer(held.value, pattern)
        return lambda batch: bpe.encode_all(texts_of(batch, text_col))

    return _arrow_in_place(docs, text_col, ids_col, make)


def decode(coded: DataFrame, vocabulary: bytes, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """The rows with the bytes their ids stand for in a binary column; null ids give no bytes."""
    held = coded.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        bpe = tokenizer(held.value, pattern)
        return lambda batch: [bpe.decode(x or b"") for x in batch.column(batch.schema.get_field_index(ids_col)).to_pylist()]

    return _arrow_in_place(coded, ids_col, bytes_col, make)


def encoded_documents(docs: DataFrame, vocabulary: bytes, pattern: str) -> DataFrame:
    """(doc_id, ids) of documents."""
    return encode(columns(docs, "doc_id", "text"), vocabulary, pattern).select("doc_id", "ids")
