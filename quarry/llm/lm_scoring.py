"""Language-model scoring by context-tree weighting over bytes.

The model predicts the bytes of a text's words, joined by one space and closed
by a line end, from up to ``DEPTH`` bytes before.  A byte is eight binary
decisions; each decision (the bits of the byte so far) has a context tree whose
nodes at depth d are the last d bytes.  A node weighs its own
Krichevsky-Trofimov estimate against its children's product, half and half, so
all depths are mixed by how well each explains the training texts.  After
training the counts stand still: a decision's probability is the mixture along
the path of its context, and where a path leaves the tree the rest of the
weight says one half.

Counts come from all training texts, none is pruned, and both the counts and the
tree are spread over shards that are ranges of contexts, ordered by their last
byte, then the one before, and so on.  The bounds are quantiles of the texts'
own contexts, so that a frequent ending is cut as finely as it needs:

1. Documents are packed in blocks.  Each block lists its distinct
   (context, byte) strings and words, with their training counts, and sends each
   shard its part.
2. A shard adds up the lists that it got, and builds the nodes whose contexts lie
   wholly in its range.  Contexts that a bound cuts, at most ``DEPTH`` for each
   bound, are left open: the shard gives their counts and the products of the
   children it has, as far as it has them.
3. These parts are added up by context.  The driver gets one row for each open
   context (a few kilobytes, as many as there are bounds times depths at most)
   and weighs them from the deepest to the root.
4. Each shard answers each block's list with log-probabilities and word counts.
5. Each block scores its documents from the answers.

There are as many shards as blocks, so what a shard holds doesn't grow with the
corpus; what grows is the number of lists, blocks times shards.  Log-probabilities
travel as doubles of 37 significant bits.

The base score is the unigram model with one added to each count.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import blocks, give_back, lower_bytes, planes, saved, squeeze, sums_by, table, unplanes, unsqueeze

#: Bytes of context, by default and at most: a string of context and byte must fit 64 bits.
DEPTH, DEEPEST = 6, 7
BLOCK_BYTES = 8 << 20
#: Places whose strings are in memory at a time.
AT_ONCE = 1 << 20
#: Strings that are sorted at a time to be counted, in one array of 16 MB.
SORTED = 2 << 20
#: Of so many places of a block, one tells where bounds of shards should be.
SPARSE = 997
#: Every text ends with this byte, and contexts before a text's start are made of it.
END = 10
_HALF_LOGS = np.concatenate([[0.0], np.cumsum(np.log(np.arange(4096) + 0.5))])  # of (n - 1/2)(n - 3/2)...(1/2)
_LOGS = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 8193)))])  # of n!


def held_out(doc_id: int | None, parts: int = 7, part: int = 2) -> bool:
    """Whether the CRC-32 of the id as text leaves this remainder; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % parts == part


def _log_half(n: np.ndarray) -> np.ndarray:
    """ln of Gamma(n + 1/2) / Gamma(1/2)."""
    out, large = _HALF_LOGS[np.minimum(n, 4096)], np.flatnonzero(n > 4096)
    x = n[large] + 0.5
    out[large] = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) - 0.5 * np.log(np.pi)
    return out


def _log_factorial(n: np.ndarray) -> np.ndarray:
    out, large = _LOGS[np.minimum(n, 8192)], np.flatnonzero(n > 8192)
    x = n[large] + 1.0
    out[large] = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    return _log_half(zeros) + _log_half(ones) - _log_factorial(zeros + ones)


class Places:
    """The predicted places of some texts, and the strings of context and byte there.

    A string has the byte lowest, the last byte of context highest.
    """

    def __init__(self, bodies: list[bytes], depth: int) -> None:
        self.depth, pad = depth, bytes([END]) * depth
        self.raw = np.frombuffer(pad.join([b"", *[b + bytes([END]) for b in bodies]]), np.uint8)
        #: where each text's places end, counted in places
        self.ends = np.cumsum([len(b) + 1 for b in bodies], dtype=np.int64)
        starts = np.r_[0, self.ends[:-1]] + depth * np.arange(len(bodies)) if len(bodies) else np.zeros(0, np.int64)
        self.told = np.ones(len(self.raw), bool)
        for d in range(depth):
            self.told[starts + d] = False

    def strings(self, at: np.ndarray) -> np.ndarray:
        key = self.raw[at].astype(np.uint64)
        for d in range(1, self.depth + 1):
            key |= self.raw[at - d].astype(np.uint64) << np.uint64(8 * (self.depth + 1 - d))
        return key

    def pieces(self) -> Iterator[np.ndarray]:
        """The strings, in order, some at a time: whole texts, but one of more places is cut, as told from its own start.

        So sums over pieces don't depend on what else is in a block.
        """
        stops, begin = self.ends + self.depth * np.arange(1, len(self.ends) + 1), 0
        while begin < len(self.raw):
            whole = int(np.searchsorted(stops, begin + AT_ONCE, "right"))
            stop = begin + AT_ONCE if not whole or stops[whole - 1] <= begin else int(stops[whole - 1])
            start = max(begin, self.depth)  # the first places are never predicted, so each has its context before it
            wide = self.raw[start - self.depth : stop].astype(np.uint64)
            key = wide[self.depth :].copy()
            for d in range(1, self.depth + 1):
                key |= wide[self.depth - d : len(wide) - d] << np.uint64(8 * (self.depth + 1 - d))
            del wide
            key = key[self.told[start:stop]]
            yield key
            del key  # so that there are never two pieces
            begin = stop

    def sparse(self, step: int) -> np.ndarray:
        """Distinct strings at one of so many places."""
        return distinct(self.strings(np.flatnonzero(self.told)[::step]))[0]

    def known(self) -> np.ndarray:
        """Distinct strings in order."""
        held, n = np.empty(min(int(self.ends[-1]) if len(self.ends) else 0, SORTED), np.uint64), 0
        for piece in self.pieces():
            piece.sort()
            piece = piece[firsts(piece)]
            if n + len(piece) > len(held):
                new = held[:n]
                new.sort()
                new = new[firsts(new)]
                held, n = np.empty(max(len(new) + len(piece), 2 * len(new), len(held)), np.uint64), len(new)
                held[:n] = new
                del new
            held[n : n + len(piece)] = piece
            n += len(piece)
            del piece
        held = held[:n]
        held.sort()
        return held[firsts(held)]

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct strings in order and how often each occurs."""
        keys, counts, left = np.zeros(0, np.uint64), np.zeros(0, np.int64), int(self.ends[-1]) if len(self.ends) else 0
        held, n = np.empty(min(left, SORTED), np.uint64), 0
        for piece in self.pieces():
            while len(piece):
                some = piece[: len(held) - n]
                held[n : n + len(some)] = some
                piece, n, left = piece[len(some) :], n + len(some), left - len(some)
                del some
                if n == len(held) or not left:
                    new, times = distinct(held[:n], in_place=True)
                    held, n = None, 0  # not needed while the sums are merged
                    if len(keys):
                        both = [np.concatenate([keys, new]), np.concatenate([counts, times])]
                        del keys, counts, new, times
                        keys, counts = sums_by(both.pop(0), both.pop())  # which lets go of them in turn
                    else:
                        keys, counts = new, times
                    held = np.empty(min(left, SORTED), np.uint64)
        return keys, counts


def distinct(keys: np.ndarray, in_place: bool = False) -> tuple[np.ndarray, np.ndarray]:
    keys = keys if in_place else keys.copy()
    keys.sort()
    first = firsts(keys)
    return keys[first], np.diff(np.r_[first, len(keys)])


def firsts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)


def split_contexts(bounds: list[int], d: int, depth: int) -> np.ndarray:
    """The contexts of depth d that some of the bounds (contexts of full depth) cut; the root always counts as cut."""
    if d == 0:
        return np.zeros(1, np.uint64)
    below = 8 * (depth - d)
    return np.array(sorted({b >> below for b in bounds if b & ((1 << below) - 1)}), np.uint64)


class Tree:
    """The trees over the distinct strings of one range of contexts, with their counts (0 where only held-out texts have one).

    ``levels[d]`` has, for the strings cut to d bytes of context, ``keys``, the
    place ``above`` of each in the level above, and for each of a byte's eight
    decisions its nodes: their number for each key, those of cut contexts, the
    share of their own estimate, that estimate, and whether training has seen them.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray, depth: int, bounds: list[int]) -> None:
        self.depth, self.levels, self.open = depth, {}, {}
        keys, sums = grams, counts.astype(np.int64)
        wholes: list[np.ndarray] = []  # of the level below, by decision
        below: dict = {}
        for d in range(depth, -1, -1):
            split = split_contexts(bounds, d, depth)
            here = {"keys": keys, "number": [], "cut": [], "stop": [], "one": [], "seen": []}
            mine, products = [], np.zeros((len(split), 256))
            for t in range(8):
                node = keys >> np.uint64(8 - t)
                first = firsts(node)
                number = np.zeros(len(keys), np.int32)
                number[first[1:]] = 1
                number = np.cumsum(number, dtype=np.int32)
                node, bit = node[first], (keys >> np.uint64(7 - t)) & np.uint64(1)
                n, ones = (np.add.reduceat(v, first) if len(first) else sums[:0] for v in (sums, np.where(bit == 1, sums, 0)))
                own = log_kt(n - ones, ones)
                if d == depth:
                    product, whole, stop = np.zeros(len(node)), own, np.ones(len(node))
                else:
                    parent = number[below["above"][below["first"][t]]]
                    product = np.bincount(parent, weights=wholes[t], minlength=len(node))
                    whole = np.log(0.5) + np.logaddexp(own, product)
                    stop = np.exp(np.log(0.5) + own - whole)
                # what a cut context's children here add to its product; the rest is settled above
                cut = np.flatnonzero(np.isin(node >> np.uint64(t), split)) if d < depth else np.zeros(0, np.int64)
                context, prefix = node[cut] >> np.uint64(t), (1 << t) + (node[cut] & np.uint64((1 << t) - 1)).astype(int)
                products[np.searchsorted(split, context), prefix] = product[cut]
                whole[cut] = 0.0
                mine.append(whole)
                for name, value in (("number", number), ("cut", (cut, context, prefix)), ("stop", stop), ("one", (ones + 0.5) / (n + 1.0)), ("seen", n > 0)):
                    here[name].append(value)
                here.setdefault("first", []).append(first)
            if d < depth:
                for i, context in enumerate(split.tolist()):
                    of = keys >> np.uint64(8) == np.uint64(context)
                    if of.any():
                        self.open[d, context] = np.bincount((keys[of] & np.uint64(255)).astype(int), weights=sums[of], minlength=256).astype(np.int64), products[i]
            below.pop("first", None)
            self.levels[d], wholes, below = here, mine, here
            if d:
                up = ((keys >> np.uint64(16)) << np.uint64(8)) | keys & np.uint64(255)
                order = np.argsort(up, kind="stable")
                first = firsts(up[order])
                above = np.zeros(len(up), np.int32)
                place = np.zeros(len(up), np.int32)
                place[first[1:]] = 1
                above[order] = np.cumsum(place, dtype=np.int32)
                here["above"] = above
                keys, sums = up[order][first], np.add.reduceat(sums[order], first) if len(first) else sums[:0]

    def log10(self, top: dict) -> np.ndarray:
        """Log-probability of each string's last byte given the rest; ``top`` has the settled nodes of cut contexts."""
        chance: list = [0.0] * 8
        weight: list = [1.0] * 8
        for d in range(self.depth + 1):
            here = self.levels[d]
            settled = {context: unpacked(held) for (depth, context), held in top.items() if depth == d and len(here["keys"])}
            for t in range(8):
                (cut, contexts, prefixes), stop, one, seen = (here[k][t] for k in ("cut", "stop", "one", "seen"))
                for context, (its_stop, its_one, its_seen) in settled.items():
                    this = contexts == np.uint64(context)
                    of, prefix = cut[this], prefixes[this]
                    stop[of], one[of], seen[of] = its_stop[prefix], its_one[prefix], its_seen[prefix]
                at = here["number"][t]
                if d:
                    chance[t], weight[t] = chance[t][here["above"]], weight[t][here["above"]]
                add, keep = np.where(seen, stop * one, 0.0), np.where(seen, 1 - stop, 1.0)
                chance[t] = chance[t] + weight[t] * add[at]
                weight[t] = weight[t] * keep[at]
        byte, total = self.levels[self.depth]["keys"] & np.uint64(255), 0.0
        for t in range(8):
            p = chance[t] + weight[t] / 2
            total = total + np.log10(np.where((byte >> np.uint64(7 - t)) & np.uint64(1) == 1, p, 1 - p))
        return total


def packed_nodes(stop: np.ndarray, one: np.ndarray, seen: np.ndarray) -> bytes:
    return squeeze(np.concatenate([stop, one, seen.astype(float)]))


def unpacked(held: bytes) -> tuple[np.ndarray, ...]:
    stop, one, seen = unsqueeze(held, np.float64).reshape(3, 256)
    return stop, one, seen > 0


def top_nodes(open_: dict, depth: int) -> dict:
    """The settled nodes of cut contexts, from their byte counts and the products of their uncut children: deepest first."""
    out, given = {}, {}
    for d in range(depth - 1, -1, -1):
        for (_, context), (counts, products) in sorted((k, v) for k, v in open_.items() if k[0] == d):
            zeros, ones = np.zeros(256, np.int64), np.zeros(256, np.int64)
            for t in range(8):
                for x in np.flatnonzero(counts).tolist():
                    (ones if x >> (7 - t) & 1 else zeros)[1 << t | x >> (8 - t)] += counts[x]
            own = log_kt(zeros, ones)
            whole = np.log(0.5) + np.logaddexp(own, products + given.pop((d, context), 0.0))
            out[d, context] = packed_nodes(np.exp(np.log(0.5) + own - whole), (ones + 0.5) / (zeros + ones + 1.0), zeros + ones > 0)
            if d:
                given[d - 1, context >> 8] = given.get((d - 1, context >> 8), 0.0) + whole
    return out


def _bodies(ends: bytes, data: bytes) -> list[bytes]:
    """Words of each document of a block, joined by single spaces."""
    raw, at = unsqueeze(data), [0, *unsqueeze(ends, np.int64).tolist()]
    return [raw[a:b] for a, b in zip(at, at[1:], strict=False)]


def normal_text(text: str) -> bytes:
    """A-Z in lower case, words joined by single spaces; words are what ``bytes.split`` makes of ASCII white space."""
    return b" ".join(lower_bytes(text).split())


def _block_grams(bodies: list[bytes], train: list[bool], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct strings of a block in order and how often training texts have each."""
    grams, n = Places([b for b, use in zip(bodies, train, strict=True) if use], depth).counted()
    if not all(train):
        new = Places([b for b, use in zip(bodies, train, strict=True) if not use], depth).known()
        both = [np.concatenate([grams, new]), np.concatenate([n, np.zeros(len(new), np.int64)])]
        del grams, n, new
        grams, n = sums_by(both.pop(0), both.pop())
    return grams, n


def _block_words(bodies: list[bytes], train: list[bool]) -> Counter:
    """Distinct words of a block and how often training texts have each."""
    counts: Counter = Counter()
    for body, use in zip(bodies, train, strict=True):
        if use:
            counts.update(body.split(b" ") if body else ())
    counts[b""] = sum(train)  # the end
    others: set[bytes] = set()
    for body, use in zip(bodies, train, strict=True):
        if not use and body:
            others.update(body.split(b" "))
    counts.update(dict.fromkeys(others.difference(counts), 0))
    return counts


def _list_block(x: dict, bounds: list[int], depth: int) -> Iterator[tuple]:
    bodies, train, shards = _bodies(x["ends"], x["data"]), [not held_out(i) for i in x["ids"]], len(bounds) + 1
    grams, n = _block_grams(bodies, train, depth)  # before there are words in memory
    counts = _block_words(bodies, train)
    del bodies
    words: list[list[bytes]] = [[] for _ in range(shards)]
    for w in counts:
        words[zlib.crc32(w) % shards].append(w)
    cuts = [0, *np.searchsorted(grams >> np.uint64(8), np.array(bounds, np.uint64)).tolist(), len(grams)]
    for s in range(shards):
        at, w = slice(cuts[s], cuts[s + 1]), sorted(words[s])
        if cuts[s + 1] > cuts[s] or w:
            yield s, x["block"], squeeze(planes(np.diff(grams[at], prepend=np.uint64(0)))), squeeze(planes(n[at])), squeeze(b"\n".join(w)), squeeze(np.array([counts[v] for v in w], np.int64))


def _grams(cell: bytes) -> np.ndarray:
    return np.cumsum(unplanes(cell, np.uint64), dtype=np.uint64)


def _words(cell: bytes, counts: bytes) -> tuple[list[bytes], np.ndarray]:
    n = unsqueeze(counts, np.int64)
    return unsqueeze(cell).split(b"\n") if len(n) else [], n


#: What a shard gets from each block, and holds as lists of these.
CELL = ("grams", "gram_counts", "words", "word_counts")


def _tree(cells: list[dict], shard: int, bounds: list[int], depth: int) -> tuple[Tree, list[np.ndarray]]:
    """The tree of a shard's lists added up, and each list's strings."""
    lists = [_grams(x["grams"]) for x in cells]
    grams, n = sums_by(np.concatenate(lists), np.concatenate([unplanes(x["gram_counts"], np.int64) for x in cells]))
    return Tree(grams, n, depth, bounds[max(0, shard - 1) : shard + 1]), lists


def _word_sums(cells: list[dict]) -> tuple[list[np.ndarray], np.ndarray]:
    """Which of a shard's distinct words each list has, by number, and each one's count in all lists."""
    lists = [_words(x["words"], x["word_counts"]) for x in cells]
    number = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(w for w, _ in lists)))}
    sums, numbers = np.zeros(len(number), np.int64), []
    for w, n in lists:
        at = np.fromiter(map(number.__getitem__, w), np.int64, len(w))
        sums[at] += n  # no word is twice in a list
        numbers.append(at)
    return numbers, sums


#: A row for each document of a block.
RESULT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("bits_per_byte", pa.float64())])


def _place_scores(places: Places, replies: list[dict]) -> np.ndarray:
    """The sum of each text's log-probabilities, from shards' answers in order of strings.

    Strings are made and sorted twice, once to know the distinct ones and once to look them up, so that
    only one piece's are held at a time, and no number for each place of the block.
    """
    grams = places.known()
    logs, at = np.empty(len(grams)), 0
    for r in replies:
        some = unplanes(r["logs"], np.float64)
        logs[at : at + len(some)] = some
        at += len(some)
    starts, score, at = np.r_[0, places.ends[:-1]], np.zeros(len(places.ends)), 0
    for piece in places.pieces():
        order = np.argsort(piece)
        piece = piece[order]
        first = firsts(piece)
        found = logs[np.searchsorted(grams, piece[first])]
        each = piece.view(np.float64)  # its strings are not needed any more
        each[order] = np.repeat(found, np.diff(first, append=len(order)))
        of = slice(*np.searchsorted(places.ends, [at, at + len(each) - 1], "right") + [0, 1])
        score[of] += np.add.reduceat(each, np.maximum(starts[of] - at, 0))
        at += len(each)
        del order, piece, first, found, each
    return score


def _score_block(x: dict, replies: list[dict], shards: int, depth: int, tokens: int, types: int) -> Iterator[tuple]:
    """The rows of a block's documents, from each shard's answer to its list."""
    replies = sorted(replies, key=lambda r: r["shard"])
    places = Places(_bodies(x["ends"], x["data"]), depth)
    sizes, score = np.diff(places.ends, prepend=0).tolist(), _place_scores(places, replies).tolist()
    del places
    bodies, words = _bodies(x["ends"], x["data"]), {b""}
    for body in bodies:
        words.update(body.split(b" "))
    names: list[list[bytes]] = [[] for _ in range(shards)]
    for w in words:
        names[zlib.crc32(w) % shards].append(w)
    del words
    log_of: dict[bytes, float] = {}
    unseen, replied = float(np.log10(1 / (tokens + types + 1))), {r["shard"]: r["counts"] for r in replies}
    for s, ws in enumerate(names):
        if ws:
            n = unsqueeze(replied[s], np.int64)
            log_of.update(zip(sorted(ws), np.where(n > 0, np.log10((n + 1) / (tokens + types + 1)), unseen).tolist(), strict=True))
    for i, body, size, total in zip(x["ids"], bodies, sizes, score, strict=True):
        base = list(map(log_of.__getitem__, [*(body.split(b" ") if body else ()), b""]))
        yield i, held_out(i), len(base), len(base) - base.count(unseen), tokens, sum(base), total, -total * np.log2(10) / size


def shard_bounds(packed: DataFrame, depth: int) -> list[int]:
    """Contexts at which shards end: quantiles of a sparse sample of all blocks' contexts, one fewer than blocks."""
    n_blocks = packed.count()

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                places = Places(_bodies(x["ends"], x["data"]), depth)
                some = places.sparse(SPARSE) >> np.uint64(8)
                yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64))], ["context"])

    if n_blocks < 2:
        return []
    marks = [(i + 1) / n_blocks for i in range(n_blocks - 1)]
    found = packed.mapInArrow(sampled, "context bigint").agg(F.percentile_approx("context", marks, max(10_000, 20 * n_blocks)).alias("at")).first()["at"]
    return sorted({int(v) for v in found or [] if v > 0})


def lm_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """One row per input row: the id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``bits_per_byte``.

    Tokens are the words of the text with A-Z lower-cased, then one end.
    ``score`` is the log10-probability of the words as bytes, joined by single
    spaces, and the end, from up to ``depth`` (1 to 7) bytes of context;
    ``bits_per_byte`` its code length over those bytes.
    Null texts are empty: one token, the end.  A null id counts as an empty
    text for the split.  Repeated rows each count and are each scored.
    Without training texts every decision has probability one half and every
    token 1 / (0 + 0 + 1).  A text of any length is read in pieces.  An empty
    table gives an empty result.  Other columns are ignored.
    """
    if not 1 <= depth <= DEEPEST:
        raise ValueError(f"depth must be 1 to {DEEPEST}")
    packed = blocks(docs, BLOCK_BYTES, normal_text, id_col, text_col)
    bounds = shard_bounds(packed, depth)
    shards = len(bounds) + 1

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), ("block", pa.int64()), *[(c, pa.binary()) for c in CELL]])
        for batch in batches:
            for x in batch.to_pylist():
                yield table(schema, _list_block(x, bounds, depth))
                give_back()

    def gathered(cells: pa.Table) -> pa.Table:
        rows = cells.to_pylist()
        shard = rows[0]["shard"]
        words = _word_sums(rows)[1]
        opened = [{"d": d, "context": context, "counts": squeeze(n), "products": squeeze(p)} for (d, context), (n, p) in sorted(_tree(rows, shard, bounds, depth)[0].open.items())]
        row = {"shard": shard, **{c: [r[c] for r in rows] for c in ("block", *CELL)}, "opened": opened, "tokens": int(words.sum()), "types": int(np.count_nonzero(words))}
        give_back()
        return pa.Table.from_pylist([row], held)

    opened = pa.struct([("d", pa.int32()), ("context", pa.int64()), ("counts", pa.binary()), ("products", pa.binary())])
    held = pa.schema([("shard", pa.int32()), ("block", pa.list_(pa.int64())), *[(c, pa.list_(pa.binary())) for c in CELL], ("opened", pa.list_(opened)), ("tokens", pa.int64()), ("types", pa.int64())])
    kept = f"shard int, block array<bigint>, {', '.join(f'{c} array<binary>' for c in CELL)}, opened array<struct<d: int, context: bigint, counts: binary, products: binary>>, tokens bigint, types bigint"
    cells = packed.mapInArrow(listed, f"shard int, block bigint, {', '.join(f'{c} binary' for c in CELL)}")
    # a row for each shard with all its lists, so that answering needs no second exchange
    model = saved(cells.groupBy("shard").applyInArrow(gathered, kept), "lm-shards")

    def added(parts: pa.Table) -> pa.Table:
        rows = sorted(parts.to_pylist(), key=lambda r: r["shard"])  # the same sum in whatever order they came
        counts, products = (sum(unsqueeze(r[c], kind) for r in rows) for c, kind in (("counts", np.int64), ("products", np.float64)))
        return pa.table({"d": pa.array([rows[0]["d"]], pa.int32()), "context": pa.array([rows[0]["context"]], pa.int64()), "counts": pa.array([squeeze(counts)], pa.binary()), "products": pa.array([squeeze(products)], pa.binary())})

    parts = model.select("shard", F.inline("opened")).groupBy("d", "context").applyInArrow(added, "d int, context bigint, counts binary, products binary")
    open_ = {(r["d"], r["context"]): (unsqueeze(bytes(r["counts"]), np.int64), unsqueeze(bytes(r["products"]), np.float64)) for r in parts.collect()}
    top = docs.sparkSession.sparkContext.broadcast(top_nodes(open_, depth))
    sums = model.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("types"), F.lit(0)).alias("types")).first()
    tokens, types = sums["tokens"], sums["types"]

    def answered(m: dict) -> pa.RecordBatch:
        schema = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("logs", pa.binary()), ("counts", pa.binary())])
        cells = [dict(zip(CELL, v, strict=True)) for v in zip(*[m[c] for c in CELL], strict=True)]
        tree, lists = _tree(cells, m["shard"], bounds, depth)
        cut = {(d, context): top.value[d, context] for d in range(depth) for context in split_contexts(bounds[max(0, m["shard"] - 1) : m["shard"] + 1], d, depth).tolist() if (d, context) in top.value}
        logs, grams = tree.log10(cut), tree.levels[depth]["keys"]
        del tree
        numbers, words = _word_sums(cells)
        logs = ((logs.view(np.uint64) + np.uint64(1 << 15)) & ~np.uint64((1 << 16) - 1)).view(np.float64) if len(grams) else np.zeros(0)
        return table(schema, ((b, m["shard"], squeeze(planes(logs[np.searchsorted(grams, g)])), squeeze(words[at])) for b, at, g in zip(m["block"], numbers, lists, strict=True)))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield answered(batch.slice(i, 1).to_pylist()[0])
                give_back()

    answers = model.drop("opened", "tokens", "types").mapInArrow(answer, "block bigint, shard int, logs binary, counts binary")
    def scored(block: pa.Table, replies: pa.Table) -> pa.Table:
        (x,) = block.to_pylist()
        rows = table(RESULT, _score_block(x, replies.to_pylist(), shards, depth, tokens, types))
        give_back()
        return pa.Table.from_batches([rows], RESULT)

    done = packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(scored, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double")
    return done.withColumnRenamed("doc_id", id_col)
