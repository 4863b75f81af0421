"""Suffix-array dedup: maximal repeats from common-prefix interval trees.

A repeat is a string of ``LEAST`` bytes or more.  To find all of them without
bringing all suffixes together, every window of ``LEAST`` bytes is filed under
its minimizer, the ``ANCHOR``-byte string in it with the smallest hash (the
leftmost of equals).  Equal windows have equal minimizers at equal places, so
whatever repeats meets in one bucket.  Neighbouring windows with the same
minimizer travel as one passage of ``LEAST`` to ``LEAST + SPAN - 1`` bytes.

0. Each block of documents sends the hashes of its distinct minimizers to the
   buckets, a few bytes each, and gets back a bit for each: whether another
   document has it.  What no other document has can't be part of a repeat,
   and its passages go no further.
1. Each block sends its distinct passages to the buckets, each with the
   smallest id that has it here and its places in that document.  Later
   documents of the block are settled at once: all of their passage is
   repeated.  So a passage that a third of all documents share costs one
   entry for each block.
2. A bucket sorts its passages and drops minimizers that only one document
   has.  Equal passages are one maximal repeat group.  For passages that
   share a window without being equal, the bucket builds the enhanced suffix
   array of their window starts (suffixes in order, common prefix with the one
   before, byte to the left) and scans it with a stack.  Each interval of
   common prefix ``LEAST`` or more whose members differ in the byte to the
   left is a maximal repeat group with all its occurrences; intervals that all
   extend to the left are skipped, their extension being a group that covers
   them.  A passage's first window counts as differing, as what is left of it
   is filed elsewhere.
3. In each group, occurrences in documents above the smallest id are repeated.
   Spans go back to their blocks, which merge them and cut.

Ids are compared, not rows: rows with one id never settle each other, and a
null id is larger than all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.common import NO_ID, blocks, mix64, planes, squeeze, table, unplanes, unsqueeze

LEAST, ANCHOR = 50, 24
#: Minimizer places in a window, which is also the most windows a passage has.
SPAN = LEAST - ANCHOR + 1
LONGEST = LEAST + SPAN - 1
BLOCK_BYTES = 4 << 20
#: Longer documents are read in pieces that overlap by LEAST - 1 bytes.
PIECE = 8 << 20
#: Passages whose suffixes are sorted at a time, if they have nothing in common.
AT_ONCE = 4096
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEPS = mix64(np.arange(1, 9, dtype=np.uint64)) | np.uint64(1)
CELLS = "bucket int, block bigint, bytes binary, lengths binary, anchors binary, ids binary, counts binary, docs binary, places binary"
SPANS = "block bigint, docs binary, starts binary, lengths binary"


def anchor_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ANCHOR bytes from each place, put together from those of 8 and 16."""
    h = _BYTE[data]
    for step in range(3):
        h = h[: -(1 << step)] * _STEPS[step] + h[1 << step :]
    return mix64((h[:-8] * _STEPS[3] + h[8:])[:-8] * _STEPS[4] + h[16:])


def passages(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, start, length, place and hash of the anchor) of every passage; documents lie at starts to ends, none over PIECE."""
    if len(data) < LEAST:
        return (*(np.zeros(0, np.int64) for _ in range(4)), np.zeros(0, np.uint64))
    hashes = anchor_hashes(data)
    # place in the low bits: the leftmost of equal hashes is the smallest
    low = (hashes & ~np.uint64((1 << 24) - 1)) | np.arange(len(hashes), dtype=np.uint64)
    n = 1
    while n < SPAN:
        step = min(n, SPAN - n)
        low = np.minimum(low[:-step], low[step:])
        n += step
    whole = np.zeros(len(low) + 1, np.int8)  # +1 where a document's windows begin, -1 behind them
    has = ends - starts >= LEAST
    np.add.at(whole, starts[has], 1)
    np.add.at(whole, ends[has] - LEAST + 1, -1)
    window = np.flatnonzero(np.cumsum(whole[:-1], dtype=np.int8))
    own = low[window]
    cut = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (window[1:] != window[:-1] + 1)]) if len(own) else np.zeros(0, np.int64)
    # a document that ends where the next begins leaves LEAST - 1 places between their windows
    last = np.r_[cut[1:], len(own)] - 1 if len(own) else cut
    start, anchor = window[cut], (own[cut] & np.uint64((1 << 24) - 1)).astype(np.int64)
    return np.searchsorted(ends, start, "right"), start, window[last] + LEAST - start, anchor, hashes[anchor]


def rows_of(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """Bytes from each start in rows of this width, 0 beyond the length."""
    at = starts[:, None] + np.arange(width)
    out = data[np.minimum(at, len(data) - 1)]
    out[np.arange(width) >= lengths[:, None]] = 0
    return out


def words_of(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of big-endian 64-bit words, which sort alike."""
    wide = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((len(rows), wide), np.uint8)
    padded[:, : rows.shape[1]] = rows
    return padded.view(">u8").astype(np.uint64)


def in_order(*columns: np.ndarray) -> np.ndarray:
    """Order by these columns, the first first."""
    return np.lexsort(columns[::-1])


def _passages_of(x: dict) -> tuple[np.ndarray, ...]:
    """A block's data, starts of its documents, their ids, and its passages."""
    data, ends = np.frombuffer(unsqueeze(x["data"]), np.uint8), unsqueeze(x["ends"], np.int64)
    ids = np.array([NO_ID if i is None else i for i in x["ids"]], np.int64)
    starts, found = np.r_[0, ends[:-1]], []
    if len(data) <= PIECE:
        found.append(passages(data, starts, ends))
    else:
        for d, (a, end) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
            for at in range(a, max(a + 1, end - LEAST + 1), PIECE - LEAST + 1):
                piece = data[at : min(at + PIECE, end)]
                doc, start, length, anchor, mark = passages(piece, np.array([0]), np.array([len(piece)]))
                found.append((doc + d, start + at, length, anchor + at, mark))
    return data, starts, ids, *(np.concatenate([f[i] for f in found]) for i in range(5))


def _by_bucket(marks: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of hashes by bucket, then value, and where buckets begin."""
    bucket = marks % np.uint64(buckets)
    order = np.lexsort((marks, bucket))
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _anchors(ids: np.ndarray, doc: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A block's distinct minimizers by hash, and whether two ids have one."""
    order = np.argsort(mark, kind="stable")
    mark, of = mark[order], ids[doc[order]]
    first = np.flatnonzero(np.r_[True, mark[1:] != mark[:-1]]) if len(mark) else np.zeros(0, np.int64)
    return mark[first], (np.minimum.reduceat(of, first) < np.maximum.reduceat(of, first)) if len(first) else np.zeros(0, bool)


def _announce(x: dict, buckets: int) -> Iterator[tuple]:
    _, _, ids, doc, _, _, _, mark = _passages_of(x)
    marks, several = _anchors(ids, doc, mark)
    order, cuts = _by_bucket(marks, buckets)
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        at = order[cuts[b] : cuts[b + 1]]
        # 44 of the hash's bits: equal ones are told apart later
        yield b, x["block"], squeeze(planes(np.diff(marks[at] >> np.uint64(20), prepend=np.uint64(0)))), squeeze(np.packbits(several[at]))


def _recognise(cells: pa.Table) -> pa.Table:
    """For each block, a bit for each of its minimizers in a bucket: whether another document may have it."""
    xs = cells.to_pylist()
    marks = [np.cumsum(unplanes(x["marks"], np.uint64), dtype=np.uint64) for x in xs]
    every = np.concatenate(marks)
    order = np.argsort(every, kind="stable")
    same = every[order][1:] == every[order][:-1]
    again = np.empty(len(every), bool)
    again[order] = np.r_[False, same] | np.r_[same, False]
    ends = np.cumsum([len(m) for m in marks])
    bits = [squeeze(np.packbits(again[e - len(m) : e] | np.unpackbits(unsqueeze(x["several"], np.uint8), count=len(m)).astype(bool))) for m, e, x in zip(marks, ends.tolist(), xs, strict=True)]
    return pa.table({"bucket": pa.array([x["bucket"] for x in xs], pa.int32()), "block": pa.array([x["block"] for x in xs], pa.int64()), "bits": pa.array(bits, pa.binary())})


def _send(x: dict, bits: dict[int, bytes], buckets: int) -> Iterator[tuple]:
    """The cells of a block, and its settled spans as a cell without passages."""
    data, starts, ids, doc, start, length, anchor, mark = _passages_of(x)
    marks, _ = _anchors(ids, doc, mark)
    order, cuts = _by_bucket(marks, buckets)
    again = np.zeros(len(marks), bool)
    for b, held in bits.items():
        at = order[cuts[b] : cuts[b + 1]]
        again[at] = np.unpackbits(unsqueeze(held, np.uint8), count=len(at)).astype(bool)
    kept = again[np.searchsorted(marks, mark)]
    doc, start, length, anchor, mark = (v[kept] for v in (doc, start, length, anchor, mark))
    if not len(doc):
        return
    # equal passages of the block: by a hash of all their bytes, then by the bytes
    content, hashes = mix64(length.astype(np.uint64) << np.uint64(8) | (anchor - start).astype(np.uint64)), anchor_hashes(data)
    for i in range(-(-LONGEST // ANCHOR)):
        content = mix64(content * _STEPS[7] + hashes[start + np.minimum(ANCHOR * i, length - ANCHOR)])
    order = in_order(content, ids[doc], start)
    doc, start, length, anchor, mark, content = (v[order] for v in (doc, start, length, anchor, mark, content))
    same = np.r_[False, content[1:] == content[:-1]]
    at = np.flatnonzero(same)
    if len(at):
        same[at] = (length[at] == length[at - 1]) & (rows_of(data, start[at], length[at], LONGEST) == rows_of(data, start[at - 1], length[at - 1], LONGEST)).all(1)
    group = np.cumsum(~same) - 1
    first = np.flatnonzero(~same)
    least = ids[doc[first]]
    later = ids[doc] > least[group]
    if later.any():
        yield x["block"] % buckets, x["block"], None, squeeze(length[later]), None, None, None, squeeze(doc[later]), squeeze(start[later] - starts[doc[later]])
    own = np.flatnonzero(~later)
    bucket_of = (mark[first] % np.uint64(buckets)).astype(np.int64)
    order = in_order(bucket_of, start[first])
    cuts = np.searchsorted(bucket_of[order], np.arange(buckets + 1))
    count = np.bincount(group[own], minlength=len(first))
    before = np.r_[0, np.cumsum(count)]
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        g = order[cuts[b] : cuts[b + 1]]
        f, size = first[g], length[first[g]]
        body = data[_ranges(start[f], size)]
        mine = own[_ranges(before[g], count[g])]
        numbers = (planes(np.diff(v.astype(np.int64), prepend=0)) for v in (least[g], count[g], doc[mine], start[mine] - starts[doc[mine]]))
        yield b, x["block"], *map(squeeze, (body, size.astype(np.uint8), (anchor[f] - start[f]).astype(np.uint8), *numbers))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each start, as many as its size."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def repeat_groups(words: np.ndarray, lengths: np.ndarray, keys: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(common length, passages, window starts) of each maximal repeat of distinct passages.

    ``words`` are the passages' bytes and ``keys`` number, in order, what
    passages must have alike to share a window, so suffix arrays are built for
    a few thousand passages at a time.  Windows start from ``first`` to ``last``
    of each passage (all of them, if not given).
    """
    first = np.zeros(len(words), np.int64) if first is None else first
    last = lengths - LEAST if last is None else last
    flat = words.astype(">u8").view(np.uint8).reshape(len(words), -1)
    padded = np.concatenate([flat, np.zeros((len(flat), LONGEST + 8), np.uint8)], 1)
    shifted = np.lib.stride_tricks.as_strided(padded, (len(padded), LONGEST + 8, LONGEST), (padded.strides[0], 1, 1))
    begin = 0
    for end in [*np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]:
        if end - begin < AT_ONCE and end < len(keys):
            continue
        many = np.maximum(last[begin:end] - first[begin:end] + 1, 0)
        who = np.repeat(np.arange(begin, end), many)
        at = np.repeat(first[begin:end], many) + np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many)
        begin = end
        if len(who) < 2:
            continue
        left = lengths[who] - at
        suffix = shifted[who, at]
        suffix[np.arange(LONGEST) >= left[:, None]] = 0
        order = in_order(*words_of(suffix).T, left, who)
        who, at, left, suffix = who[order], at[order], left[order], suffix[order]
        differ = suffix[1:] != suffix[:-1]
        common = np.minimum(np.where(differ.any(1), differ.argmax(1), LONGEST), np.minimum(left[1:], left[:-1]))
        # the byte to the left; a first window differs from all others
        before = np.where(at > 0, padded[who, np.maximum(at - 1, 0)].astype(np.int64), -1 - np.arange(len(at)))
        turns = np.flatnonzero(np.diff(np.r_[False, common >= LEAST, False].astype(np.int8)))
        for low, high in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True):
            for depth, i, j in _intervals(common[low:high].tolist(), before[low : high + 1].tolist()):
                yield depth, who[low + i : low + j], at[low + i : low + j]


def _intervals(common: list[int], before: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common length, first, end) of the intervals of suffixes that differ in the byte to the left.

    ``common[i]`` is the common prefix of suffixes i and i + 1, at least LEAST.
    """
    open_: list[list] = []  # common length, first suffix, byte to the left of all so far or None once they differ
    for i, byte in enumerate(before):
        depth, first = common[i] if i < len(common) else 0, i
        while open_ and open_[-1][0] > depth:
            size, first, held = open_.pop()
            byte = byte if held == byte else None
            if byte is None:
                yield size, first, i + 1
        if depth and open_ and open_[-1][0] == depth:
            if open_[-1][2] != byte:
                open_[-1][2] = None
        elif depth:
            open_.append([depth, first, byte])


def _receive(cells: pa.Table) -> pa.Table:
    """Spans of one bucket for each block."""
    every = cells.to_pylist()
    xs = [x for x in every if x["bytes"] is not None]
    # what blocks have settled passes through
    rows = [(x["block"], x["docs"], x["places"], x["lengths"]) for x in every if x["bytes"] is None]
    if xs:
        rows += _repeats(xs)
    cols = list(zip(*rows, strict=True)) or [()] * 4
    return pa.table({"block": pa.array(cols[0], pa.int64()), "docs": pa.array(cols[1], pa.binary()), "starts": pa.array(cols[2], pa.binary()), "lengths": pa.array(cols[3], pa.binary())})


def _repeats(xs: list[dict]) -> list[tuple]:
    """(block, documents, starts, lengths) of what one bucket's passages show to be repeated."""
    size = [unsqueeze(x["lengths"], np.uint8) for x in xs]
    block = np.repeat(np.arange(len(xs)), [len(s) for s in size])
    length = np.concatenate(size).astype(np.int64)
    data = np.concatenate([unsqueeze(x["bytes"], np.uint8) for x in xs])
    anchor = np.concatenate([unsqueeze(x["anchors"], np.uint8) for x in xs]).astype(np.int64)
    ids, count, docs, places = (np.concatenate([np.cumsum(unplanes(x[c], np.int64)) for x in xs]) for c in ("ids", "counts", "docs", "places"))
    begin, own = np.cumsum(length) - length, np.cumsum(count) - count
    key = words_of(rows_of(data, begin + anchor, np.full(len(begin), ANCHOR), ANCHOR))
    order = in_order(*key.T)
    new = np.r_[True, (key[order][1:] != key[order][:-1]).any(1)]
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    low, high = np.minimum.reduceat(ids[order], first), np.maximum.reduceat(ids[order], first)
    kept = order[(low < high)[group]]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # passage, start in it, length

    if len(kept):
        words = words_of(rows_of(data, begin[kept], length[kept], LONGEST))
        order = in_order(*key[kept].T, *words.T, length[kept], anchor[kept], ids[kept])
        kept, words = kept[order], words[order]
        new = np.r_[True, (words[1:] != words[:-1]).any(1) | (length[kept][1:] != length[kept][:-1]) | (anchor[kept][1:] != anchor[kept][:-1]) | (key[kept][1:] != key[kept][:-1]).any(1)]
        first, same = np.flatnonzero(new), np.cumsum(new) - 1
        # equal passages: a group of their own
        later = kept[ids[kept] > ids[kept[first]][same]]
        out.append((later, np.zeros(len(later), np.int64), length[later]))
        # of each distinct passage, those with the smallest id are open to the others
        open_ = ids[kept] == ids[kept[first]][same]
        distinct, its = kept[first], words[first]
        who, at, reach = [], [], []
        for chosen, number, low, high in _sharing(data, begin, length, anchor, distinct):
            where = distinct[chosen]
            for depth, members, starts in repeat_groups(its[chosen], length[where], number, low, high):
                over = ids[where[members]] > ids[where[members]].min()
                who.append(chosen[members[over]])
                at.append(starts[over])
                reach.append(np.full(over.sum(), depth, np.int64))
        if who:
            members, starts, depths = (np.concatenate(v) for v in (who, at, reach))
            # every open copy of the passage
            copies = kept[open_]
            of = same[open_]
            run = np.searchsorted(of, members), np.searchsorted(of, members, "right")
            n = run[1] - run[0]
            index = np.repeat(run[0], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out.append((copies[index], np.repeat(starts, n), np.repeat(depths, n)))
    which, start, reach = (np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(3))
    n = count[which]
    index = np.repeat(own[which], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    to, doc, place, span = np.repeat(block[which], n), docs[index], places[index] + np.repeat(start, n), np.repeat(reach, n)
    order = in_order(to, doc, place)
    to, doc, place, span = (v[order] for v in (to, doc, place, span))
    cuts = np.searchsorted(to, np.arange(len(xs) + 1))
    return [(xs[b]["block"], *map(squeeze, (doc[i:j].astype(np.int64), place[i:j], span[i:j]))) for b, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if j > i]


def _sharing(data: np.ndarray, begin: np.ndarray, length: np.ndarray, anchor: np.ndarray, distinct: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Distinct passages that may share a window with another one, twice: (their numbers, number of what they share, first and last window start).

    A window that begins at most ``left`` bytes before the anchor reaches
    ``LEAST - left`` bytes from the anchor's start, and an earlier one that
    many bytes to the left: one of these two strings is the same in all that
    share the window.  So passages of one frequent anchor are told apart by
    what surrounds it, and only those with equal surroundings are compared.
    """
    left = (SPAN - 1) // 2
    at, room = begin[distinct] + anchor[distinct], length[distinct] - anchor[distinct]
    whole, middle = length[distinct] - LEAST, anchor[distinct] - left
    sides = ((at, LEAST - left, room >= LEAST - left, np.maximum(middle, 0), whole), (at - left, left + ANCHOR, middle >= 0, np.zeros_like(whole), np.minimum(middle, whole)))
    for start, size, has, low, high in sides:
        some = np.flatnonzero(has)
        if len(some) < 2:
            continue
        words = words_of(rows_of(data, start[some], np.full(len(some), size), size))
        order = in_order(*words.T)
        number = np.cumsum(np.r_[False, (words[order][1:] != words[order][:-1]).any(1)])
        shared = np.bincount(number)[number] > 1
        some, number = some[order][shared], number[shared]
        if len(some):
            yield some, number, low[some], high[some]


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``n_bytes``, ``spans`` (removed runs as start and end) and ``kept`` (the bytes left).

    A byte is removed if a string of 50 bytes that covers it also starts in a
    document with a smaller id; strings are those of the whole input and
    never cross documents.  Texts are UTF-8 bytes, null ones empty, and what
    is left need not be valid UTF-8.  A null id is larger than all others;
    rows that share an id never affect each other.  An empty table gives an
    empty result.  Other columns are ignored.
    """
    packed = blocks(docs, BLOCK_BYTES, None, id_col, text_col)
    buckets = max(32, packed.count() // 2)

    def announce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("marks", pa.binary()), ("several", pa.binary())])
        for batch in batches:
            for x in batch.to_pylist():
                if rows := list(_announce(x, buckets)):
                    yield table(schema, rows)

    def send(block: pa.Table, known: pa.Table) -> pa.Table:
        (x,) = block.to_pylist()
        rows = list(_send(x, dict(zip(known.column("bucket").to_pylist(), known.column("bits").to_pylist(), strict=True)), buckets))
        schema = pa.schema([(n, {"bucket": pa.int32(), "block": pa.int64()}.get(n, pa.binary())) for n in (c.split()[0] for c in CELLS.split(", "))])
        return pa.Table.from_batches([table(schema, rows)] if rows else [], schema)

    told = packed.mapInArrow(announce, "bucket int, block bigint, marks binary, several binary").groupBy("bucket").applyInArrow(_recognise, "bucket int, block bigint, bits binary")
    cells = packed.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(send, CELLS)
    spans = cells.groupBy("bucket").applyInArrow(_receive, SPANS)

    def cut(block: pa.Table, found: pa.Table) -> pa.Table:
        (x,) = block.to_pylist()
        data, ends = unsqueeze(x["data"]), unsqueeze(x["ends"], np.int64)
        starts = np.r_[0, ends[:-1]]
        # +1 where a span begins and -1 behind it: covered where the running sum is positive
        edge = np.zeros(len(data) + 1, np.int32)
        for f in found.to_pylist():
            a = starts[unsqueeze(f["docs"], np.int64)] + unsqueeze(f["starts"], np.int64)
            np.add.at(edge, a, 1)
            np.add.at(edge, a + unsqueeze(f["lengths"], np.int64), -1)
        covered = np.cumsum(edge[:-1]) > 0
        raw, rows = np.frombuffer(data, np.uint8), []
        for i, a, b in zip(x["ids"], starts.tolist(), ends.tolist(), strict=True):
            mask = covered[a:b]
            turns = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
            spans = [{"start": s, "end": e} for s, e in turns.reshape(-1, 2).tolist()]
            rows.append((i, b - a, spans, raw[a:b][~mask].tobytes() if spans else data[a:b]))
        cols = list(zip(*rows, strict=True))
        return pa.table({"doc_id": pa.array(cols[0], pa.int64()), "n_bytes": pa.array(cols[1], pa.int64()), "spans": pa.array(cols[2], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), "kept": pa.array(cols[3], pa.binary())})

    done = packed.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(cut, "doc_id bigint, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary")
    return done.withColumnRenamed("doc_id", id_col)
