"""MinHash near-dedup with a multi-index Hamming join.

Each distinct shingle set gets a signature of ``CHUNKS * WIDTH`` MinHash values
of ``16`` bits.  Two sets of similarity s differ in each value with probability
1 - s.  All pairs within ``LIMIT = 2 * CHUNKS - 1`` differing values are found
for certain: split over ``CHUNKS`` chunks, some chunk has at most one of them, so
each set is indexed by every chunk with each one of its values left out.  At
s = 0.80 a pair exceeds the limit of 21 in 44 with probability below 1e-5.

Sets that share an index key form groups.  Their members' full sets are read,
and links are confirmed on those alone:

* Equal sets are one node from the start, however many rows have them.
* A shingle that only one of the grouped sets has can be in no intersection.
  A set with too many of them links to nothing, and a pair must leave enough
  shared ones on both sides; this is exact, and settles most of a crowd of
  variants that resemble each other without being near enough.
* First every member of a group is held against the group's most central
  member, found by a plain aggregate.  Then all pairs within the limit whose
  ends are not yet connected are held against each other, each pair in the
  first group it has, and only links that connect something come out.

A group is rows of one table, never a list in one cell, and a large one is dealt
out by pairs of its parts, so no task holds more than two parts.

Connected components come from repeated minimum labels with pointer jumping,
each round a saved table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import columns, mix64, runs, saved, sieve, sieved, squeeze, texts_of, unsqueeze, unused
from quarry.llm.shingles import shingle_sets

CHUNKS, WIDTH = 11, 4
VALUES, LIMIT = CHUNKS * WIDTH, 2 * CHUNKS - 1
#: Links have 100 * intersection >= percent * union, with this percent unless told otherwise.
PERCENT = 80
#: Characters of text that are hashed at a time.
AT_ONCE = 1 << 18
TILE = 1024
#: Members of a group that one task holds, twice.
PART = 1024
_SEEDS = mix64(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_SHIFTS = mix64(_SEEDS)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 16-bit MinHash values for each set; sets must not be empty."""
    ends = np.cumsum([len(s) for s in sets])
    every, starts = np.concatenate(sets), np.r_[0, ends[:-1]]
    out = np.empty((len(sets), VALUES), np.uint16)
    for k in range(VALUES):
        out[:, k] = (mix64(np.minimum.reduceat(every * _SEEDS[k] + _SHIFTS[k], starts)) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def index_keys(values: np.ndarray) -> np.ndarray:
    """For each signature, its keys: of every chunk with each one value left out."""
    wide = values.astype(np.uint64).reshape(len(values), CHUNKS, WIDTH)
    keys = np.empty((len(values), CHUNKS, WIDTH), np.uint64)
    for out in range(WIDTH):
        key = np.zeros((len(values), CHUNKS), np.uint64)
        for w in range(WIDTH):
            if w != out:
                key = key << np.uint64(16) | wide[:, :, w]
        keys[:, :, out] = mix64(mix64(key) + (np.arange(CHUNKS, dtype=np.uint64) * np.uint64(WIDTH) + np.uint64(out + 1)) * np.uint64(0x9E3779B97F4A7C15))
    return keys.reshape(len(values), CHUNKS * WIDTH)


def near_enough(common: int, a: int, b: int, percent: int = PERCENT) -> bool:
    return 100 * common >= percent * (a + b - common)


def _marked(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n, print, signature) of (doc_id, text_hash, text)."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch), strict=True)), lambda r: len(r[2]), AT_ONCE):
                sets = shingle_sets([t for _, _, t in part])
                full = [i for i, s in enumerate(sets) if len(s)]
                signed = dict(zip(full, signatures([sets[i] for i in full]), strict=True)) if full else {}
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for i, _, _ in part], pa.int64()),
                        pa.array([h for _, h, _ in part], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array([signed[i].tobytes() if i in signed else None for i in range(len(sets))], pa.binary()),
                    ],
                    ["doc_id", "text_hash", "n", "print", "signature"],
                )

    return docs.mapInArrow(mark, "doc_id bigint, text_hash bigint, n bigint, print binary, signature binary")


def _members(nodes: DataFrame) -> DataFrame:
    """(grp, keys, parts, part, node): nodes that share an index key, two or more; each distinct group once, with the numbers of its keys.

    A group's members are rows, never a list.  Groups are told apart by their
    size and two sums (exclusive or) of 64-bit hashes of their members, which
    Spark adds up before the exchange, so a key that a third of all nodes have
    costs no task more than others.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = np.asarray(batch.column(0), np.int64)
            keys = index_keys(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(len(node), VALUES)).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.tile(np.arange(VALUES, dtype=np.int32), len(node))), pa.array(np.repeat(node, VALUES))], ["key", "which", "node"])

    keyed = saved(nodes.select("node", "signature").mapInArrow(spread, "key bigint, which int, node bigint"), "near-keys", True)
    # most keys occur once: what goes on is told from their counts alone
    often = saved(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "near-often", True)
    some = sieved(keyed, F.col("key"), sieve(often, "key"), "maybe").where("maybe").drop("maybe")
    sums = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("a"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("b"), F.first("which").alias("which")]
    groups = some.groupBy("key").agg(*sums).where("n > 1").groupBy("n", "a", "b").agg(F.min("key").alias("grp"), F.collect_set("which").alias("keys"))
    groups = saved(groups.select("grp", "keys", F.ceil(F.col("n") / PART).cast("int").alias("parts")), "near-groups", True)
    members = some.join(groups, some["key"] == groups["grp"])
    return saved(members.select("grp", "keys", "parts", F.pmod(F.xxhash64("node"), F.col("parts").cast("long")).cast("int").alias("part"), "node"), "near-members", True)


def _values(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, VALUES)


def _may_link(n: np.ndarray, alone: np.ndarray, m: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of sizes n and m can share enough, given how many shingles of each no other set has: the intersection of a link is at least percent / (100 + percent) of both sizes."""
    return (100 + percent) * np.minimum(n - alone, m - other) >= percent * (n + m)


def _to_centre(members: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of each group's most central member with the others, if they may link."""
    opened = members.select("grp", "node").join(known, "node")
    centre = opened.groupBy("grp").agg(F.min(F.struct("alone", "node", "n", "signature")).alias("p"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, n, alone, b, m, other = (np.asarray(batch.column(i), np.int64) for i in (0, 1, 2, 4, 5, 6))
            good = (a != b) & _may_link(n, alone, m, other, percent) & ((_values(batch.column(3)) != _values(batch.column(7))).sum(1) <= LIMIT)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[good]), pa.array(np.maximum(a, b)[good])], ["a", "b"])

    both = opened.join(centre, "grp").select("node", "n", "alone", "signature", "p.node", "p.n", "p.alone", "p.signature")
    return both.toDF(*"abcdefgh").mapInArrow(compare, "a bigint, b bigint").distinct()


def _pairs_of(rows: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """A row and the later rows that it may link to and isn't connected with, each pair in the first of its keys' groups only."""
    n, alone, label, part = (np.asarray(rows.column(c), np.int64) for c in ("n", "alone", "label", "part"))
    values, keys = _values(rows.column("signature")), np.array(rows.column("keys")[0].as_py())
    apart = rows.column("first")[0].as_py() != rows.column("second")[0].as_py()
    for i in range(len(n)):
        for s in range(i + 1, len(n), TILE):
            to = slice(s, s + TILE)
            at = np.flatnonzero(_may_link(n[i], alone[i], n[to], alone[to], percent) & (label[to] != label[i]) & ((part[to] != part[i]) | (not apart))) + s
            if not len(at):
                continue
            differ = values[at] != values[i]
            close = differ.sum(1) <= LIMIT
            at, differ = at[close], differ[close].reshape(-1, CHUNKS, WIDTH)
            chunk = (differ.sum(2) <= 1).argmax(1)
            in_chunk = differ[np.arange(len(at)), chunk]
            key = chunk * WIDTH + np.where(in_chunk.any(1), in_chunk.argmax(1), 0)
            at = at[np.isin(key, keys)]
            if len(at):
                yield i, at


def _across(members: DataFrame, known: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between nodes of a group that have different labels, confirmed on full sets.

    A large group is dealt out by pairs of parts of at most ``PART`` members,
    so a task holds two parts.  Full sets are fetched only for members that
    some other one may link to.
    """
    opened = members.join(known, "node")
    mixed = opened.groupBy("grp").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("grp")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    opened = opened.join(mixed, "grp", "left_semi").withColumn("other", other)
    opened = opened.withColumns({"first": F.least("part", "other"), "second": F.greatest("part", "other")})
    task = ["grp", "first", "second"]
    opened = opened.select(*task, "node", "n", "alone", "label", "part", "signature", "keys")

    def narrowed(rows: pa.Table) -> pa.Table:
        some = np.zeros(rows.num_rows, bool)
        for i, at in _pairs_of(rows, percent):
            some[i] = some[at] = True
        return rows.filter(pa.array(some))

    def linked(rows: pa.Table) -> pa.Table:
        node, sets, label = np.asarray(rows.column("node")), [unsqueeze(x, np.uint64) for x in rows.column("shingles").to_pylist()], rows.column("label").to_pylist()
        above = {v: v for v in label}
        size = np.array([len(s) for s in sets])

        def root(v: int) -> int:
            while above[v] != v:
                above[v] = v = above[above[v]]
            return v

        out = []
        for i, at in _pairs_of(rows, percent):
            at = np.array([j for j in at.tolist() if root(label[j]) != root(label[i])], np.int64)
            if not len(at):
                continue
            every = np.concatenate([sets[j] for j in at])
            place = np.minimum(np.searchsorted(sets[i], every), len(sets[i]) - 1)
            common = np.add.reduceat((sets[i][place] == every).astype(np.int64), np.cumsum(size[at]) - size[at])
            for j in at[100 * common >= percent * (size[at] + size[i] - common)].tolist():
                p, q = root(label[i]), root(label[j])
                if p != q:  # one link is enough to connect them
                    above[max(p, q)] = min(p, q)
                    out.append((min(node[i], node[j]), max(node[i], node[j])))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    few = saved(opened.groupBy(*task).applyInArrow(narrowed, opened.schema), "near-open", True)
    return saved(few.join(sets.select("node", "shingles"), "node").groupBy(*task).applyInArrow(linked, "a bigint, b bigint"), "near-links", True)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are near enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(i).to_pylist() for i in range(4))
            good = []
            for p, q in zip(x, y, strict=True):
                p, q = unsqueeze(p, np.uint64), unsqueeze(q, np.uint64)
                good.append(near_enough(len(np.intersect1d(p, q, assume_unique=True)), len(p), len(q), percent))
            yield pa.RecordBatch.from_pydict({"a": pa.array([v for v, g in zip(a, good, strict=True) if g], pa.int64()), "b": pa.array([v for v, g in zip(b, good, strict=True) if g], pa.int64())})

    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    return saved(both.select("a", "b", "x", "y").mapInArrow(check, "a bigint, b bigint"), "near-links", True)


def components(links: DataFrame) -> DataFrame:
    """(node, label) for the ends of the links: the smallest node each can reach."""
    edges = links.select("a", "b").union(links.select("b", "a")).toDF("a", "b")
    labels = saved(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"), "labels", True)
    while True:
        seen = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        low = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        new = saved(low.join(jump, "low").select("node", "old", F.least("low", "far").alias("label")), "labels", True)
        changed = new.where("old <> label").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: the id, ``n_shingles``, ``component_id``, ``kept`` and ``text_hash`` (XXH64 of the text).

    A document's set is its distinct five-word shingles with A-Z in lower
    case; with fewer words, the whole sequence as one.  Documents with
    100 * intersection >= ``percent`` * union are linked; pairs are found for
    certain enough (see above) from 80 up; ``component_id`` is the
    smallest id reachable, nulls aside, and the row with that id is kept.
    Null texts and texts without words have the empty set, link with nothing
    and are kept.  Rows that share an id are one document as far as ``kept``
    goes.  An empty table gives an empty result.  Other columns are ignored.
    """
    texts = columns(docs, id_col, text_col).toDF("doc_id", "text").select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    marked = saved(_marked(texts), "near-marks")
    nodes = marked.where("n > 0").groupBy("print").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("signature").alias("signature"))
    nodes = saved(nodes.withColumn("node", F.monotonically_increasing_id()), "near-nodes", True)
    members = _members(nodes)
    wanted = saved(nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "print", F.col("doc_id").alias("of")), "near-wanted", True)

    def read_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(texts_of(batch), len, AT_ONCE):
                sets = [s for s in shingle_sets(part) if len(s)]
                yield pa.RecordBatch.from_pydict(
                    {"print": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()), "shingles": pa.array([squeeze(s) for s in sets], pa.binary())}
                )

    def each_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, own = batch.column(0).to_numpy(), [unsqueeze(x, np.int64) for x in batch.column(1).to_pylist()]
            size = [len(x) for x in own]
            every, of = np.concatenate([*own, np.zeros(0, np.int64)]), np.repeat(node, size)
            for at in range(0, len(every), AT_ONCE):
                yield pa.RecordBatch.from_arrays([pa.array(of[at : at + AT_ONCE]), pa.array(every[at : at + AT_ONCE])], ["node", "shingle"])

    ids = wanted.select("of", F.xxhash64("of").alias("mark")).distinct()
    # texts of ids that surely aren't among them stay where they are
    some = sieved(texts, F.xxhash64("doc_id"), sieve(ids, "mark"), "maybe").where("maybe")
    again = some.join(ids, some["doc_id"].eqNullSafe(ids["of"]), "left_semi").select("text")
    # a print is a node's alone, and its sets lie together already
    sets = again.mapInArrow(read_sets, "print binary, shingles binary").join(wanted.select("print", "node"), "print").dropDuplicates(["print"])
    sets = saved(sets.select("node", "shingles"), "near-sets")
    single = sets.mapInArrow(each_shingle, "node bigint, shingle bigint").groupBy("shingle").agg(F.count("*").alias("c"), F.min("node").alias("node")).where("c = 1")
    alone = single.groupBy("node").agg(F.count("*").alias("alone"))
    known = nodes.join(wanted.select("node"), "node").join(alone, "node", "left").select("node", "n", F.coalesce("alone", F.lit(0)).alias("alone"), F.col("node").alias("label"), "signature")
    # what has too many shingles to itself can't reach the least similarity with anything
    known = saved(known.where(100 * (F.col("n") - F.col("alone")) >= percent * F.col("n")), "near-known", True)
    links = _confirmed(saved(_to_centre(members, known, percent), "near-pairs", True), sets, percent)
    labels = components(links)
    now = known.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")).select("node", "n", "alone", "label", "signature")
    labels = components(links.union(_across(members, saved(now, "near-known", True), sets, percent)))
    of = nodes.join(labels, "node", "left").select("print", "doc_id", F.coalesce("label", "node").alias("label"))
    least = of.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of = of.join(least, "label").select("print", "component_id")
    out = marked.select("doc_id", "text_hash", "n", "print").join(of, "print", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_hash")


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows that ``near_dedup`` keeps, with all their columns, whatever their names: one document of each component.

    Nulls, repeats and empty tables are as there.  Rows that surely stay are not
    moved; only those that may go are joined with the ids and hashes of what goes.
    """
    gone = near_dedup(docs, id_col, text_col, percent).where("not kept").select(F.col(f"`{id_col}`").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct()
    gone = saved(gone.withColumn("mark", F.xxhash64("gone_id", "gone_hash")), "near-gone", True)
    mark, maybe = unused(docs, "mark", "maybe")
    rows = docs.withColumn(mark, F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    rows = sieved(rows, F.xxhash64(F.col(f"`{id_col}`").cast("long"), F.col(f"`{mark}`")), sieve(gone, "mark"), maybe)
    gone = gone.select("gone_id", "gone_hash")
    held = rows.where(F.col(f"`{maybe}`"))
    open_ = held.join(gone, held[f"`{id_col}`"].eqNullSafe(gone["gone_id"]) & (held[f"`{mark}`"] == gone["gone_hash"]), "left_anti")
    return rows.where(~F.col(f"`{maybe}`")).unionByName(open_).select(*[F.col(f"`{c}`") for c in docs.columns])
