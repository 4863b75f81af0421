"""Exact top-k search by exhaustive term-at-a-time accumulation.

Every dimension is a term.  Candidates are packed into blocks; within a block
each term has its postings, the positions whose weight is not 0 and those
weights.  A block of query rows keeps one dense score array (queries by
candidates); term by term, the rows that hold the term scatter its weighted
postings into the array.  Partition selection then keeps each row's best ``k``
of the block, and the blocks' winners are merged.

Blocks are integers of the narrowest kind that holds them.  While all query
blocks together are small, they are broadcast and candidates stay where they
are.  Beyond that, queries and candidates meet in the cells of a grid: each
candidate goes to the cells of its row and each query to those of its column,
with as many more rows than columns as there are more candidate blocks, which
moves the least for a given number of cells.  A task scores one pair of blocks
at a time, so memory does not depend on the tables.  Before winners are
exchanged, each task keeps its best ``k`` of a query.  Work is queries times
candidates, as for any exhaustive search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.common import columns, saved

#: Rows in a block of queries and of candidates; queries and candidates that one score array spans.
QUERY_BLOCK, BLOCK = 2048, 16384
TILE_ROWS, TILE_COLS = 64, 4096
#: Bytes of all query blocks up to which they are broadcast.
BROADCAST_BYTES = 64 << 20
#: Cells of the grid for each core.
CELLS_A_CORE = 4
PACKED = "ids binary, rows binary, width long, kind string, values binary"


def quantised(vector: Column, scale: int) -> Column:
    """Components as floor(scale * x) in 64 bits; null if the vector or a component is null or not finite.

    A finite component whose value doesn't fit is an error, never a wrapped number.
    """
    wide = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fits = F.forall(wide, lambda x: F.abs(x) * abs(scale) < float(1 << 62))
    value = F.when(fits, F.transform(wide, lambda x: F.floor(x * scale).cast("long"))).otherwise(F.raise_error(F.lit("a component is too large for 64 bits")).cast("array<bigint>"))
    return F.when(vector.isNotNull() & finite, value)


def packed(vectors: DataFrame, most: int) -> DataFrame:
    """(ids, rows, width, kind, values): up to ``most`` rows of (vec_id, row, v) in each, sorted by vec_id."""
    schema = pa.schema([("ids", pa.binary()), ("rows", pa.binary()), ("width", pa.int64()), ("kind", pa.string()), ("values", pa.binary())])

    def cut(ids: np.ndarray, rows: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(ids, kind="stable")
        top = max(int(values.max(initial=0)), -int(values.min(initial=0)))
        kind = next(k for k, bits in (("<i1", 7), ("<i2", 15), ("<i4", 31), ("<i8", 63)) if top < 1 << bits)
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((ids[order].tobytes(), rows[order].tobytes(), values.shape[1], kind, values[order].astype(kind).tobytes()), schema.types, strict=True)], schema=schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for batch in batches:
            ids, rows = (np.asarray(batch.column(i), "<i8") for i in (0, 1))
            lists = batch.column(2)
            widths, flat = np.diff(np.asarray(lists.offsets)), np.asarray(lists.flatten(), "<i8")
            starts = np.cumsum(widths) - widths
            for width in np.unique(widths).tolist():
                of = np.flatnonzero(widths == width)
                group = held.setdefault(width, [])
                group.append((ids[of], rows[of], flat[starts[of][:, None] + np.arange(width)]))
                while sum(len(g[0]) for g in group) >= most:
                    every = [np.concatenate([g[i] for g in group]) for i in range(3)]
                    yield cut(*[v[:most] for v in every])
                    group[:] = [tuple(v[most:] for v in every)]
        for group in held.values():
            if every := [np.concatenate([g[i] for g in group]) for i in range(3)]:
                if len(every[0]):
                    yield cut(*every)

    return vectors.select("vec_id", "row", "v").mapInArrow(pack, PACKED)


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer inner products, accumulated term by term; whole numbers of any size where 64 bits might not do."""
    reach = float(np.abs(queries.astype(float)).max(initial=0)) * float(np.abs(candidates.astype(float)).max(initial=0)) * max(1, queries.shape[1])
    kind = np.int32 if reach < 2**31 else np.int64 if reach < 2**62 else object
    q, postings = queries.astype(kind), np.ascontiguousarray(candidates.T.astype(kind))
    dense = np.zeros((len(q), len(candidates)), kind)
    step = np.empty_like(dense)
    for term in range(q.shape[1]):
        holders, posted = np.flatnonzero(q[:, term]), np.flatnonzero(postings[term])
        if 2 * min(len(holders) * dense.shape[1], len(posted) * len(q)) > dense.size:  # mostly full: no gain from skipping zeros
            np.multiply(q[:, term, None], postings[term][None, :], out=step)
            np.add(dense, step, out=dense)
        elif len(holders) and len(posted):
            dense[np.ix_(holders, posted)] += q[holders, term, None] * postings[term, posted][None, :]
    if kind is object and any(not -(1 << 63) <= v < 1 << 63 for v in dense.ravel()):
        raise OverflowError("a score is too large for 64 bits")
    return dense.astype(np.int64) if kind is object else dense


def best(row: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest values, ties to the earlier position."""
    if len(row) <= k:
        return np.arange(len(row))
    edge = np.partition(row, len(row) - k)[len(row) - k]
    above = np.flatnonzero(row > edge)
    return np.concatenate([above, np.flatnonzero(row == edge)[: k - len(above)]])


def _block(x: dict, prefix: str) -> tuple[np.ndarray, ...]:
    ids, rows = (np.frombuffer(x[prefix + n], "<i8") for n in ("ids", "rows"))
    return ids, rows, np.frombuffer(x[prefix + "values"], x[prefix + "kind"]).reshape(len(ids), x["width"])


def _searched(k: int):
    def pair(x: dict) -> Iterator[tuple[np.ndarray, ...]]:
        """(query row, query id, candidate ids, scores): the k best of a block for each query of another."""
        (q_ids, q_rows, q), (c_ids, c_rows, c) = _block(x, "q_"), _block(x, "")
        for r in range(0, len(q), TILE_ROWS):
            kept: list[list] = [[] for _ in q_ids[r : r + TILE_ROWS]]
            for s in range(0, len(c), TILE_COLS):
                tile, of, its = scores(q[r : r + TILE_ROWS], c[s : s + TILE_COLS]), c_ids[s : s + TILE_COLS], c_rows[s : s + TILE_COLS]
                for i, row in enumerate(tile):
                    at = best(row, k + 1)  # one of them may be the query itself
                    at = at[its[at] != q_rows[r + i]][:k]
                    kept[i].append((of[at], row[at].astype(np.int64)))
            for i, parts in enumerate(kept):
                those, row = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                at = np.lexsort((those, -row))[:k]
                yield np.full(len(at), q_rows[r + i]), np.full(len(at), q_ids[r + i]), those[at], row[at]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                if found := list(pair(batch.slice(i, 1).to_pylist()[0])):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[n] for f in found])) for n in range(4)], ["query_row", "query_id", "vec_id", "score"])

    return search


def paired(candidates: DataFrame, queries: DataFrame, n_queries: int, query_bytes: int) -> DataFrame:
    """Every pair of a candidate block and a query block of the same width, once.

    ``queries`` is a saved table; ``n_queries`` is its number of blocks.
    """
    if query_bytes <= BROADCAST_BYTES:
        return candidates.join(F.broadcast(queries), "width")
    n_candidates, cells = candidates.count(), CELLS_A_CORE * candidates.sparkSession.sparkContext.defaultParallelism
    cols = max(1, min(n_queries, round((cells * n_queries / max(n_candidates, 1)) ** 0.5)))
    rows = max(1, -(-cells // cols))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    dealt = lambda n: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n).cast("long"))
    left = candidates.withColumn("grid_row", dealt(rows)).withColumn("grid_col", every(cols))
    right = queries.withColumn("grid_col", dealt(cols)).withColumn("grid_row", every(rows))
    return left.join(right, ["grid_row", "grid_col", "width"]).drop("grid_row", "grid_col")


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its k highest inner products over all other rows.

    ``is_query`` is an expression over ``vec_id``.  Rows whose id or vector is
    null, or whose vector has a null or non-finite component, take no part.
    Rows that share an id are rows of their own: each is a candidate for all
    others, and each query row has its own ranks.  Vectors of different lengths
    are not compared; empty ones score 0 with each other.  Ties go to the
    smaller id; fewer than k others give fewer rows; an empty table gives none.
    Scores are exact; one that doesn't fit 64 bits is an error.  Other columns
    are ignored.
    """
    rows = columns(vectors, id_col, vector_col).toDF("vec_id", "raw").select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("raw"), scale).alias("v"))
    rows = saved(rows.where("vec_id is not null and v is not null").withColumn("row", F.monotonically_increasing_id()), "vectors")
    asked = rows.where(is_query)
    queries = packed(asked.repartition(max(1, -(-asked.count() // QUERY_BLOCK))), QUERY_BLOCK)
    queries = saved(queries.select(*[F.col(c).alias(c if c == "width" else f"q_{c}") for c in ("ids", "rows", "width", "kind", "values")]), "query-blocks")
    size = queries.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("q_values") + F.octet_length("q_ids") * 2), F.lit(0)).alias("bytes")).first()
    candidates = packed(rows, BLOCK)
    if size["bytes"] > BROADCAST_BYTES:
        candidates = saved(candidates, "candidate-blocks")
    pairs = paired(candidates, queries, size["n"], size["bytes"])
    found = pairs.mapInArrow(_searched(k), "query_row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
