"""What the operators of this subpackage share: the shared folder, saved tables, packed exchanges.

*Saved tables.* Lineage is cut by writing Parquet into the folder that the
cluster names in ``spark.checkpoint.dir`` and reading it back, so a lost
executor costs the tasks it ran and nothing before them.  The tables of one
application sit under ``quarry-<application id>`` and can be deleted when it
has ended.

*Packed exchanges.* Operators that move hundreds of millions of small numbers
put them into a few compressed binary cells (one for each pair of sending task
and receiving bucket).  Spark shuffles, spills and recomputes those cells like
any other rows.
"""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: White space as the contracts define it: space and the controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
#: A word: a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = bytes.maketrans(_UPPER.encode(), _LOWER.encode())


@lru_cache(maxsize=8)
def _private_dir(application: str) -> str:
    return f"file://{tempfile.mkdtemp(prefix='quarry-shared-')}"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: what ``spark.checkpoint.dir`` names.

    Where it is unset, a folder of this machine serves if driver and executors
    are one process (``local[n]``, as in tests); on a cluster that is an error,
    since executors don't see each other's folders.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = _private_dir(spark.sparkContext.applicationId)
    return f"{found.rstrip('/')}/quarry-{spark.sparkContext.applicationId}"


#: Files of a saved slim table for each core of the cluster, at most.
FILES_A_CORE = 8


def saved(df: DataFrame, tag: str, slim: bool = False) -> DataFrame:
    """The same rows, written to the shared folder and read from there.

    A ``slim`` table has a few numbers for each row.  Where there are many more
    partitions than cores, a task writes several of its partitions one after
    the other, so that it doesn't become thousands of tiny files.
    """
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    out = df.coalesce(FILES_A_CORE * df.sparkSession.sparkContext.defaultParallelism) if slim else df
    out.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a slim table (a few numbers and names each) up to which it is broadcast: some hundred megabytes.
BROADCAST_ROWS = 2_000_000


def sized(df: DataFrame) -> DataFrame:
    """The table, marked for broadcast if its number of rows allows; beyond that Spark joins as it sees fit."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


#: Bits of a sieve: at least, at most (32 MB, whatever the tables' size), and for each member between.
LEAST_BITS, MOST_BITS, BITS_A_MEMBER = 20, 28, 64


def _bit(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << bits).cast("long")) + 1


def sieve(members: DataFrame, key: str) -> tuple[DataFrame, int]:
    """A bitmap of the members' keys (longs), in rows of 4 KB, and its number of bits as a power of two.

    Its size is bounded whatever the number of members; with too many of them
    it lets through everything.
    """
    bits = max(LEAST_BITS, min(MOST_BITS, (BITS_A_MEMBER * members.count()).bit_length()))
    at = members.select(_bit(F.col(key), bits).alias("at"))
    return saved(at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap")), "sieve", True), bits


def sieved(rows: DataFrame, key: Column, held: tuple[DataFrame, int], name: str) -> DataFrame:
    """The rows, where they lie, with a boolean column: false if the key is surely none of the sieve's members.

    So only rows that may be among them need an exact join, and long texts of all others are not shuffled.
    """
    bitmap, bits = held
    at, bucket, of, byte = unused(rows, "at", "bucket", "of", "byte")
    bitmap = bitmap.select(F.col("bucket").alias(of), F.col("bitmap").alias(byte))
    marked = rows.withColumn(at, _bit(key, bits))
    marked = marked.withColumn(bucket, F.bitmap_bucket_number(at)).join(F.broadcast(bitmap), F.col(bucket) == F.col(of), "left")
    octet = f"cast(conv(hex(substring(`{byte}`, cast(shiftright(bitmap_bit_position(`{at}`), 3) as int) + 1, 1)), 16, 10) as int)"
    bit = F.expr(f"shiftright({octet}, cast(bitmap_bit_position(`{at}`) % 8 as int)) & 1")
    return marked.select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce(bit == 1, F.lit(False)).alias(name))


#: Characters of a string that decide its range.
BOUND = 32


def ranked(values: DataFrame, keys: list[str], name: str, tag: str) -> DataFrame:
    """Saved rows with their places, from 0, in order of the keys: a range sort and an offset for each of its partitions.

    Places depend on the rows alone, however they are partitioned, if no two rows have equal keys.
    Partitions are bounded by the beginnings of strings, since a sample of the bounds goes to the driver.
    """
    strings = {f.name for f in values.schema.fields if f.dataType.typeName() == "string"}
    bounds = [F.substring(k, 1, BOUND) if k in strings else F.col(k) for k in keys]
    ordered = saved(values.repartitionByRange(*bounds).sortWithinPartitions(*keys).withColumn(name, F.monotonically_increasing_id()), tag)
    part = F.shiftright(name, 33)
    counts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row for each partition
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(F.col("part").alias("of"), before.alias("offset"))
    place = F.col("offset") + F.col(name) - F.shiftleft(F.col("of"), 33)
    return ordered.join(F.broadcast(offsets), part == F.col("of")).withColumn(name, place).drop("of", "offset")


def unused(df: DataFrame, *names: str) -> list[str]:
    """These names, each lengthened until no column of the table has it, whatever its case."""
    held = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in held:
            name += "_"
        held.add(name.lower())
        out.append(name)
    return out


#: Rows that go to Python at a time: texts are long, and each task holds a batch several times over.
ROWS_A_BATCH = 1000


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's rows per Arrow batch to what tables of texts need."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_A_BATCH))


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns, so that others of a table can't clash with an operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def words_in(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def lower_bytes(text: str) -> bytes:
    """UTF-8 with A-Z in lower case and everything else as it is."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWERED)


_IN, _OUT = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def squeeze(data: bytes | np.ndarray) -> bytes:
    return _IN.compress(data if isinstance(data, bytes) else np.ascontiguousarray(data).tobytes())


def unsqueeze(data: bytes, dtype: type | str | None = None):
    raw = _OUT.decompress(data)
    return raw if dtype is None else np.frombuffer(raw, dtype)


def planes(values: np.ndarray) -> np.ndarray:
    """Numbers by byte place, which compresses well."""
    return np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T)


def unplanes(data: bytes, dtype: type) -> np.ndarray:
    return np.ascontiguousarray(unsqueeze(data, np.uint8).reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def give_back() -> None:
    """Gives the system memory that this process holds but doesn't use: Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of an Arrow batch, null as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def runs(rows: list, size_of, most: int) -> Iterator[list]:
    """Consecutive rows in lists of at most ``most`` in size (or one row, if it alone is larger)."""
    held, n = [], 0
    for row in rows:
        s = size_of(row)
        if held and n + s > most:
            yield held
            held, n = [], 0
        held.append(row)
        n += s
    if held:
        yield held


def table(schema: pa.Schema, rows: Iterable[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Columns of packed blocks of documents.
BLOCKS = "ids array<bigint>, ends binary, data binary"
#: An id that is null sorts after all others.
NO_ID = np.iinfo(np.int64).max


def blocks(docs: DataFrame, most: int, change=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A saved table of documents in compressed blocks of at most ``most`` bytes (or one document): (block, ids, ends, data).

    ``change`` turns a text into bytes (UTF-8 by default); ``ends`` are the places in
    the data where documents end.  The block numbers are fixed by the saved table.
    """
    of = change or (lambda text: text.encode("utf-8", "surrogatepass"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("ids", pa.list_(pa.int64())), ("ends", pa.binary()), ("data", pa.binary())])
        held, n = [], 0

        def out() -> pa.RecordBatch:
            ends = np.cumsum([len(t) for _, t in held], dtype=np.int64)
            return table(schema, [([i for i, _ in held], squeeze(ends), squeeze(b"".join(t for _, t in held)))])

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
                raw = of(text)
                if held and n + len(raw) > most:
                    yield out()
                    held, n = [], 0
                held.append((i, raw))
                n += len(raw)
        if held:
            yield out()

    rows = columns(docs, id_col, text_col).toDF("doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return saved(rows.mapInArrow(pack, BLOCKS).withColumn("block", F.monotonically_increasing_id()), "blocks")


def sums_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    del order
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(values, first) if len(first) else values[:0]
