"""Mixing sources to target weights with hash-threshold histograms.

Every document has a fixed 60-bit hash: 40 bits of its id and, below them, 20 of
its text, which tell rows apart that share an id.  For each source the words are
summed by the leading ``BITS`` bits of the hash; the running sum shows the
bucket in which the source's budget runs out, and only that bucket is split by
the next bits, ``LEVELS`` times.  What is left of it is resolved by single hash
values.  A document is taken if its hash is at or below its source's threshold,
so no document table is ever sorted, and a larger budget takes a superset.

The threshold stops short of the budget at the first document that doesn't fit.
What is left is filled by further documents, each the largest that still fits
(ties to the smaller hash), until none fits.  How many of each size that makes
follows from one histogram of sizes per source; which ones, from hash thresholds
again, per source and size.  They have fewer words together than the document at
which the threshold stopped, so their list is short.

A histogram has at most ``2**BITS`` rows per source, and the sums are combined
before the shuffle, so one source with a third of all rows costs no more than
others.  Sources may be many: their places come from a range sort with an offset
for each partition, and the level at which water-filling settles from a few
aggregates over all sources.  The table of sources (one row each) is joined by
Spark's own choice: broadcast if its measured size allows, else by a shuffle
whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.common import columns, ranked, saved, unused, words_in

BITS, LEVELS, WIDTH = 12, 3, 60
#: Bits of the hash that come from the text.
TEXT_BITS = 20
#: No document is used more often.
REPEATS = 3


def unit_hash(key: Column, seed: int = 0) -> Column:
    """60 bits of the MD5 of seed and key, the same in every engine; null hashes as the empty string."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, WIDTH // 4), 16, 10).cast("long")


def row_hash(key: Column, text: Column, seed: int = 0) -> Column:
    """The leading bits of the id's hash, then bits of the text's; null texts count as empty."""
    low = (1 << TEXT_BITS) - 1
    return F.shiftleft(F.shiftright(unit_hash(key, seed), TEXT_BITS), TEXT_BITS).bitwiseOR(F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit(low)))


def targets(sizes: DataFrame, weights: Column | None = None, repeats: int = REPEATS) -> DataFrame:
    """(key, source_size, target) from rows (key, size): shares by weight, none above ``repeats`` times the source.

    Sources in order of their key weigh 1, 2, 3, 1, ... unless ``weights`` (an
    expression over ``place``, from 0, and ``key``) says otherwise.  Sources
    that reach their limit give what they cannot use to the others by weight:
    the level is raised to what the words left make for the weights left, until
    no further source falls below it.
    """
    src = ranked(sizes.groupBy("key").agg(F.sum("size").alias("source_size")), ["key"], "place", "sources")
    src = src.withColumn("weight", (F.col("place") % 3 + 1) if weights is None else weights).withColumn("most", F.col("source_size") * F.lit(repeats))
    src = saved(src.withColumn("room", F.col("most") / F.col("weight")), "weights", True)
    level, last = -1.0, None
    while level != last:
        full = F.col("room") < F.lit(level)
        now = src.agg(F.sum("source_size").alias("words"), F.sum(F.when(full, F.col("most")).otherwise(0)).alias("given"), F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weight")).first()
        if not now["weight"]:
            break
        last, level = level, float(now["words"] - now["given"]) / float(now["weight"])
    most = F.col("most").cast("double")
    return src.select("key", "source_size", F.when(F.col("room") < level, most).otherwise(F.least(F.lit(level) * F.col("weight"), most)).alias("target"))


def _boundary(units: DataFrame, by: str) -> DataFrame:
    """For each key, the first ``by`` at which the running sum of size exceeds ``left``, and what is left before it."""
    run = F.sum("size").over(W.partitionBy("key").orderBy(by).rowsBetween(W.unboundedPreceding, 0))
    over = units.withColumn("run", run).where(F.col("run") > F.col("left"))
    first = F.row_number().over(W.partitionBy("key").orderBy(by)) == 1
    return over.withColumn("is_first", first).where("is_first").select("key", by, (F.col("left") - F.col("run") + F.col("size")).alias("left"))


def thresholds(sizes: DataFrame, budget: DataFrame) -> DataFrame:
    """(key, threshold, left): hashes up to the threshold fit the budget's ``left`` words; ``left`` remains.

    ``sizes`` has (key, h, size).  A key whose whole size fits has threshold ``2**60``.
    """
    edge, inside = budget.withColumn("prefix", F.lit(0).cast("long")), sizes.withColumn("prefix", F.lit(0).cast("long"))
    for level in range(1, LEVELS + 1):
        shift = WIDTH - BITS * level
        sums = inside.withColumn("bucket", F.shiftright("h", shift)).groupBy("key", "bucket").agg(F.sum("size").alias("size"))
        edge = saved(_boundary(sums.join(edge.select("key", "left"), "key"), "bucket").withColumnRenamed("bucket", "prefix"), "edge", True)
        inside = sizes.withColumn("prefix", F.shiftright("h", shift)).join(edge.select("key", "prefix"), ["key", "prefix"], "left_semi")
    last = inside.groupBy("key", "h").agg(F.sum("size").alias("size")).join(edge.select("key", "left"), "key")
    stop = _boundary(last, "h").select("key", (F.col("h") - 1).alias("threshold"), F.col("left").alias("left_over"))
    out = budget.join(stop, "key", "left")
    return out.select("key", F.coalesce("threshold", F.lit(1 << WIDTH)).alias("threshold"), F.coalesce("left_over", F.lit(0.0)).alias("left"))


def _times(rows: DataFrame, plan: DataFrame, extras: DataFrame, repeats: int, key: str, h: str, times: str, more: tuple[str, ...] = ()) -> DataFrame:
    """The rows, each with how often the mix takes it (column ``times``) and ``more`` columns of the plan."""
    own = [F.col(f"r.`{c}`") for c in rows.columns]
    joined = rows.alias("r").join(plan.alias("p"), F.col(f"r.`{key}`") == F.col("p.key"))
    extras = extras.select("key", "h", F.lit(True).alias("extra")).alias("e")
    joined = joined.join(extras, (F.col(f"r.`{key}`") == F.col("e.key")) & (F.col(f"r.`{h}`") == F.col("e.h")), "left")
    once_more = (F.col(f"r.`{h}`") <= F.col("p.threshold")) | F.coalesce(F.col("e.extra"), F.lit(False))
    return joined.select(*own, F.least(F.col("p.whole") + once_more.cast("int"), F.lit(repeats)).alias(times), *[F.col(f"p.{c}") for c in more])


def _top_ups(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """(key, h) beyond the threshold: each the largest that still fits into ``left``, until none fits.

    Rows that share a hash count with their joint size.
    """
    beyond = sizes.join(plan.select("key", "threshold", "left"), "key").where(F.col("h") > F.col("threshold"))
    units = beyond.groupBy("key", "h").agg(F.sum("size").alias("size"), F.first("left").alias("left"))
    units = saved(units.where("size > 0 and size <= left"), "open", True)
    counts = units.groupBy("key", "size").agg(F.count("*").alias("n"), F.first("left").alias("left"))
    # as many entries as there are sizes below that of the document at the threshold
    of = counts.groupBy("key").agg(F.first("left").alias("left"), F.sort_array(F.collect_list(F.struct("size", "n")), False).alias("by_size"))
    start = F.struct(F.col("left").alias("left"), F.expr("cast(array() as array<struct<size: bigint, k: bigint>>)").alias("takes"))

    def take(acc: Column, x: Column) -> Column:
        k = F.least(x["n"], F.floor(acc["left"] / x["size"]))
        takes = F.when(k > 0, F.concat(acc["takes"], F.array(F.struct(x["size"].alias("size"), k.alias("k"))))).otherwise(acc["takes"])
        return F.struct((acc["left"] - k * x["size"]).alias("left"), takes.alias("takes"))

    takes = of.select("key", F.inline(F.aggregate("by_size", start, take)["takes"]))
    takes = saved(takes.select("key", "size", F.struct("key", "size").alias("both"), F.col("k").cast("double").alias("k")), "takes", True)
    some = saved(units.join(takes, ["key", "size"]).select(F.col("both").alias("key"), "h", F.lit(1).cast("long").alias("size")), "top-ups", True)
    stops = thresholds(some, takes.select(F.col("both").alias("key"), F.col("k").alias("left")))
    return saved(some.join(stops, "key").where(F.col("h") <= F.col("threshold")).select(F.col("key.key").alias("key"), "h"), "extras", True)


def mix_plan(sizes: DataFrame, repeats: int = REPEATS) -> tuple[DataFrame, DataFrame]:
    """For each key of (key, h, size) its ``source_size``, ``target``, ``whole`` and ``threshold``, and (key, h) of what is taken beyond thresholds.

    Hashes up to the threshold or among the latter are taken once more than ``whole`` times.
    """
    src = saved(targets(sizes.select("key", "size"), repeats=repeats), "targets", True)
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(repeats))).otherwise(0).cast("int")
    src = src.withColumn("whole", whole).withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = saved(src.drop("left").join(thresholds(sizes, src.select("key", "left")), "key"), "plan", True)
    return plan, _top_ups(sizes, plan)


def _keyed(source: Column) -> Column:
    """Sources in order of code points, null after all others."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def _measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """(id, source, key, h, size) of the rows, saved."""
    rows = columns(docs, id_col, text_col, source_col).toDF("id", "text", "source")
    return saved(rows.select("id", "source", _keyed(F.col("source")).alias("key"), row_hash(F.col("id"), F.col("text"), seed).alias("h"), words_in(F.col("text")).alias("size")), "sizes")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0, repeats: int = REPEATS) -> DataFrame:
    """One row per input row: the id, ``source``, ``size``, ``source_size``, ``target``, ``times`` and ``taken``.

    ``times`` is how often the mix uses the document (0 to ``repeats``) and
    ``taken`` is ``times * size``.  Documents are used whole, and no source takes
    more than its target; what it misses of it is less than any document it
    leaves out.  A null text has size 0; a null source is a source of its own,
    last in order; null ids count as one id.  Rows that share an id are told
    apart by their texts; rows that share both are one document of their joint
    size, taken or left together.  Empty documents come with whatever threshold
    their hash falls under and take nothing.  An empty table gives an empty
    result.  Reruns agree, whatever the partitioning.
    """
    sizes = _measured(docs, id_col, text_col, source_col, seed)
    plan, extras = mix_plan(sizes.select("key", "h", "size"), repeats)
    out = _times(sizes, plan, extras, repeats, "key", "h", "times", ("source_size", "target"))
    return out.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0, repeats: int = REPEATS) -> DataFrame:
    """The mix itself: the rows, each as often as the mix uses it, with all their columns, whatever their names.

    Nulls, repeats and empty tables are as in ``mix_sources``.  Texts are never
    shuffled: each row is held against its source's plan.
    """
    plan, extras = mix_plan(_measured(docs, id_col, text_col, source_col, seed).select("key", "h", "size"), repeats)
    key, h, times, copy = unused(docs, "key", "h", "times", "copy")
    rows = docs.withColumns({key: _keyed(F.col(f"`{source_col}`")), h: row_hash(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), seed)})
    rows = _times(rows, plan, extras, repeats, key, h, times).where(F.col(f"`{times}`") > 0)
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(f"`{times}`")))).select(*[F.col(f"`{c}`") for c in docs.columns])
