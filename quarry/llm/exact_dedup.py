"""Exact dedup by deterministic block naming, with DataFrame functions only.

Texts are normalised (each run of white space becomes one space) and cut into
blocks of ``BLOCK`` characters.  Sorting the distinct blocks gives each an
integer name; adjacent names are then named in pairs, level by level, until
one name is left.  Names are assigned to distinct values, never hashed, so two
texts end with the same (level, name) if and only if they are equal.

A text whose length and 64-bit fingerprint no other row has is equal to no
other text, so it is its own identity and needs no name; every row that shares
them is named.  Only those rows' texts are cut, sorted and joined; a bitmap of
the shared fingerprints, of bounded size, tells most of the others where they lie.
A value's name is its place among all distinct values in sorted order, so names
depend on the texts alone.

Skew: a copied text sits in many rows.  Names are given to distinct blocks
(map-side combined), group sizes are sums (map-side combined), and the joins
that hand names back are plain equi-joins with one row per key on the naming
side, which adaptive execution splits where a key is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACE, columns, ranked, saved, sieve, sieved, unused

#: Characters in a block.
BLOCK = 4096


def normalised(text: Column) -> Column:
    """The text with runs of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _named(values: DataFrame, keys: list[str]) -> DataFrame:
    """Each distinct value of the keys with its place among them in sorted order, whatever the partitioning."""
    return ranked(values.select(*keys).distinct(), keys, "name", "names")


def block_names(texts: DataFrame, keys: list[str], block: int = BLOCK) -> DataFrame:
    """(keys, level, name) for each row's ``text``: equal texts and only those have equal level and name.

    The keys tell rows apart; rows with equal keys must have equal texts and give one row.
    """
    pieces = F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{block}}}"), F.lit(0)))
    cut = saved(texts.select(*keys, pieces.alias("pieces")).select(*keys, F.size("pieces").alias("m"), F.posexplode("pieces").alias("at", "piece")), "blocks")
    most = cut.agg(F.max("m")).first()[0] or 0
    level, done = 0, None
    now = saved(cut.join(_named(cut, ["piece"]), "piece").select(*keys, "m", "at", "name"), "level")
    while True:
        ready = now.where("m = 1").select(*keys, F.lit(level).alias("level"), "name")
        done = ready if done is None else done.unionByName(ready)
        if most <= 1:
            return done.dropDuplicates(keys)
        even = F.col("at") % 2 == 0
        pairs = now.where("m > 1").groupBy(*keys, ((F.col("m") + 1) / 2).cast("int").alias("m"), F.floor(F.col("at") / 2).cast("int").alias("at"))
        pairs = saved(pairs.agg(F.max(F.when(even, F.col("name"))).alias("left"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("right")), "pairs", True)
        now = saved(pairs.join(_named(pairs, ["left", "right"]), ["left", "right"]).select(*keys, "m", "at", "name"), "level")
        level, most = level + 1, (most + 1) // 2


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per input row: the id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Of equal texts the row with the smallest id stays, a null id counting as
    largest; of rows that also share the id, the first one read.  Null texts
    are empty texts, and all empty texts are equal.  An empty table gives an
    empty result.  Other columns are ignored.
    """
    text = columns(docs, id_col, text_col).toDF("doc_id", "raw").select("doc_id", normalised(F.col("raw")).alias("text"))
    print_ = [F.sha2(F.col("text"), 256).alias("sha"), F.xxhash64("text").alias("fp"), F.octet_length("text").alias("n")]
    slim = saved(text.select("doc_id", *print_).withColumn("row", F.monotonically_increasing_id()), "prints")
    # a table of its own, so that the joins with it are plain ones whose hot keys can be split
    shared = saved(slim.groupBy("fp", "n").agg(F.count("*").alias("copies")).where("copies > 1").select("fp", "n"), "shared", True)
    rows = slim.join(shared, ["fp", "n"], "left_semi").groupBy("doc_id", "sha").agg(F.min("row").alias("first_row"), F.count("*").alias("rows"))
    # texts that surely share no fingerprint stay where they are
    prints = text.select("doc_id", "text", *print_)
    mark = F.xxhash64("fp", "n")
    prints = sieved(prints, mark, sieve(shared.select(mark.alias("mark")), "mark"), "maybe").where("maybe").drop("maybe")
    named = block_names(prints.join(shared, ["fp", "n"], "left_semi").select("doc_id", "sha", "text"), ["doc_id", "sha"], block)
    same = rows["doc_id"].eqNullSafe(named["doc_id"]) & (rows["sha"] == named["sha"])
    named = saved(rows.join(named, same).select(rows["doc_id"], rows["sha"], "first_row", "rows", "level", "name"), "identities", True)
    order = F.struct(F.col("doc_id").isNull().alias("absent"), F.col("doc_id").alias("id"))
    groups = named.groupBy("level", "name").agg(F.min(order).alias("keep"), F.sum("rows").alias("size"))
    back = named.join(groups, ["level", "name"]).select(F.col("doc_id").alias("d"), F.col("sha").alias("s"), "first_row", F.col("keep.id").alias("keep"), "size")
    out = slim.join(back, slim["doc_id"].eqNullSafe(back["d"]) & (slim["sha"] == back["s"]), "left")
    alone = F.col("size").isNull()
    return out.select(
        F.col("doc_id").alias(id_col),
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("keep")) & (F.col("row") == F.col("first_row")))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The rows that ``exact_dedup`` keeps, with all their columns, whatever their names.

    Of rows repeated with their id and text one stays.  Rows that surely stay are
    not moved; only those that may go are joined with the ids and digests of what goes.
    """
    gone = exact_dedup(docs, id_col, text_col, block).where("not kept").select(F.col(f"`{id_col}`").alias("gone_id"), F.col("text_sha256").alias("gone_sha"), (~F.col(f"`{id_col}`").eqNullSafe(F.col("keep_id"))).alias("elsewhere")).distinct()
    gone = saved(gone.withColumn("mark", F.xxhash64("gone_id", "gone_sha")), "gone", True)
    digest, maybe = unused(docs, "digest", "maybe")
    rows = docs.withColumn(digest, F.sha2(normalised(F.col(f"`{text_col}`")), 256))
    rows = sieved(rows, F.xxhash64(F.col(f"`{id_col}`").cast(gone.schema["gone_id"].dataType), F.col(f"`{digest}`")), sieve(gone, "mark"), maybe)
    stay, open_ = rows.where(~F.col(f"`{maybe}`")), rows.where(F.col(f"`{maybe}`"))
    this = lambda some: F.col(f"`{id_col}`").eqNullSafe(some["gone_id"]) & (F.col(f"`{digest}`") == some["gone_sha"])
    elsewhere, again = gone.where("elsewhere"), gone.where("not elsewhere")
    open_ = open_.join(elsewhere, this(elsewhere), "left_anti")
    out = stay.unionByName(open_.join(again, this(again), "left_anti")).unionByName(open_.join(again, this(again), "left_semi").dropDuplicates([id_col, digest]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
