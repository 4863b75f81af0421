"""License scans: MinHash bands over text windows retrieve templates, exact containment judges them.

A text becomes words (runs of a-z and 0-9 of the lower-cased text) and
five-word shingles.  A template matches if the whole text holds at least
``CONTAINED`` of its distinct shingles.

*Retrieval.* A template of n shingle places, of which a text holds 0.8 in order,
has an unbroken run in the text: every break costs at least four shingles, so
the longest run has 0.8 n / (n / 20 + 1) or more.  ``run_length`` stays at half of
that or below, at one of ``RUNS``, so that texts which hold a template only in
several damaged copies together are found too.  Every run of that length of a template is indexed, and
every text is cut, all of it, into windows twice as long that overlap by half, so
that each run lies wholly in some window and makes up half of it or more.  Windows
of each run length meet only the templates of that length.  A window has
``BANDS`` MinHash values, each a band of its own: bands of several values would
need many more of them at similarity one half.  A value agrees with probability
one half or more, so all 32 miss with probability 2**-32, if they were
independent.  They come in two families (the shingle's hash, and its halves
swapped), each with 16 orders, made by flipping the leading bits; within a family
a small set's values are dependent, and what a test measures is the miss rate of
whole scans: none in many thousand.  A run of one is a set of one, whose only
MinHash value is the shingle itself.

*Verdict.* Pairs of text and template that some band has retrieved, and no
others, are judged by exact counts over the whole text.  Shingles are compared by
64-bit hashes.

The index of the templates is broadcast while it has at most
``common.BROADCAST_ROWS`` rows, else joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import columns, saved, sieve, sieved, sized
from quarry.llm.license_texts import TEMPLATES

SHINGLE = 5
CONTAINED = 0.8
#: Lengths of indexed runs, and the least number of shingle places of a template whose runs have that length.
RUNS = {1: 1, 4: 20, 8: 60}
#: The longest window and how far the next one begins, in shingles; windows for shorter runs are parts of it.
WINDOW, STRIDE = 16, 8
ORDERS = 16
BANDS = 2 * ORDERS


def license_words(text: Column) -> Column:
    """Words of the lower-cased text: runs of a-z and 0-9."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def shingle_hashes(words: Column) -> Column:
    """Hashes of the five-word shingles by position; a shorter text has none."""
    places = F.sequence(F.lit(0), F.size(words) - SHINGLE)
    hashed = F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)]))
    return F.when(F.size(words) >= SHINGLE, hashed).otherwise(F.array().cast("array<bigint>"))


def hashed(rows: DataFrame) -> DataFrame:
    """The rows with ``hashes``, those of their shingles, in place of ``text``.

    Words are a column of their own, since an expression inside a lambda is evaluated for each element.
    """
    rest = [c for c in rows.columns if c != "text"]
    return rows.select(*rest, license_words(F.col("text")).alias("words")).select(*rest, shingle_hashes(F.col("words")).alias("hashes"))


def run_length(places: Column) -> Column:
    """Which of ``RUNS`` a template of so many shingle places is indexed by."""
    out = F.lit(1)
    for run, least in sorted(RUNS.items()):
        out = F.when(places >= least, run).otherwise(out)
    return out


def windows(hashes: Column) -> Column:
    """Slices of ``WINDOW`` elements at each multiple of ``STRIDE``; the last ones may be shorter."""
    last = F.floor((F.size(hashes) - 1) / STRIDE).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(hashes, i * STRIDE + 1, WINDOW))
    return F.when(F.size(hashes) > 0, cut).otherwise(F.array().cast("array<array<bigint>>"))


def banded(sets: DataFrame, parts: list[tuple[int, int]], singles: int) -> DataFrame:
    """The rows with a ``band`` value in place of ``w`` (an array of up to ``WINDOW`` hashes).

    Each part (first element and number) gives its least hash in each of the
    ``BANDS`` orders, and each of the first ``singles`` elements is a set of its
    own.  Orders are rows, so that one short expression serves all of them.
    """
    rest = [c for c in sets.columns if c != "w"]
    flips = [((k << 60) + (1 << 63)) % (1 << 64) - (1 << 63) for k in range(ORDERS)]
    orders = F.array(*[F.struct(F.lit(side).alias("turned"), F.lit(m).alias("flip")) for side in (False, True) for m in flips])
    places = range(WINDOW)
    split = sets.select(*rest, *[F.get("w", F.lit(i)).alias(f"x{i}") for i in places]).select("*", F.inline(orders))
    halves = lambda x: F.shiftleft(x, 32).bitwiseOR(F.shiftrightunsigned(x, 32))
    flipped = split.select(*rest, "turned", "flip", "x0", *[f"x{i}" for i in range(1, singles)], *[F.when(F.col("turned"), halves(F.col(f"x{i}"))).otherwise(F.col(f"x{i}")).bitwiseXOR(F.col("flip")).alias(f"y{i}") for i in places])
    least = [F.least(*[F.col(f"y{i}") for i in range(first, first + n)]) for first, n in parts]
    own = [F.col(f"x{i}") for i in range(singles)]
    plain = F.expr("not turned and flip = 0")
    values = F.array(*least) if not own else F.when(plain, F.array(*least, *own)).otherwise(F.array(*least).cast("array<bigint>"))
    return flipped.select(*rest, F.explode(values).alias("band")).where("band is not null")


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(template, n, run, hashes): number of distinct shingles, length of indexed runs, and all shingles in order; too short a template has none and is left out."""
    rows = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(k).alias("template"), F.lit(v).alias("text")) for k, v in sorted(templates.items())])))
    cut = hashed(rows).where(F.size("hashes") > 0)
    return saved(cut.select("template", F.size(F.array_distinct("hashes")).cast("long").alias("n"), run_length(F.size("hashes")).alias("run"), "hashes"), "license-templates")


def retrieved(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Distinct (id, mark, template) of rows (id, mark, hashes) that share a band with a run of the template."""
    index = None
    for run in RUNS:
        runs = F.expr(f"transform(sequence(1, size(hashes) - {run} + 1), i -> slice(hashes, i, {run}))")
        parts = table.where(F.col("run") == run).select("template", F.explode(runs).alias("w"))
        bands = banded(parts, [(0, WINDOW)], 0) if run > 1 else parts.select("template", F.col("w")[0].alias("band"))
        index = bands if index is None else index.unionByName(bands)
    index = sized(saved(index.distinct(), "license-index"))
    # a window of 16 holds those of 8 that begin in its first half, and the first half's single shingles
    cut = rows.select("id", "mark", F.explode(windows(F.col("hashes"))).alias("w"))
    return banded(cut, [(0, WINDOW), (0, WINDOW // 2), (STRIDE // 2, WINDOW // 2)], STRIDE).join(index, "band").select("id", "mark", "template").distinct()


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """A row for each text and template it contains: the id, ``template``, ``n_shingles``, ``n_matched``, ``containment``, ``first_word``, ``last_word``.

    ``n_shingles`` is the template's number of distinct shingles, ``n_matched``
    how many of them the whole text holds, and the words are the places (from 0)
    of the first and last word of what matched.  Null, empty and short texts
    match nothing.  Repeated rows are scanned each; null ids are ids.  Templates
    of fewer than five words match nothing.  An empty table gives an empty
    result.  Other columns are ignored.  A text of any length is one array of
    eight bytes a word, and its windows one of sixteen bytes a word.
    """
    table = template_table(docs.sparkSession, templates)
    texts = columns(docs, id_col, text_col).toDF("id", "text").withColumn("mark", F.xxhash64("text"))
    pairs = retrieved(hashed(texts), table)
    wanted = pairs.groupBy(F.col("id").alias("of"), F.col("mark").alias("its")).agg(F.collect_set("template").alias("templates"))
    wanted = saved(wanted, "license-wanted", True)
    # only texts that may be among the wanted ones meet them; the others stay where they are
    texts = sieved(texts, F.col("mark"), sieve(wanted, "its"), "maybe").where("maybe")
    open_ = texts.join(wanted, texts["id"].eqNullSafe(wanted["of"]) & (texts["mark"] == wanted["its"]))
    open_ = hashed(open_.select("id", "mark", "templates", "text"))
    shingles = sized(saved(table.select("template", "n", F.explode(F.array_distinct("hashes")).alias("h")), "license-shingles"))
    # an inner explode would be given a filter on hashes, which, pushed below the words, evaluates these for each element
    places = open_.select("id", "mark", "templates", F.posexplode_outer("hashes").alias("at", "h"))
    hits = places.join(shingles, "h").where(F.array_contains("templates", F.col("template")))
    # rows that share id and text have the same places, each as often as there are such rows; so texts need no number, nor a table
    hits = hits.groupBy("id", "mark", "template", "at").agg(F.first("n").alias("n"), F.first("h").alias("h"), F.count("*").alias("copies"))
    matched = hits.groupBy("id", "mark", "template").agg(
        F.first("n").alias("n_shingles"), F.count_distinct("h").alias("n_matched"), F.min("at").alias("first_word"), (F.max("at") + SHINGLE - 1).alias("last_word"), F.max("copies").alias("copies")
    )
    share = F.col("n_matched") / F.col("n_shingles")
    found = matched.where(share >= CONTAINED).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return found.select(F.col("id").alias(id_col), "template", "n_shingles", "n_matched", F.round(share, 6).alias("containment"), "first_word", "last_word")
