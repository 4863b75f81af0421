"""Secret scans with an incremental blob ledger.

Each row is one historical version of a path.  Its text is a blob, addressed by
its SHA-256.  The ledger holds one row for every (blob, rule, rule version) that
has been scanned, with the findings; a rule's version is a digest of all that it
says, so an edited rule is a new one.  A scan takes the blobs of the given
versions, leaves out the pairs already in the ledger, scans what is left, adds
it to the ledger, and joins the findings back to every path and version that has
the blob.

What needs scanning is told from digests alone.  A blob that one row has and the
ledger doesn't know is scanned where it lies.  Others need a join, to fetch one
copy and the rules still missing: a bitmap of bounded size tells which rows may
be concerned, and only their texts are moved.

Skew: a blob in many paths is scanned once, its copies being reduced before the
exchange; the join back has one row per blob, so adaptive execution can split a
hot one.  Only blobs with findings are joined back.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import columns, saved, shared_dir, sieve, sieved, table, texts_of


@dataclass(frozen=True)
class Rule:
    """A kind of secret: what it looks like, which group of a match counts and how long it must be, and words of which a text (in lower case) must have one."""

    kind: str
    pattern: str
    flags: int
    group: int
    least: int
    hints: tuple[str, ...] = ()

    @property
    def version(self) -> str:
        """Changes whenever the rule does."""
        return hashlib.sha256(repr((self.kind, self.pattern, int(self.flags), self.group, self.least, self.hints)).encode()).hexdigest()[:16]


#: The base kinds and their patterns, in the order that breaks ties.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 8, ("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", r"AKIA[A-Z0-9]+", re.A, 0, 16, ("akia",)),
    Rule("hex", r"[0-9a-f]+", re.A, 0, 32),
)
#: Further kinds, after the base ones.
RULES = (
    *BASE,
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----", re.A, 0, 1, ("private key-----",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", re.A, 0, 1, (".eyj",)),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", re.A, 0, 1, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
)
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
LEDGER = T.StructType([T.StructField("blob", T.StringType()), T.StructField("rule", T.StringType()), T.StructField("rule_version", T.StringType()), T.StructField("spans", SPANS)])
_HEX_32 = re.compile(r"[0-9a-f]{32}", re.A)


def spans_of(text: str, rule: Rule, low: str | None = None) -> list[tuple[int, int]]:
    """(start, end) in code points of one kind, leftmost and non-overlapping; ``low`` is the text in lower case, if known."""
    if rule.hints:
        low = text.lower() if low is None else low
        if not any(h in low for h in rule.hints):
            return []
    if rule.kind == "hex" and not _HEX_32.search(text):
        return []
    return [m.span() for m in re.finditer(rule.pattern, text, rule.flags) if len(m[rule.group]) >= rule.least]


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows of (blob, text, todo): one for each of the ``todo`` rules' kinds."""
    of = {r.kind: r for r in rules}
    schema = pa.schema([("blob", pa.string()), ("rule", pa.string()), ("rule_version", pa.string()), ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for blob, text, todo in zip(batch.column(0).to_pylist(), texts_of(batch), batch.column(2).to_pylist(), strict=True):
                low = text.lower()
                rows += [(blob, kind, of[kind].version, [{"kind": kind, "start": a, "end": b} for a, b in spans_of(text, of[kind], low)]) for kind in todo]
            yield table(schema, rows)

    return blobs.select("blob", "text", "todo").mapInArrow(scan, LEDGER)


def scan_secrets(versions: DataFrame, keys: list[str], ledger_path: str | None = None, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: the keys, ``blob`` and ``spans`` (array of kind, start, end; empty if none).

    Spans are in order of their start, then of the rules.  ``keys`` name the
    columns that tell path and version; they may be null and may repeat.
    ``ledger_path`` is a Parquet folder that scans share and extend; without one
    the ledger starts empty in the shared folder.  Null texts are empty blobs.
    A blob scanned twice under one rule version has the same findings, so a
    ledger row written twice does no harm.  An empty table gives an empty
    result.  Other columns are ignored.
    """
    spark = versions.sparkSession
    named = [f"key{i}" for i in range(len(keys))]
    rows = columns(versions, *keys, text_col).toDF(*named, "text").withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("blob", F.sha2("text", 256))
    paths = saved(rows.select(*named, "blob"), "paths", True)
    ledger_path = ledger_path or f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}"
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(ledger_path)
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    current = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)])
    ledger = lambda: spark.read.schema(LEDGER).parquet(ledger_path).where(F.col("rule_version") == F.try_element_at(current, F.col("rule")))
    known = ledger().groupBy("blob").agg(F.collect_set("rule").alias("done"))
    state = paths.groupBy("blob").agg(F.count("*").alias("n")).join(known, "blob", "left")
    state = state.select("blob", "n", F.xxhash64("blob").alias("mark"), F.when(F.col("done").isNull(), kinds).otherwise(F.array_except(kinds, "done")).alias("todo"))
    state = saved(state, "blobs", True)
    plain = (F.col("n") == 1) & (F.size("todo") == len(rules))
    # rows that may hold a blob that isn't plain, and those of them that may hold one with something to do
    other = sieve(state.where(~plain), "mark")
    work = saved(sieved(state, F.col("mark"), other, "maybe").where("maybe and size(todo) > 0").select("blob", "mark", "todo"), "work", True)
    rows = sieved(rows.select("blob", "text"), F.xxhash64("blob"), other, "other")
    alone = rows.where("not other").select("blob", "text", kinds.alias("todo"))
    some = sieved(rows.where("other"), F.xxhash64("blob"), sieve(work, "mark"), "open").where("open").select("blob", "text")
    fetched = some.join(work.select("blob", "todo"), "blob").groupBy("blob").agg(F.first("text").alias("text"), F.first("todo").alias("todo"))
    scan_blobs(alone.unionByName(fetched.select("blob", "text", "todo")), rules).write.mode("append").parquet(ledger_path)
    place = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    found = ledger().where(F.size("spans") > 0).dropDuplicates(["blob", "rule"]).groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    order = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.element_at(place, s["kind"]).alias("place"), s["kind"].alias("kind"), s["end"].alias("end"))))
    found = found.select("blob", F.transform(order, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))
    out = paths.join(found, "blob", "left").withColumn("spans", F.coalesce("spans", F.array().cast(SPANS)))
    return out.select(*[F.col(n).alias(k) for n, k in zip(named, keys, strict=True)], "blob", "spans")
