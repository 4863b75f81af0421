"""Provenance of runs as joins: completeness, coherence, differences, pins, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A run-relative path: not absolute, no step up, no backslash.
RELATIVE = r"^(?!/)(?!.*(^|/)\.\.(/|$))(?!.*\\).+$"
SHA256 = "^[0-9a-f]{64}$"


def missing_stages(registry: DataFrame, receipts: DataFrame) -> DataFrame:
    """Stages without a receipt."""
    return registry.join(receipts.select("stage_idx"), "stage_idx", "left_anti")


def producers(artifacts: DataFrame) -> DataFrame:
    """Each input with the last earlier stage that wrote its path: ``producer`` and ``produced_sha``, null if none did.

    One window over each path's outputs and inputs, instead of a range join:
    outputs of the stage itself come after its inputs.
    """
    is_out = F.col("kind") == "output"
    w = W.partitionBy("path").orderBy("stage_idx", is_out.cast("int"), "line").rowsBetween(W.unboundedPreceding, -1)
    last = F.last(F.when(is_out, F.struct(F.col("stage_idx").alias("s"), F.col("sha").alias("h"))), ignorenulls=True).over(w)
    return artifacts.withColumn("made", last).where(~is_out).select("stage_idx", "path", "sha", "line", F.col("made.s").alias("producer"), F.col("made.h").alias("produced_sha"))


def incoherent(artifacts: DataFrame) -> DataFrame:
    """Inputs that nothing earlier wrote (``no producer``) or that were written otherwise (``stale``)."""
    fault = F.when(F.col("producer").isNull(), "no producer").when(F.col("produced_sha") != F.col("sha"), "stale")
    return producers(artifacts).withColumn("fault", fault).where("fault is not null")


def run_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys (stage, kind, path, line) whose digest differs between two runs, or that only one has."""
    keys = ["stage_idx", "kind", "path", "line"]
    both = a.select(*keys, F.col("sha").alias("sha_a")).join(b.select(*keys, F.col("sha").alias("sha_b")), keys, "full_outer")
    return both.where(~F.col("sha_a").eqNullSafe(F.col("sha_b")))


def pin_faults(pinned: DataFrame, found: DataFrame) -> DataFrame:
    """(name, fault): pinned but not there, or there but not pinned."""
    gone = pinned.join(found, "name", "left_anti").select("name", F.lit("missing").alias("fault"))
    return gone.unionByName(found.join(pinned, "name", "left_anti").select("name", F.lit("unpinned").alias("fault")))


def receipt_faults(receipts: DataFrame) -> DataFrame:
    """(path, sha) rows that break the path or digest rules."""
    return receipts.where(~(F.col("path").rlike(RELATIVE) & F.col("sha256").rlike(SHA256)))


def manifest(receipts: DataFrame) -> DataFrame:
    """One row: the stages in order with their status, and the gate summary."""
    stages = F.array_sort(F.collect_list(F.struct("stage_idx", "status", "passed")))
    return receipts.agg(stages.alias("stages"), F.count("*").alias("total"), F.count_if("passed").alias("passed")).withColumn("shippable", (F.col("total") > 0) & (F.col("total") == F.col("passed")))
