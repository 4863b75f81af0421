"""Runs of stages: each writes tables and a receipt; receipts chain by digest and can be held against each other.

Receipts are files beside the tables, so a run can be verified, compared,
continued and promoted by another driver than the one that made it.
"""

from __future__ import annotations

import json
import subprocess
import uuid
from collections.abc import Callable, Collection
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.canonical import canonical_json, sha256_json
from quarry.params import params_hash

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Stage:
    """A name, the tables it reads, and what makes its tables of them."""

    name: str
    inputs: tuple[str, ...]
    run: Callable[[Tables, dict], Tables]


@dataclass
class Run:
    out: str
    receipts: list[dict] = field(default_factory=list)
    tables: Tables = field(default_factory=dict)


def digest(df: DataFrame) -> str:
    """The same for the same rows in any order and partitioning: count and two sums of row hashes, each one aggregate."""
    cols = [F.array_sort(F.map_entries(f"`{c}`")) if kind.startswith("map<") else F.col(f"`{c}`") for c, kind in sorted(df.dtypes)]
    row = df.select(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(1), *cols).alias("b")).agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
    return sha256_json([str(v) for v in row])


def _fs(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _write(spark: SparkSession, path: str, content: dict) -> None:
    """One JSON file in place of whatever was there; a reader never sees half of it."""
    part, fs = _fs(spark, f"{path}.{uuid.uuid4().hex}.part")
    stream = fs.create(part, True)
    stream.write(bytearray(canonical_json(content)))
    stream.close()
    target, _ = _fs(spark, path)
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"can't write {path}")


def _read(spark: SparkSession, path: str) -> dict | None:
    target, fs = _fs(spark, path)
    if not fs.exists(target):
        return None
    return json.loads("\n".join(r["value"] for r in spark.read.option("wholetext", True).text(path).collect()))


def code_state(folder: str = ".") -> dict:
    """The commit of a folder and whether it has changes since; nulls where git can't tell."""
    ask = lambda *args: subprocess.run(["git", "-C", folder, *args], capture_output=True, text=True, timeout=30, check=True).stdout.strip()
    try:
        return {"git_sha": ask("rev-parse", "HEAD"), "dirty": bool(ask("status", "--porcelain"))}
    except (OSError, subprocess.SubprocessError):
        return {"git_sha": None, "dirty": None}


def run(spark: SparkSession, stages: list[Stage], sources: Tables, params: dict, out: str, only: Collection[str] | None = None, code: dict | None = None) -> Run:
    """Runs the stages in order; a stage that reads what nobody wrote is an error, never skipped.

    With ``only``, the other stages' receipts and tables are those that an
    earlier run left in the same place; a stage named there that has none is an
    error.  A stage's receipt is written when all its tables are.
    """
    done = Run(out, tables=dict(sources))
    written = {name: ("external", digest(df)) for name, df in sources.items()}
    code = code or code_state()
    for place, stage in enumerate(stages):
        at = f"{out}/{place:02d}-{stage.name}"
        if only is not None and stage.name not in only:
            receipt = _read(spark, f"{at}/receipt.json")
            if receipt is None:
                raise KeyError(f"{stage.name} has no receipt in {out}")
            for name, x in receipt["outputs"].items():
                done.tables[name] = spark.read.parquet(f"{at}/{name}")
                written[name] = (stage.name, x["sha256"])
            done.receipts.append(receipt)
            continue
        missing = [n for n in stage.inputs if n not in done.tables]
        if missing:
            raise KeyError(f"{stage.name} needs {missing}")
        receipt_at, fs = _fs(spark, f"{at}/receipt.json")
        fs.delete(receipt_at, False)
        inputs = {n: {"path": f"{written[n][0]}/{n}", "sha256": written[n][1]} for n in stage.inputs}
        outputs = {}
        for name, df in sorted(stage.run({n: done.tables[n] for n in stage.inputs}, params).items()):
            df.write.mode("overwrite").parquet(f"{at}/{name}")
            done.tables[name] = spark.read.parquet(f"{at}/{name}")
            written[name] = (stage.name, digest(done.tables[name]))
            outputs[name] = {"path": f"{stage.name}/{name}", "sha256": written[name][1]}
        done.receipts.append({"stage": stage.name, "code": code, "inputs": inputs, "outputs": outputs, "params_hash": params_hash(params)})
        _write(spark, f"{at}/receipt.json", done.receipts[-1])
    return done


def load(spark: SparkSession, stages: list[Stage], out: str) -> Run:
    """A run as its receipts and tables tell it."""
    return run(spark, stages, {}, {}, out, only=(), code={})


def verify(done: Run) -> list[str]:
    """What is wrong with a run: tables that changed since, inputs without an earlier producer, stale inputs."""
    faults, made = [], {}
    for r in done.receipts:
        for name, x in r["inputs"].items():
            if not x["path"].startswith("external/"):
                if name not in made:
                    faults.append(f"{r['stage']}: no producer of {name}")
                elif made[name] != x["sha256"]:
                    faults.append(f"{r['stage']}: stale {name}")
        for name, x in r["outputs"].items():
            made[name] = x["sha256"]
    return faults + [f"{n}: changed" for n, sha in made.items() if digest(done.tables[n]) != sha]


def manifest_hash(done: Run) -> str:
    return sha256_json(done.receipts)


def differences(a: Run, b: Run) -> list[str]:
    """Where two runs' receipts differ, stage by stage."""
    out = []
    for i in range(max(len(a.receipts), len(b.receipts))):
        x, y = (r.receipts[i] if i < len(r.receipts) else None for r in (a, b))
        if x is None or y is None or x["stage"] != y["stage"]:
            out.append(f"stage {i}")
            continue
        out += [f"{x['stage']}.{k}.{n}" for k in ("inputs", "outputs") for n in sorted({*x[k], *y[k]}) if x[k].get(n) != y[k].get(n)]
        out += [f"{x['stage']}.params_hash"] * (x["params_hash"] != y["params_hash"])
    return out


def promote(done: Run, accepted: str, gates_pass: bool, force: bool = False) -> None:
    """Puts a verified run's tables in the accepted place; refuses faults always and failed gates unless forced.

    All is copied beside it first and takes its place by renaming, so the
    accepted place holds one whole run at any time.  What was there before stays
    until then, and ``promotion.json`` tells whose tables these are and whether
    they were forced.
    """
    if faults := verify(done):
        raise ValueError("; ".join(faults))
    if not gates_pass and not force:
        raise ValueError("gates failed")
    accepted = accepted.rstrip("/")
    staged, old = (f"{accepted}.{kind}-{uuid.uuid4().hex}" for kind in ("staged", "old"))
    spark = None
    for r in done.receipts:
        for name in r["outputs"]:
            spark = done.tables[name].sparkSession
            done.tables[name].write.parquet(f"{staged}/{r['stage']}/{name}")
    if spark is None:
        raise ValueError("an empty run")
    _write(spark, f"{staged}/promotion.json", {"manifest": manifest_hash(done), "forced": bool(force and not gates_pass), "receipts": done.receipts})
    (new, fs), (target, _), (before, _) = (_fs(spark, p) for p in (staged, accepted, old))
    if fs.exists(target) and not fs.rename(target, before):
        raise OSError(f"can't move {accepted}")
    if not fs.rename(new, target):
        fs.rename(before, target)
        raise OSError(f"can't move {staged}")
    fs.delete(before, True)


def versus_accepted(verdicts: DataFrame, accepted: DataFrame) -> DataFrame:
    """(gate, metric, value, accepted, pass, accepted_pass): this run's measures beside the accepted run's; null where a run has none."""
    flat = lambda df, value, good: df.select("gate", F.col("pass").alias(good), F.explode("metrics").alias("metric", value))
    return flat(verdicts, "value", "pass").join(flat(accepted, "accepted", "accepted_pass"), ["gate", "metric"], "full").select("gate", "metric", "value", "accepted", "pass", "accepted_pass")
