"""Toxicity by a classifier chain over character n-grams.

The categories are predicted one after another.  The model of each category is
linear in the presence of selected n-grams and in the log-odds of all earlier
categories.  For training, those log-odds are out of fold: the sample is split
in ``FOLDS`` by a hash of the id, and each part is predicted by models whose
n-grams and weights come from the other parts alone.  The models that are kept
are then fitted on the whole sample.

Training takes a bounded sample: the ``most`` labelled rows with the smallest
hashes (``SAMPLE`` by default).  The sample is all that is broadcast or brought
to the driver, besides the selected n-grams (``FEATURES`` for each category and
fold).  Every text is scored whole, by one pass of an automaton over it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import columns, saved, texts_of
from quarry.llm.mixing import unit_hash

SAMPLE, FOLDS, FEATURES, GRAM = 20_000, 3, 800, 5
#: Name, label column and the label that counts, in the order of the chain.
CATEGORIES = (("junk", "quality", 0), ("toxic", "toxic", 1))
ROUNDS, PENALTY = 120, 0.05


def spaced(text: str) -> str:
    """Lower case, with one space before, between and after words."""
    return f" {' '.join(text.lower().split())} "


def grams(text: str) -> set[str]:
    """Its n-grams within words, the space on either side included."""
    out: set[str] = set()
    for word in set(text.lower().split()):
        w = f" {word} "
        out.update([w[i : i + GRAM] for i in range(max(1, len(w) - GRAM + 1))])
    return out


@dataclass(frozen=True)
class Chain:
    """The n-grams, and for each category the weights of n-grams and of earlier log-odds, and the constant."""

    names: tuple[str, ...]
    features: tuple[str, ...]
    weights: tuple[tuple[float, ...], ...]
    earlier: tuple[tuple[float, ...], ...]
    constants: tuple[float, ...]

    def probabilities(self, found: list[int]) -> list[float]:
        odds: list[float] = []
        for w, e, c in zip(self.weights, self.earlier, self.constants, strict=True):
            odds.append(min(30.0, max(-30.0, c + sum(w[i] for i in found) + sum(a * b for a, b in zip(e, odds, strict=True)))))
        return [1 / (1 + np.exp(-o)) for o in odds]


@lru_cache(maxsize=4)
def automaton(features: tuple[str, ...]):
    found = ahocorasick.Automaton()
    for i, f in enumerate(features):
        found.add_word(f, i)
    found.make_automaton()
    return found


def present(text: str, features: tuple[str, ...]) -> list[int]:
    return sorted({i for _, i in automaton(features).iter(spaced(text))}) if features else []


def _fit(rows: np.ndarray, cols: np.ndarray, width: int, dense: np.ndarray, y: np.ndarray, use: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Weights of a penalised logistic regression on sparse binary columns, then dense ones, then a constant.

    Accelerated gradient steps, each column with a step that its curvature allows.
    """
    keep = use[rows] & mask[cols]
    r, c, n = rows[keep], cols[keep], len(y)
    x = np.column_stack([dense, np.ones(n)])
    count = np.bincount(r, minlength=n) + np.abs(x).sum(1)
    curve = np.concatenate([np.bincount(c, weights=count[r], minlength=width), (np.abs(x) * (count * use)[:, None]).sum(0)]) / 4 + 1.0
    penalty = np.concatenate([np.full(width + dense.shape[1], PENALTY), [0.0]])
    good = (y * use).sum()
    w = np.zeros(width + x.shape[1])
    w[-1] = np.log((good + 0.5) / (use.sum() - good + 0.5))
    v, t = w, 1.0
    for _ in range(ROUNDS):
        odds = np.bincount(r, weights=v[c], minlength=n) + x @ v[width:]
        miss = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - y) * use
        slope = np.concatenate([np.bincount(c, weights=miss[r], minlength=width), x.T @ miss]) + penalty * v
        new, t_new = v - slope / (curve + penalty), (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w


def _odds(w: np.ndarray, rows: np.ndarray, cols: np.ndarray, width: int, dense: np.ndarray, mask: np.ndarray) -> np.ndarray:
    keep = mask[cols]
    return np.clip(np.bincount(rows[keep], weights=w[cols[keep]], minlength=len(dense)) + np.column_stack([dense, np.ones(len(dense))]) @ w[width:], -30, 30)


def train(docs: DataFrame, labels: DataFrame, categories: tuple = CATEGORIES, most: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """A chain fitted on at most ``most`` labelled rows.

    Rows whose id or any label is null are left out; labels that repeat for
    an id count once, the largest of each, and of texts that share an id the
    least one is learnt from, so the bound holds whatever repeats.  Null texts
    are empty; a text of any length is read whole.  Without labelled rows every
    probability is one half, and with none of a category it is near 0.  Other
    columns are ignored.
    """
    names = tuple(c[0] for c in categories)
    truth = columns(labels, id_col, *dict.fromkeys(c[1] for c in categories)).withColumnRenamed(id_col, "doc_id")
    truth = truth.select("doc_id", *[(F.col(c) == v).cast("int").alias(f"y{i}") for i, (_, c, v) in enumerate(categories)])
    marks = [f"y{i}" for i in range(len(names))]
    truth = truth.dropna().groupBy("doc_id").agg(*[F.max(m).alias(m) for m in marks])
    truth = truth.withColumn("h", unit_hash(F.col("doc_id"), 3)).orderBy("h", "doc_id").limit(most).withColumn("fold", (F.col("h") % FOLDS).cast("int")).drop("h")
    texts = columns(docs, id_col, text_col).toDF("doc_id", "text")
    found = texts.join(F.broadcast(truth), "doc_id")  # at most ``most`` rows of numbers
    sample = saved(found.groupBy("doc_id", "fold", *marks).agg(F.min("text").alias("text")), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], list[int]] = defaultdict(lambda: [0] * (1 + len(names)))
        for batch in batches:
            folds, ys = batch.column(1).to_pylist(), [batch.column(2 + i).to_pylist() for i in range(len(names))]
            for at, text in enumerate(texts_of(batch)):
                these = [1, *[y[at] for y in ys]]
                for g in grams(text):
                    held = seen[g, folds[at]]
                    for i, v in enumerate(these):
                        held[i] += v
        if seen:
            cols = [pa.array([k[0] for k in seen]), pa.array([k[1] for k in seen], pa.int32())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array([v[i] for v in seen.values()], pa.int64()) for i in range(1 + len(names))], ["gram", "fold", "n", *marks])

    counted = sample.select("text", "fold", *marks).mapInArrow(count, f"gram string, fold int, n long, {', '.join(f'{m} long' for m in marks)}")
    sizes = {r["fold"]: r for r in sample.groupBy("fold").agg(F.count("*").alias("n"), *[F.sum(m).alias(m) for m in marks]).collect()}
    sums = [F.sum(F.when(F.col("fold") != f, F.col(c)).otherwise(0)).alias(f"{c}_{f}") for f in range(FOLDS) for c in ("n", *marks)]
    grouped = saved(counted.groupBy("gram").agg(*[F.sum(c).alias(f"{c}_all") for c in ("n", *marks)], *sums), "toxicity-grams", True)
    chosen: dict[tuple[int, object], list[str]] = {}
    for i, m in enumerate(marks):
        for part in ("all", *range(FOLDS)):
            n, good = (sum(r[c] for f, r in sizes.items() if f != part) for c in ("n", m))
            # log-likelihood ratio of the two-by-two table of n-gram and category
            cell = lambda k, of: F.when(k > 0, k * F.ln(k / of)).otherwise(0.0)
            a, b = F.col(f"{m}_{part}").cast("double"), F.col(f"n_{part}").cast("double")
            rate = [good / max(n, 1), 1 - good / max(n, 1)]
            ratio = cell(a, b * rate[0]) + cell(b - a, b * rate[1]) + cell(good - a, (n - b) * rate[0]) + cell(n - good - b + a, (n - b) * rate[1])
            best = grouped.where(F.col(f"n_{part}") > 1).orderBy(F.desc(F.round(ratio, 6)), "gram").limit(FEATURES) if 0 < good < n else grouped.limit(0)
            chosen[i, part] = [r["gram"] for r in best.select("gram").collect()]
    features = tuple(sorted({g for held in chosen.values() for g in held}))
    place = {g: i for i, g in enumerate(features)}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([present(t, features) for t in texts_of(batch)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), *[batch.column(3 + i) for i in range(len(names))], found], ["doc_id", "fold", *marks, "found"])

    shown = sample.select("text", "doc_id", "fold", *marks)
    known = shown.mapInArrow(find, T.StructType([*shown.schema.fields[1:], T.StructField("found", T.ArrayType(T.IntegerType()))])).orderBy("doc_id").toArrow()
    lists = known.column("found").combine_chunks()
    ends = np.diff(np.asarray(lists.offsets)) if len(lists) else np.zeros(0, int)
    rows, cols = np.repeat(np.arange(len(ends)), ends), np.asarray(lists.values, dtype=np.int64) if len(ends) else np.zeros(0, np.int64)
    fold, width = np.asarray(known.column("fold")), len(features)
    masks = {k: np.isin(np.arange(width), [place[g] for g in v]) for k, v in chosen.items()}
    dense, everyone = np.zeros((len(fold), 0)), np.ones(len(fold), bool)
    weights, earlier, constants = [], [], []
    for i, m in enumerate(marks):
        y = np.asarray(known.column(m)).astype(float)
        kept = _fit(rows, cols, width, dense, y, everyone, masks[i, "all"])
        outside = np.zeros(len(y))
        for f in range(FOLDS):
            part = _fit(rows, cols, width, dense, y, fold != f, masks[i, f])
            outside[fold == f] = _odds(part, rows, cols, width, dense, masks[i, f])[fold == f]
        weights.append(tuple(np.where(masks[i, "all"], kept[:width], 0.0).tolist()))
        earlier.append(tuple(kept[width:-1].tolist()))
        constants.append(float(kept[-1]))
        dense = np.column_stack([dense, outside])
    return Chain(names, features, tuple(weights), tuple(earlier), tuple(constants))


def score(docs: DataFrame, chain: Chain, text_col: str = "text", prefix: str = "p_") -> DataFrame:
    """The rows with a probability for each category (columns ``p_<name>``), whatever their other columns.

    Null texts are scored as empty ones, and a text of any length is read
    whole; an empty table gives an empty result.  Rows are scored each by
    itself, so repeated ones have equal scores.  A table that has one of the new
    columns already is an error: another prefix avoids it.
    """
    names = [prefix + n for n in chain.names]
    if taken := {c.lower() for c in docs.columns} & {n.lower() for n in names}:
        raise ValueError(f"the table has columns {sorted(taken)}")
    held = docs.sparkSession.sparkContext.broadcast(chain)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Chain = held.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                out = [model.probabilities(present(t, model.features)) for t in texts_of(batch, text_col)]
                for i, name in enumerate(names):
                    batch = batch.append_column(name, pa.array([p[i] for p in out], pa.float64()))
                yield batch

    return docs.mapInArrow(work, T.StructType([*docs.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]]))
