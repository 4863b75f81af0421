"""From documents to token ids: toxicity, exact dedup, near-dedup, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs.  Stages keep every column of
documents, and others that the table has, whatever their names; the last returns
the ids of each text.  A null text counts as empty in every stage, null ids are
ids, rows that repeat are rows (until a stage drops copies), and an empty table
gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import byte_bpe, common, exact_dedup, mixing, near_dedup, toxicity
from quarry.llm.registry import VOCABULARY

#: Documents at least this likely to be toxic go.
TOXIC = 0.5
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't call toxic; it learns from the labelled ones.

    Null and empty texts are scored as empty ones; rows that repeat are judged alike.
    """
    common.small_batches(spark)
    chain = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    prefix = "p_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    return toxicity.score(docs, chain, prefix=prefix).where(F.col(f"`{prefix}toxic`") < TOXIC).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, white space aside: the one with the smallest id, null ids last; all empty texts are one."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, five words and a similarity of 0.8 or more: the one with the smallest id. Texts without words stay."""
    common.small_batches(spark)
    return near_dedup.without_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources uses them: not at all, or up to three times. A null source is one of its own."""
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids): each whole text's token ids, four bytes each, lowest first."""
    common.small_batches(spark)
    vocabulary = byte_bpe.read_ranks(spark, public_tokenizers.path(VOCABULARY))
    coded = byte_bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary, public_tokenizers.PATTERN)
    return coded.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [("toxicity", reject_toxic), ("exact dedup", drop_copies), ("near dedup", drop_near_copies), ("mixing", mix), ("byte-level BPE", tokenize)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.saved(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
