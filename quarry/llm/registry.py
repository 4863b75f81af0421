"""The queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import byte_bpe, exact_dedup, license_scan, lm_scoring, mixing, near_dedup, secret_scan, suffix_dedup, topk_search, toxicity
from quarry.llm.common import small_batches
from quarry.llm.oracles import ORACLES

VOCABULARY = "byte_bpe_50k.tiktoken"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(documents(spark, sf_dir))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    chain = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, chain).select("doc_id", "p_junk", "p_toxic", (F.col("p_toxic") >= 0.5).alias("toxic"))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = byte_bpe.read_ranks(spark, public_tokenizers.path(VOCABULARY))
    ids = byte_bpe.encoded_documents(documents(spark, sf_dir), vocabulary, public_tokenizers.PATTERN)
    both = byte_bpe.decode(ids, vocabulary, public_tokenizers.PATTERN)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(documents(spark, sf_dir), ["doc_id"])
    kinds = [r.kind for r in secret_scan.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.size(F.filter("spans", lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}") for kind in kinds]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.suffix_dedup(documents(spark, sf_dir))
    removed = (F.col("n_bytes") - F.octet_length("kept")).cast("long")
    return done.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_score(documents(spark, sf_dir))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(documents(spark, sf_dir), percent=85).drop("text_hash")


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_mixing, op3_toxicity, op4_topk_search, op5_byte_bpe, op6_secret_scan, op7_suffix_dedup, op8_lm_scoring, op9_exact_dedup, op10_near_dedup)}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLES.items() if k in QUERIES}
