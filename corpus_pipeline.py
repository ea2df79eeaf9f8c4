"""The corpus pipeline: documents that are neither toxic nor repeated, mixed to weights and packed into windows.

Each stage is written as Parquet and read again as the next one's documents. All but the last return the columns of
documents. Nothing here is sampled but the labelled rows that the toxicity model is fitted on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import line_dedup, mixing, packing, simhash, toxicity
from ledgerloom.llm.common import store

TOXIC_FROM = 0.5
TOKENIZER = "word_bpe_49k.json"
ORACLE_SQL = None  # hashing, a fitted model and a tokenizer have no SQL; tests check the stages


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold. The model learns from the labelled ones among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.learn(docs, labels, may_learn=F.lit(True))
    scored = toxicity.score(docs, model, "__toxicity")
    return scored.where(F.col("__toxicity") < TOXIC_FROM).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that a smaller doc_id holds; n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs).select(*docs.columns)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id: fingerprints of three-word shingles
    that links of two or fewer bits join. Null and empty texts are one group. Of repeated rows one stays."""
    return simhash.without_near_duplicates(docs, shingle_words=3, max_bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs, weights=(3, 1, 2), share=1.5, most=2.0)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
