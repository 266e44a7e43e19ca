"""From raw documents to token ids: five operators, each on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import bpe, exact, mixing, neardup, quality
from clickloom.session import scratch_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules find good."""
    return quality.good_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact.without_copies(docs, exact.DigestIndex(spark, scratch_dir(spark, "digest-index")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the rates fitted to the target mix say; good ones once."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mixed_documents(docs, mixing.domain_labels(labels))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the check of decoding them."""
    return bpe.coded(docs, bpe.default_vocabulary())


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: Expectation-maximisation, MinHash and byte-pair merges are no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            place = scratch_dir(spark, f"stage-{k}")
            docs.write.parquet(place)
            docs = spark.read.parquet(place)
    return docs
