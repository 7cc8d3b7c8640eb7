"""The corpus pipeline: stages over the documents, each written as Parquet and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, jaccard_join, mixing, packing, quality_classifier
from tidemark.session import scratch_root

TOKENIZER = "word_bpe_49k.json"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_classifier.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each equal text, the one with the largest id."""
    return exact_dedup.deduplicate(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8 or more."""
    return jaccard_join.representatives(docs, words=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources meet their weights, in a global random order."""
    return mixing.replicate(docs).drop("copy", "shuffle_key")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences of at most 2048 tokens."""
    pieces = packing.pieces(docs, public_tokenizers.path(TOKENIZER))
    return packing.pack(pieces)


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("jaccard_join", near_stage),
    ("mix_sources", mixing_stage),
    ("best_fit_packing", packing_stage),
]

# The learned, replicating and packing stages have no SQL counterpart; their tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows: one for each piece of a kept copy."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_root(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
