"""From raw documents to packed training sequences, each stage on all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landfall.llm import block_naming, langid, mixing, ngram_join, packing
from landfall.llm.common import documents, ship, stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    ship(spark)
    return langid.keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    ship(spark)
    return block_naming.drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group connected by n-gram similarity."""
    ship(spark)
    return ngram_join.drop_similar(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix of sources takes it."""
    ship(spark)
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    ship(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", near_dedup),
    ("source_mix", mix),
    ("vector_packing", pack),
]

#: Profiles, signatures and token ids cannot be said in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
