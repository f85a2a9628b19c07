"""The corpus pipeline: documents through five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from propensity.llm import byte_bpe, decontaminate, exact_dedup, simhash, toxicity
from propensity.llm.texts import table
from propensity.session import work_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of toxicity; learned from labelled documents among them."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the longest, then the least doc_id."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints of three-word shingles that differ in at most two bits."""
    return simhash.keep_one(docs, width=3, radius=2)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window like a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, hashes of the ids and of the decoded bytes, and the ids packed."""
    return byte_bpe.encode(docs, ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written to the shared folder and reread."""
    folder = f"{work_folder(spark, 'pipeline')}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


# The classifier, the fingerprints and the merges cannot be told in SQL; tests compare with brute force.
ORACLE_SQL = None
