"""Corpus pipeline: raw documents to packed training sequences in five stages.

Every stage takes the documents its predecessor kept and returns the documents
it keeps, with the same columns; the last one returns the packed pieces. A
stage's result is written to the shared folder and read again by the next, so a
lost executor costs no more than the running stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daycast.llm import exact_dedup, langid, minhash, packing, secrets
from daycast.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter or without a prevailing language."""
    return langid.keep_identified(docs, langid.learn(docs))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the largest doc_id of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the least doc_id, of each group linked at 80 per cent of the five-word shingles."""
    return minhash.drop_near_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks keys, passwords, hex strings other than digests, and random strings; every document stays."""
    return secrets.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("minhash_near_dedup", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: Trained models and token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
