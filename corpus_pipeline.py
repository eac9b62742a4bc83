"""A corpus pipeline: each stage takes documents and returns documents, the last one their tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weirflow.llm import bpe, decontaminate, exact_dedup, langid, simhash
from weirflow.llm.common import prepared, table, write_table

NEAR_WORDS, NEAR_SIMILARITY = 5, 0.8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language (null, empty or letterless text, or noise to the model) go."""
    prepared(spark)
    return langid.drop_unknown(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return exact_dedup.drop_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 0.8 or more of their five-word shingles the one with the least doc_id stays.
    Candidates are the groups of SimHash fingerprints within two bits, and sets that share a MinHash key."""
    return simhash.drop_near(docs, shingle=NEAR_WORDS, similarity=NEAR_SIMILARITY)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of what is left."""
    prepared(spark)
    return bpe.token_digests(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("simhash", near),
    ("decontaminate", benchmark),
    ("bpe", tokens),
]

ORACLE_SQL = None  # trained weights and fingerprints cannot be written in SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder for the next."""
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
