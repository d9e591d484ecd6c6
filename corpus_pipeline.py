"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltlake.llm import bpe, chunk_dedup, decontaminate, language, simhash
from voltlake.llm.common import written
from voltlake.llm.queries import tokenizer


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows without letters and those in no learned language."""
    return language.drop_unidentified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return chunk_dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by SimHash fingerprints (three-word shingles, three bits) the smallest doc_id stays."""
    return simhash.drop_near_duplicates(docs, simhash.WORDS, simhash.MAX_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows that contain a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the rows that are left, decoded again: ``doc_id, n_tokens`` and checksums of both."""
    path = tokenizer()
    return bpe.digests(bpe.decode(bpe.encode(docs, path), path))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: Fingerprint links, tilings and byte-pair merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
