"""Training-corpus pipeline: stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakevault.llm import bpe, decontaminate, pii, quality_rules, simhash_dedup
from lakevault.llm.queries import BATCH_BYTES, PII_KEY
from lakevault.llm.storage import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the threshold table."""
    return quality_rules.keep(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each SimHash component."""
    return simhash_dedup.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced."""
    return pii.pseudonymise(docs, PII_KEY)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, number of tokens and ids (little-endian 32-bit) of each document."""
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, carry=["doc_id", "lang", "source"])


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("pii", pii_stage),
    ("byte_bpe", bpe_stage),
]

#: SimHash components and byte-pair encoding have no SQL form; tests use a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set(*BATCH_BYTES)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
