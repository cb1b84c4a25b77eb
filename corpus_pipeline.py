"""From raw documents to packed training sequences, in stages that each stand on what the one before has written."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stationloom.llm import minhash, mixing, packing, quality, secrets
from stationloom.storage import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines over the limits are taken out of those that stay."""
    return quality.clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies stays."""
    return minhash.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is covered; all documents stay."""
    return secrets.redacted(docs)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them, some of them in part."""
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mixing", mixing_weights),
    ("packing", packed_sequences),
]

#: Token ids cannot be had from SQL; ``tests/llm`` holds the stages against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
