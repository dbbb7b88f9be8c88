"""A corpus pipeline over ``documents``: stages that each call one operator.

Every stage's rows are written as Parquet and reread as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lanecost.llm import minhash, packing, pii, quality, rules
from lanecost.llm.common import ship, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def trusted_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under trusted text is in its usual range."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in their language's perplexity band."""
    ship(spark)
    return rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates."""
    ship(spark)
    return minhash.keep(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every remaining document in length buckets and batches."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", trusted_quality),
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("packing", pack),
]

ORACLE_SQL = None
"""Language models are beyond SQL; tests hold the stages against brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
