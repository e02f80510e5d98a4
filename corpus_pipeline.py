"""The corpus pipeline: its stages in order, each an operator of scorewatch/llm applied to the documents kept so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorewatch.llm import bm25, minhash, mixing, pii, rules
from scorewatch.llm.common import discard, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return rules.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays, the one with the smallest id."""
    return minhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return bm25.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the text; n_chars follows it."""
    return pii.masked(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the texts that the mix takes of them in `emitted`; those it takes nothing of go.

    `mixing.emitted` makes these texts rows of their own.
    """
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixing_sources", mixing_sources),
]

# Near-duplicate components, ranked retrieval and sequence labelling have no plain SQL form; tests compare instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = source = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        if before is not source:  # each stage's copy goes once the next one is written
            discard(before)
    return docs
