"""The corpus pipeline: five stages that each work on all documents the stage before kept.

All stages but the last return the columns of ``documents``; the last one returns how much of every document the mix
takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from firmscout.llm import decontam, mixing, neardup, quality, substrings
from firmscout.llm.common import staged, table

#: Shared five-word shingles that make documents near copies, in percent of all they have.
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group of near copies the one with the smallest id stays."""
    return neardup.keep_first(docs, NEAR_PERCENT)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in a document with a smaller id too are cut out."""
    return substrings.cut_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("mixing_sources", mixing_sources),
]
# The fit of the quality model, the components and the substrings go beyond what one SQL statement can state in
# reasonable time; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what passes between them is written to the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = staged(docs)
    return docs
