"""A training-corpus pipeline: five stages over ``documents``, each written and read again between stages.

Every stage works on all that its predecessor kept; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ticklake.llm import near_dedup, packing, quality_classifier, quality_rules, substring_dedup
from ticklake.llm.common import read, staged
from ticklake.llm.queries import WORD_BPE


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_classifier.keep_good(docs, read(spark, sf_dir, "labels"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned rules (and the base rule) accept."""
    return quality_rules.keep_accepted(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: shingles of five words, similarity 0.8 or more."""
    return near_dedup.keep_first(docs, size=5, percent=80)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that a smaller document holds."""
    return substring_dedup.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all remaining texts, placed in sequences of 4096 tokens."""
    return packing.pack_documents(docs, WORD_BPE)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", classify),
    ("quality rules", rules),
    ("near duplicates", near_duplicates),
    ("substring dedup", substrings),
    ("best-fit packing", pack),
]

#: The classifier, the learned rules and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"stage-{i}")
    return docs
