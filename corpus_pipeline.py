"""The corpus pipeline: quality rules, quality classifier, near-duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before has kept. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripfunnel.llm import fertility, packing, pu_quality, simhash
from tripfunnel.llm.common import documents, stored
from tripfunnel.llm.queries import labels, quality_model


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the base rule and the tokeniser bands of their language."""
    return fertility.keep(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier scores 0.7 or more.

    The unlabelled text is ``documents`` as it came in: what the rules have left is nearly all good,
    so it would not show the classifier what to reject.
    """
    return pu_quality.keep(docs, quality_model(documents(spark, sf_dir), labels(spark, sf_dir)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link at 3 or fewer bits."""
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in length buckets and token-budget batches."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", near_duplicates),
    ("packing", pack),
]

#: Tokenisers, models and hashes are beyond SQL; tests compare the stages with direct versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is stored before the next reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
