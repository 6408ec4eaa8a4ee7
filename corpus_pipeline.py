"""The training-corpus pipeline: each stage works on all the rows the one before it kept.

Null and empty texts are documents like others: the quality rules reject them, and the later stages,
given them, link, hit and change nothing. Repeated rows are near duplicates, one of which stays. An empty
table stays empty. Every column of the input comes through all stages, whatever its name; the last stage
adds ``copy``. Labels that are missing, or of one kind, leave the plain rules to decide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickflow.llm import decontaminate, mixing, near_dedup, pii, quality_rules
from clickflow.llm.common import drop_work_tables, keep_table, table, work_tables


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.good_documents(docs, table(spark, sf_dir, "labels"))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_dedup.one_of_each(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window of words with the benchmark go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to surrogates."""
    return pii.private(docs, pii.EXAMPLE_KEY)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to their target weights; the last stage, so it adds the number of the copy."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", good),
    ("near_dedup", deduplicated),
    ("decontamination", clean),
    ("pii", private),
    ("mixing", mixed),
]

ORACLE_SQL = None  # trained trees decide in the first stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; its own work tables go then."""
    docs, left = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with work_tables() as made:
            docs = keep_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        left = drop_work_tables(spark, left + made, docs)
    return docs
