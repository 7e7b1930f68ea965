"""A corpus pipeline of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockyard.llm import decontaminate, line_dedup, near_dup, packing, toxicity
from stockyard.llm.common import read, shared_path


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold stay."""
    return toxicity.clean_documents(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines are deleted from the texts; every document stays."""
    return line_dedup.dedup_lines(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id; of a document given twice, one row."""
    return near_dup.leaders(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item is found go."""
    return decontaminate.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, one row per piece of a document."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL cannot express these stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
