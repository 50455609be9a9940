"""The text pipeline: each stage works on all documents that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seriesflow.llm import stages
from seriesflow.sources.storage import store

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("simhash_near_dedup", stages.drop_near_copies),
    ("substring_dedup", stages.drop_repeated_passages),
    ("benchmark_decontamination", stages.drop_contaminated),
    ("sentencepiece", stages.encode),
]

# Fitted trees, 64-bit hashes and pair merges have no SQL; tests hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
