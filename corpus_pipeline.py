"""Corpus preparation: a chain of stages, each of which works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patchlode.llm import stages
from patchlode.session import stage

STAGES = [
    ("language_id", stages.language_id),
    ("near_dedup", stages.near_dedup),
    ("substring_dedup", stages.substring_dedup),
    ("decontamination", stages.decontamination),
    ("packing", stages.packing),
]

#: No SQL form: the stages train, hash, align and pack. Tests compare them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
