"""The training-data pipeline: stages over documents, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adlift.llm import stages
from adlift.llm.frames import written

STAGES = [
    ("quality_rules", stages.quality),
    ("near_dup", stages.near_dup),
    ("suffix_dedup", stages.passages),
    ("decontamination", stages.decontaminate),
    ("source_mix", stages.mixed),
]
#: SQL cannot express sketches, suffix order and draws; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on what the one before has kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
