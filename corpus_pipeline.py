"""From documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import pipeline
from tidemark.session import fresh_dir

# The quality classifier goes first, and each stage sees what the one before it has kept.
STAGES = [
    ("quality classifier", pipeline.quality),
    ("SimHash near-dedup", pipeline.near_duplicates),
    ("suffix-array dedup", pipeline.repeated_substrings),
    ("mixing sources to target weights", pipeline.mix_sources),
    ("packing", pipeline.pack),
]

# The stages train a language model, sort suffixes and draw pseudorandom numbers, which SQL can't express;
# tests/llm/test_pipeline.py holds every stage against a version of its own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written as Parquet and read as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = fresh_dir(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
