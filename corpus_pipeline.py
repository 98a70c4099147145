"""Corpus pipeline: toxicity, quality rules, near copies, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on every row that its
predecessor kept; ``run`` applies them to ``documents``, writing each
stage's result to the shared folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wikipassages.llm import stages
from wikipassages.llm.common import written

STAGES = stages.STAGES

#: Learned models, near copies and packing have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
