"""A training corpus from raw documents: language, near duplicates, repeated passages, benchmark leaks, mixing.

``STAGES`` names the steps; each takes (spark, docs, sf_dir) and gives a table that is written as Parquet in the
shared folder and read again by the next one, so a lost executor repeats part of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from odolytics.llm import stages
from odolytics.plans.registry import query
from odolytics.session import work_path

STAGES = [
    ("language", stages.known_language),
    ("near_dedup", stages.one_of_each),
    ("suffix_dedup", stages.first_passages),
    ("decontaminate", stages.without_benchmark),
    ("mix", stages.mixed),
]

# Kernel ridge regression is not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
