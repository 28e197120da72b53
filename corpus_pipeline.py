"""The corpus pipeline: documents in, batches of clean, deduplicated documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sirenlog.llm.common import new_folder
from sirenlog.llm.stages import (
    pack_documents,
    quality_rules,
    remove_near_copies,
    remove_repeated_passages,
    replace_secrets,
)

STAGES = [
    ("quality", quality_rules),
    ("simhash", remove_near_copies),
    ("repeats", remove_repeated_passages),
    ("secrets", replace_secrets),
    ("packing", pack_documents),
]

# Fingerprints, suffix order and the bucket search are not expressible in plain
# SQL; tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "corpus-pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
