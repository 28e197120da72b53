"""The stages of the corpus pipeline: each takes (spark, docs, sf_dir), and all but the last keep the columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sirenlog.llm import packing, quality, secret_scan, simhash
from sirenlog.llm.common import materialize, new_folder
from sirenlog.llm.queries import word_lengths


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules keep; fitted on this stage's own input and the labels of its rows."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.kept_documents(docs, model)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the later copies of repeated passages; a text that nothing is left of goes."""
    from sirenlog.llm import repeats

    return _with_length(repeats.remove_later_copies(docs), docs).filter("length(text) > 0 OR text IS NULL")


def replace_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every found secret replaced."""
    ledger = secret_scan.BlobLedger(spark, new_folder(spark, "blob-ledger"))
    return _with_length(secret_scan.redact_documents(docs, ledger), docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_words and the bucket, chunk, batch and place of every document."""
    return packing.pack(materialize(word_lengths(docs), "lengths"), "n_words", ["doc_id", "digest"]).drop("digest")


def _with_length(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns in their order, n_chars brought up to date."""
    if "n_chars" not in docs.columns:
        return changed.select(*docs.columns)
    kind = docs.schema["n_chars"].dataType
    return changed.withColumn("n_chars", F.char_length("text").cast(kind)).select(*docs.columns)
