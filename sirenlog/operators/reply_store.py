"""Replies kept by the hash of their prompt, written before they are used.

A generator is slow and costs per prompt, so no prompt is asked twice: equal
prompts of one run are asked once, and prompts with a stored reply not at all.
The prompts of a run are dealt into tasks of at most about ``per_task``, and a
finished task's replies are in the store at once (the writer moves them as the
task commits, not as the job does).  A job that fails half-way, or is started
again, so asks only what no task had finished.  Errors are told to their
requests and not kept: the next run asks those prompts again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sirenlog.operators.summaries import Generator, generate_summaries, offline_generator
from sirenlog.session import stored

ROWS = "prompt_hash string, reply string, error string, run string"
_AT_ONCE = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def prompt_hash() -> Column:
    return F.sha2(F.col("prompt"), 256)


class ReplyStore:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def rows(self) -> DataFrame:
        """Everything that was written: ``prompt_hash``, ``reply`` or ``error``, and the ``run``."""
        try:
            return self.spark.read.schema(ROWS).parquet(self.folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ROWS)

    def replies(self) -> DataFrame:
        """One ``reply`` per ``prompt_hash``; of several (two runs at a time) always the same one."""
        return self.rows().filter("reply IS NOT NULL").groupBy("prompt_hash").agg(F.min("reply").alias("reply"))

    def generate(self, prompts: DataFrame, make_generator: Callable[[], Generator] = offline_generator,
                 per_task: int = 256, batch_size: int = 64) -> DataFrame:
        """As :func:`generate_summaries`, but only prompts without a stored reply are asked."""
        asked = stored(prompts.select("request_id", "incident_id", "prompt").withColumn("prompt_hash", prompt_hash()), "prompts")
        missing = stored(
            asked.groupBy("prompt_hash").agg(F.first("prompt").alias("prompt")).join(
                self.replies(), "prompt_hash", "left_anti"), "missing-prompts")
        run, n = uuid.uuid4().hex, missing.count()
        if n:
            named = missing.select(F.col("prompt_hash").alias("request_id"), F.lit("").alias("incident_id"), "prompt")
            answers = generate_summaries(named, make_generator, parallelism=-(-n // per_task), batch_size=batch_size)
            answers.select(F.col("request_id").alias("prompt_hash"), "reply", "error").write.options(**_AT_ONCE).parquet(
                f"{self.folder}/run={run}")
        errors = self.rows().filter((F.col("run") == run) & F.col("error").isNotNull()).select("prompt_hash", "error")
        known = self.replies().withColumn("error", F.lit(None).cast("string")).unionByName(
            errors.withColumn("reply", F.lit(None).cast("string")))
        return asked.drop("prompt").join(known, "prompt_hash").select("request_id", "incident_id", "reply", "error")
