"""Session settings that the expressions in this package rely on, and its shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only: nothing here sizes the cluster.
#  * UTC           timestamps are rendered and parsed as UTC text
#  * duplicate keys  a JSON object may repeat a key and the last one wins
#  * method limit  the parsing stage generates one long method; past 8000 bytes
#                  of code the JVM would interpret it, and Spark's split
#                  projections are about 1.5 times as fast
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings; call before building any DataFrame of this package."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Without the setting a local session gets a temporary folder of its own;
    elsewhere that would be a folder other machines cannot see, so it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    known = context._jsc.sc().getCheckpointDir()
    if known.isEmpty():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sirenlog-"))
        known = context._jsc.sc().getCheckpointDir()
    return known.get().rstrip("/")


def stored(frame: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Written once and read back: what follows repeats no work and survives a lost executor.

    ``folder`` is where to write; by default a new one in the shared folder.
    """
    path = folder or f"{shared_folder(frame.sparkSession)}/{name}-{uuid.uuid4().hex}"
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
