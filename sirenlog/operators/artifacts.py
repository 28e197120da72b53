"""Artifact intake: check, name, store, and publish the attachment event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sirenlog.functions.text import dash_whitespace, or_default
from sirenlog.functions.timestamps import iso_millis
from sirenlog.operators.parsing import ATTACHED
from sirenlog.schemas import ARTIFACT_CONTENT
from sirenlog.session import stored

# Fixed values.
BUCKET = "incident-artifacts"
MAX_BYTES = 10 * 1024 * 1024
DEFAULT_MIME = "application/octet-stream"
NO_INCIDENT = "incidentId is required"
NO_FILE = "file is required"
TOO_LARGE = "File too large"


def object_key(incident_id: Column, received_at: Column, name: Column) -> Column:
    return F.concat(incident_id, F.lit("/"), F.unix_millis(received_at).cast("string"), F.lit("-"),
                    dash_whitespace(name))


def register_artifacts(
    intake: DataFrame, event_id: Column | None = None, received_at: str = "received_at"
) -> DataFrame:
    """Judge an intake of (incident_id, original_name, mime_type, size, received_at).

    ``original_name`` is null when no file came along.  Size is checked while
    the file is received, so before the other two.  Adds ``ok``, ``error``, the
    descriptor ``artifact`` and the event's ``key`` and ``value``.
    """
    event_id = F.uuid() if event_id is None else event_id
    error = (
        F.when(F.col("size") > MAX_BYTES, TOO_LARGE)
        .when(F.coalesce("incident_id", F.lit("")) == "", NO_INCIDENT)
        .when(F.col("original_name").isNull(), NO_FILE)
    )
    artifact = F.struct(
        F.lit(BUCKET).alias("bucket"),
        object_key(F.col("incident_id"), F.col(received_at), F.col("original_name")).alias("objectKey"),
        F.col("original_name").alias("originalName"),
        or_default(F.col("mime_type"), DEFAULT_MIME).alias("mimeType"),
        F.col("size").cast("bigint").alias("size"),
    )
    judged = intake.select("*", error.alias("error"), event_id.alias("event_id"))
    judged = judged.select(
        *intake.columns, F.col("error").isNull().alias("ok"), "error", "event_id",
        F.when(F.col("error").isNull(), artifact).alias("artifact"),
    )
    event = F.struct(
        F.col("event_id").alias("id"),
        F.col("incident_id").alias("incidentId"),
        F.lit(ATTACHED).alias("type"),
        F.concat(F.lit("Artifact attached: "), F.col("original_name")).alias("message"),
        iso_millis(F.col(received_at)).alias("timestamp"),
        F.col("artifact"),
    )
    return judged.select(
        *intake.columns, "ok", "error", "artifact",
        F.when(F.col("ok"), F.col("incident_id")).alias("key"),
        F.when(F.col("ok"), F.to_json(event)).alias("value"),
    )


def artifact_content(registered: DataFrame) -> DataFrame:
    """Rows of the content table for accepted files; ``content`` comes with the intake."""
    return registered.filter("ok").select(
        F.col("artifact.objectKey").alias("object_key"),
        F.col("artifact.mimeType").alias("mime_type"),
        "content",
    )


def write_content(content: DataFrame, path: str, load: str) -> None:
    """Store file contents under the name of this load; a content row is at most ``MAX_BYTES`` by the intake check.

    A load that is written again replaces itself, so a retried job stores nothing twice.
    """
    content.write.mode("overwrite").parquet(f"{path}/load={load}")


def read_content(spark: SparkSession, path: str) -> DataFrame:
    """One row per object key: of several loads the last by name counts, as in a store that overwrites.

    Which row that is, by load, file and place in it, follows from the keys
    alone.  Loads that hold no such row are not opened; contents move in one
    join at most, and not at all where the keys are few enough to be sent.
    """
    rows = spark.read.schema(StructType([*ARTIFACT_CONTENT.fields, StructField("load", StringType())])).parquet(path)
    place = F.struct("load", "_metadata.file_path", "_metadata.row_index")
    last = stored(rows.select("object_key", place.alias("place")).groupBy("object_key").agg(F.max("place").alias("place")), "manifest")
    loads = [r.load for r in last.select("place.load").distinct().collect()]  # names of loads
    return rows.filter(F.col("load").isin(loads)).withColumn("place", place).join(
        last.select("place"), "place", "left_semi").drop("place", "load")


def read_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files under ``path`` as (path, original_name, size, modified_at, content).

    A filter on ``size`` reaches the file source, which then never opens the
    files it drops; so files over the limit are refused by a projection
    without ``content``, and read with ``size <= MAX_BYTES``.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        "path",
        F.try_url_decode(F.replace(F.element_at(F.split("path", "/"), -1), F.lit("+"), F.lit("%2B"))).alias(
            "original_name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified_at"),
        "content",
    )
