"""First deliveries to the rows of the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sirenlog.operators.parsing import ARTIFACT, FULL, TIMELINE_ROUTES
from sirenlog.operators.routing import CONSUMER_GROUP

TIMELINE_INPUT = ("incident_id", "event_timestamp", "event_type", "message")
HEALTH_INPUT = (
    "partition", "offset", "incident_id", "org_id", "service_name", "severity", "severity_kind",
    "event_timestamp", "message",
)
ARTIFACT_INPUT = ("incident_id", "event_timestamp", "artifact")


def status_of(severity: Column) -> Column:
    return F.when(severity.eqNullSafe(F.lit("CRITICAL")), "DEGRADED").otherwise("ACTIVE")


def ledger_rows(first: DataFrame, processed_at: Column) -> DataFrame:
    return first.select(
        F.lit(CONSUMER_GROUP).alias("consumer_group"),
        F.col("event_id").alias("message_id"),
        processed_at.alias("processed_at"),
    )


def timeline_rows(first: DataFrame) -> DataFrame:
    return first.filter(F.col("verdict").isin(*TIMELINE_ROUTES)).select(
        "incident_id", "event_timestamp", "event_id", "event_type", "message"
    )


def artifact_rows(first: DataFrame) -> DataFrame:
    return first.filter(F.col("verdict") == ARTIFACT).select(
        "incident_id",
        F.col("event_timestamp").alias("uploaded_at"),
        F.col("event_id").alias("artifact_id"),
        F.col("artifact.bucket").alias("bucket"),
        F.col("artifact.objectKey").alias("object_key"),
        F.col("artifact.originalName").alias("original_name"),
        F.col("artifact.mimeType").alias("mime_type"),
        F.col("artifact.size").alias("size_bytes"),
    )


def health_changes(first: DataFrame, batch_id: int = 0, missing: str = "keep") -> DataFrame:
    """One row per health write.

    ``missing`` says what an absent severity does to the stored one: ``keep``
    leaves it, ``null`` erases it as an explicit null does.
    """
    if missing not in ("keep", "null"):
        raise ValueError("missing must be 'keep' or 'null'")
    arrival = F.struct(
        F.lit(batch_id).cast("bigint").alias("batch_id"), F.col("partition"), F.col("offset")
    )
    writes_severity = F.col("severity_kind").isNotNull() if missing == "keep" else F.lit(True)
    return first.filter(F.col("verdict") == FULL).select(
        "org_id",
        "service_name",
        F.col("incident_id").alias("latest_incident_id"),
        F.col("event_id").alias("latest_event_id"),
        "severity",
        status_of(F.col("severity")).alias("status"),
        F.col("event_timestamp").alias("last_updated"),
        "message",
        arrival.alias("arrival"),
        F.when(writes_severity, arrival).alias("severity_arrival"),
    )


def fold_health(changes: DataFrame) -> DataFrame:
    """Last write per service in arrival order, column by column.

    Event times are not compared: a late message overwrites a newer state.
    The output has the shape of the input, so folds of folds are exact: per
    batch, over batches, and in compaction.  Partial aggregation leaves one
    row per service and map task, however hot the service is.
    """
    latest = ("latest_incident_id", "latest_event_id", "status", "last_updated", "message", "arrival")
    return (
        changes.groupBy("org_id", "service_name")
        .agg(
            F.max_by(F.struct(*latest), "arrival").alias("last"),
            # A null here is a severity erased by an explicit null.
            F.max_by("severity", "severity_arrival").alias("severity"),
            F.max("severity_arrival").alias("severity_arrival"),
        )
        .select(
            "org_id", "service_name", "last.latest_incident_id", "last.latest_event_id", "severity",
            "last.status", "last.last_updated", "last.message", "last.arrival", "severity_arrival",
        )
    )
