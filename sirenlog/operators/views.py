"""Read views over the stored tables, for one key or for all.

A key becomes a filter that reaches the Parquet scan.  The order of a view is
a range sort over unique columns, so a key with very many rows is spread over
tasks like any other data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sirenlog.functions.strict_json import evaluated_once
from sirenlog.functions.text import percent_decode
from sirenlog.functions.timestamps import iso_millis

DOWNLOAD_SECONDS = 900  # fixed value
MAX_INT = 2**31 - 1

# Columns that must not be null in each view, and those declared as 32-bit numbers.
TIMELINE_CONTRACT = (("id", "incidentId", "type", "message", "timestamp"), ())
HEALTH_CONTRACT = (
    ("orgId", "serviceName", "latestIncidentId", "latestEventId", "severity", "status", "lastUpdated", "message"),
    (),
)
ARTIFACT_CONTRACT = (
    ("artifactId", "incidentId", "bucket", "objectKey", "originalName", "mimeType", "sizeBytes", "uploadedAt"),
    ("sizeBytes",),
)


def _view(table: DataFrame, key: str, value: str | None, order: Sequence[Column], fields: Mapping[str, Column],
          columns: Sequence[str] | None) -> DataFrame:
    if value is not None:
        table = table.filter(F.col(key) == value)
    wanted = fields if columns is None else {name: fields[name] for name in columns}
    return table.orderBy(key, *order).select(*[column.alias(name) for name, column in wanted.items()])


def timeline_view(timeline: DataFrame, incident_id: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Events of an incident (or of all), newest first."""
    return _view(
        timeline, "incident_id", incident_id, [F.desc("event_timestamp"), F.asc("event_id")],
        {
            "id": F.col("event_id"),
            "incidentId": F.col("incident_id"),
            "type": F.col("event_type"),
            "message": F.col("message"),
            "timestamp": iso_millis(F.col("event_timestamp")),
        },
        columns,
    )


def health_view(health: DataFrame, org_id: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Current state of an organisation's services (or of all), by service name."""
    return _view(
        health, "org_id", org_id, [F.asc("service_name")],
        {
            "orgId": F.col("org_id"),
            "serviceName": F.col("service_name"),
            "latestIncidentId": F.col("latest_incident_id"),
            "latestEventId": F.col("latest_event_id"),
            "severity": F.col("severity"),
            "status": F.col("status"),
            "lastUpdated": iso_millis(F.col("last_updated")),
            "message": F.col("message"),
        },
        columns,
    )


def artifacts_view(artifacts: DataFrame, incident_id: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Artifacts of an incident (or of all), newest first."""
    return _view(
        artifacts, "incident_id", incident_id, [F.desc("uploaded_at"), F.asc("artifact_id")],
        {
            "artifactId": F.col("artifact_id"),
            "incidentId": F.col("incident_id"),
            "bucket": F.col("bucket"),
            "objectKey": F.col("object_key"),
            "originalName": F.col("original_name"),
            "mimeType": F.col("mime_type"),
            "sizeBytes": F.col("size_bytes").cast("bigint"),
            "uploadedAt": iso_millis(F.col("uploaded_at")),
        },
        columns,
    )


def timeline_counts(timeline: DataFrame) -> DataFrame:
    return timeline.groupBy(F.col("incident_id").alias("incidentId")).agg(F.count(F.lit(1)).alias("events"))


def with_location(artifacts: DataFrame, requested_at: Column, bucket: str = "bucket", key: str = "objectKey") -> DataFrame:
    """Add where an object can be fetched and until when; signing is left to the store's own client."""
    expires = requested_at + F.make_dt_interval(secs=F.lit(DOWNLOAD_SECONDS))
    return artifacts.withColumn(
        "location", F.concat(F.lit("s3a://"), F.col(bucket), F.lit("/"), F.col(key))
    ).withColumn("expiresAt", iso_millis(expires))


def stored_lookup(lookups: DataFrame, artifacts: DataFrame, path: str = "path") -> DataFrame:
    """Percent-encoded object paths to the stored artifacts; ``objectKey`` is null when malformed."""
    # A store holds one object per key: of several uploads the last one counts.
    last = F.max_by(F.struct("bucket", "artifact_id", "incident_id"), F.struct("uploaded_at", "artifact_id"))
    stored = artifacts.filter(F.col("object_key").isNotNull()).groupBy(F.col("object_key").alias("objectKey")).agg(
        last.alias("last")).select(
            "objectKey", "last.bucket", F.col("last.artifact_id").alias("artifactId"),
            F.col("last.incident_id").alias("incidentId"))
    decoded = evaluated_once(lookups.withColumn("objectKey", percent_decode(F.col(path))))
    # Malformed paths have no key to join on; left in, they would all meet in one task.
    found = decoded.filter(F.col("objectKey").isNotNull()).join(stored, "objectKey", "left")
    malformed = decoded.filter(F.col("objectKey").isNull())
    return found.unionByName(malformed, allowMissingColumns=True)


def contract_violations(view: DataFrame, name: str, key: str, contract: tuple[Sequence[str], Sequence[str]]) -> DataFrame:
    """One row per view row and column that breaks the declared output types."""
    required, integers = contract
    problem = lambda column, reason: F.struct(
        F.lit(column).alias("column"), F.lit(reason).alias("reason"))
    checks = [F.when(F.col(c).isNull(), problem(c, "null")) for c in required]
    checks += [F.when(~F.col(c).between(-MAX_INT - 1, MAX_INT), problem(c, "not a 32-bit integer")) for c in integers]
    return view.select(
        F.lit(name).alias("view"), F.col(key).alias("key"), F.inline(F.array_compact(F.array(*checks)))
    )
