"""Schemas of the log, the stored tables and the structured replies."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    BooleanType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_TEXT, _LONG, _INT, _TIME = StringType(), LongType(), IntegerType(), TimestampType()

ENVELOPE = _struct(
    topic=_TEXT, partition=_INT, offset=_LONG, key=_TEXT, value=_TEXT,
    headers=MapType(_TEXT, _TEXT),
)

ARTIFACT = _struct(bucket=_TEXT, objectKey=_TEXT, originalName=_TEXT, mimeType=_TEXT, size=_LONG)

# Field names of an event, in message order.
EVENT_FIELDS = (
    "id", "incidentId", "orgId", "serviceName", "severity", "type", "message", "timestamp", "artifact",
)

DEAD_LETTERS = _struct(
    incidentId=_TEXT, failedAt=_TEXT, retryCount=_INT, errorMessage=_TEXT,
    originalTopic=_TEXT, originalPartition=_INT, originalOffset=_TEXT,
    originalMessage=_TEXT, originalRawValue=_TEXT,
)

# As the tables keep them: where the message was first read, and how many replays brought it.
STORED_DEAD_LETTERS = StructType([*DEAD_LETTERS.fields, *_struct(origin=_TEXT, attempt=_INT).fields])

REPLAYS = _struct(origin=_TEXT, attempt=_INT)

TIMELINE = _struct(
    incident_id=_TEXT, event_timestamp=_TIME, event_id=_TEXT, event_type=_TEXT, message=_TEXT,
)

# Per incident and file of the timeline: how many events, from when to when, and how many without a time.
TIMELINE_INDEX = _struct(incident_id=_TEXT, file=_TEXT, n=_LONG, oldest=_TIME, newest=_TIME, undated=_LONG)

LEDGER = _struct(consumer_group=_TEXT, message_id=_TEXT, processed_at=_TIME)

ARRIVAL = _struct(batch_id=_LONG, partition=_INT, offset=_LONG)

# One folded row per service and batch.  The two arrival columns make the fold
# repeatable; ``severity_arrival`` is null when no folded message had the field.
HEALTH_CHANGES = _struct(
    org_id=_TEXT, service_name=_TEXT, latest_incident_id=_TEXT, latest_event_id=_TEXT,
    severity=_TEXT, status=_TEXT, last_updated=_TIME, message=_TEXT,
    arrival=ARRIVAL, severity_arrival=ARRIVAL,
)

ARTIFACTS = _struct(
    incident_id=_TEXT, uploaded_at=_TIME, artifact_id=_TEXT, bucket=_TEXT, object_key=_TEXT,
    original_name=_TEXT, mime_type=_TEXT, size_bytes=_LONG,
)

ARTIFACT_CONTENT = _struct(object_key=_TEXT, mime_type=_TEXT, content=BinaryType())

SUMMARY_REQUEST = _struct(
    request_id=_TEXT, incident_id=_TEXT, org_id=_TEXT, limit=DoubleType(), limit_given=BooleanType(),
)

SUMMARY = _struct(
    summary=_TEXT, customer_impact=_TEXT, likely_root_cause=_TEXT, confidence=_TEXT,
    next_actions=ArrayType(_TEXT), signals=ArrayType(_TEXT),
)
