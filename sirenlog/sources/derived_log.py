"""An incident event log derived from the ``events`` table.

The given ``events`` table is clean: unique ids, unique and increasing
timestamps, no nulls.  The rules below turn each of its rows into one log
message and inject, by arithmetic on the event id, every defect the pipeline
must handle: duplicate ids, out-of-order event times, absent and null fields,
poison messages, truncated JSON and null values.  The rules are narrow column
expressions, so the same function serves batch and streaming reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sirenlog.functions.timestamps import iso_millis

EVENT_TOPIC = "incident-events"
EVENTS_DDL = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _every(n: int, remainder: int) -> Column:
    return F.col("event_id") % n == remainder


def _quoted(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))


def log_from_events(events: DataFrame) -> DataFrame:
    """``events`` rows as log envelopes (topic, partition, offset, key, value, headers)."""
    o = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    incident = F.concat(F.lit("inc-"), F.col("user_id").cast("string"))
    event_id = F.concat(F.lit("evt-"), F.when(_every(10, 9), o - 1).otherwise(o).cast("string"))
    severity = (
        F.when(F.col("value") >= 150, "CRITICAL")
        .when(F.col("value") >= 60, "HIGH")
        .when(F.col("value") >= 20, "MEDIUM")
        .otherwise("LOW")
    )
    kind = (
        F.when(F.col("event_type") == "purchase", "ARTIFACT_ATTACHED")
        .when(F.col("event_type") == "view", "INCIDENT_NOTE")
        .otherwise("INCIDENT_REPORTED")
    )
    message = F.concat(
        F.when(_every(97, 5), "FORCE_DLQ ").otherwise(""),
        F.col("event_type"), F.lit(" k="), k.cast("string"),
    )
    event_time = F.col("ts").cast("timestamp") - F.make_dt_interval(hours=(o % 4 * 6).cast("int"))
    artifact = F.concat(
        F.lit('"artifact":{"bucket":"incident-artifacts",'),
        _quoted("objectKey", F.concat(
            incident, F.lit("/"), o.cast("string"), F.lit("-file-"), k.cast("string"), F.lit(".log"))),
        F.lit(","),
        _quoted("originalName", F.concat(F.lit("file "), k.cast("string"), F.lit(".log"))),
        F.lit(',"mimeType":"text/plain","size":'),
        F.round(F.col("value") * 100).cast("bigint").cast("string"),
        F.lit("}"),
    )
    # concat_ws skips nulls, so a null part is an absent field.
    body = F.concat(
        F.lit("{"),
        F.concat_ws(
            ",",
            _quoted("id", event_id),
            _quoted("incidentId", incident),
            F.when(~_every(53, 4), _quoted("orgId", F.concat(F.lit("org-"), (F.col("user_id") % 5).cast("string")))),
            _quoted("serviceName", F.concat(F.lit("svc-"), (k % 7).cast("string"))),
            F.when(_every(4, 1), None).when(_every(11, 6), '"severity":null').otherwise(_quoted("severity", severity)),
            _quoted("type", kind),
            F.when(~_every(89, 8), _quoted("message", message)),
            _quoted("timestamp", F.when(_every(113, 10), "not-a-time").otherwise(iso_millis(event_time))),
            F.when((kind == "ARTIFACT_ATTACHED") & ~_every(41, 2), artifact),
        ),
        F.lit("}"),
    )
    value = (
        F.when(_every(211, 7), None)
        .when(_every(101, 3), F.concat(F.lit("{"), _quoted("id", event_id), F.lit(',"incidentId":')))
        .when(_every(307, 11), "null")
        .otherwise(body)
    )
    return events.select(
        F.lit(EVENT_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        o.alias("offset"),
        incident.alias("key"),
        value.alias("value"),
        F.create_map().cast("map<string,string>").alias("headers"),
    )
