"""Inputs of the registered queries, derived by Spark from the given tables.

Every input is computed from all rows of its table, by arithmetic on ids, so
that each rule also has a plain SQL form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sirenlog.operators.parsing import parse_events
from sirenlog.operators.projections import (
    ARTIFACT_INPUT,
    HEALTH_INPUT,
    TIMELINE_INPUT,
    artifact_rows,
    fold_health,
    health_changes,
    timeline_rows,
)
from sirenlog.operators.routing import CONSUMER_GROUP, first_deliveries
from sirenlog.session import configure, stored
from sirenlog.sources.derived_log import log_from_events, read_events

FIXED_TIME = "2026-01-01T00:00:00.000Z"


def fixed_time() -> Column:
    return F.lit(FIXED_TIME).cast("timestamp")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_from_events(_events(spark, sf_dir))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events dealt over the session's partitions, as a log of many partitions would be.

    The given table is one row group, which no scan can split; the narrow rows
    are dealt before any text is made of them, in the same way at every size.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read_events(configure(spark), sf_dir).repartition(parts, "event_id")


def parsed_log(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    return parse_events(event_log(spark, sf_dir), columns)


class Projected:
    """Timeline, health and artifacts of one log, from one parse and one first-seen pass, stored once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        columns = tuple(dict.fromkeys((*TIMELINE_INPUT, *HEALTH_INPUT, *ARTIFACT_INPUT)))
        first = first_deliveries(parsed_log(spark, sf_dir, columns), columns)
        self.first = stored(first, "first-deliveries")

    def timeline(self) -> DataFrame:
        return timeline_rows(self.first)

    def artifacts(self) -> DataFrame:
        return artifact_rows(self.first)

    def health(self) -> DataFrame:
        return fold_health(health_changes(self.first))


def stored_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position, id and verdict of every message, parsed once and stored."""
    return stored(parsed_log(spark, sf_dir, ("topic",)), "parsed-log")


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline_rows(first_deliveries(parsed_log(spark, sf_dir, TIMELINE_INPUT), TIMELINE_INPUT))


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return artifact_rows(first_deliveries(parsed_log(spark, sf_dir, ARTIFACT_INPUT), ARTIFACT_INPUT))


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = first_deliveries(parsed_log(spark, sf_dir, HEALTH_INPUT), HEALTH_INPUT)
    return fold_health(health_changes(first))


def earlier_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger from an earlier run that handled the larger purchases."""
    events = read_events(configure(spark), sf_dir)
    return events.filter((F.col("event_type") == "purchase") & (F.col("value") >= 100)).select(
        F.lit(CONSUMER_GROUP).alias("consumer_group"),
        F.concat(F.lit("evt-"), F.col("event_id").cast("string")).alias("message_id"),
        fixed_time().alias("processed_at"),
    )


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _mod(name: str, n: int, remainder: int) -> Column:
    return F.col(name) % n == remainder


def summary_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per user: unknown incidents, absent organisations and all kinds of limits."""
    u = F.col("user_id")
    users = read_events(configure(spark), sf_dir).select("user_id").distinct()
    return users.select(
        _text("req-", u).alias("request_id"),
        F.when(_mod("user_id", 31, 4), "").when(_mod("user_id", 29, 3), _text("inc-none-", u))
        .otherwise(_text("inc-", u)).alias("incident_id"),
        F.when(_mod("user_id", 3, 0), None).when(_mod("user_id", 7, 1), "org-none")
        .otherwise(_text("org-", u % 5)).alias("org_id"),
        F.when(_mod("user_id", 8, 1), 3.0).when(_mod("user_id", 8, 2), 0.0).when(_mod("user_id", 8, 3), -1.0)
        .when(_mod("user_id", 8, 5), 2.9).when(_mod("user_id", 8, 6), 20.0).when(_mod("user_id", 8, 7), 1500.0)
        .alias("limit"),
        (u % 8 != 0).alias("limit_given"),
    )


def summary_replies(spark: SparkSession, sf_dir: str, shape: str = "summary") -> DataFrame:
    """One reply per event, sound or broken in one of eleven ways."""
    events = _events(spark, sf_dir)
    o = F.col("event_id")
    k = F.get_json_object("props", "$.k")
    camel = shape == "graphql"
    name = lambda snake, other: other if camel else snake
    defect = lambda n, value: (o % 12 == n, value)

    def field(key: str, sound, *defects) -> Column:
        value = None
        for condition, text in defects:
            text = F.lit(text) if isinstance(text, str) or text is None else text
            value = F.when(condition, text) if value is None else value.when(condition, text)
        sound = sound if isinstance(sound, Column) else F.lit(sound)
        value = sound if value is None else value.otherwise(sound)
        return F.concat(F.lit(f'"{key}":'), value)

    fields = [
        field("summary", _text('"', F.col("event_type"), " number ", k, '"'),
              defect(1, None), defect(2, '"  "'), defect(9, "5")),
        field(name("customer_impact", "customerImpact"), '"some users"', defect(3, '""')),
        field(name("likely_root_cause", "likelyRootCause"), '"unknown"'),
        field("confidence", F.when(F.col("value") >= 60, '"HIGH"').otherwise('"LOW"'),
              defect(4, '"SURE"'), defect(10, "null")),
        field(name("next_actions", "nextActions"), '["a","b","c"]',
              defect(5, '["a","b"]'), defect(7, '"abc"')),
        field("signals", _text('["s', k, '","t","u"]'), defect(6, '["s","t","u","v"]'), defect(11, "null")),
    ]
    if shape in ("rest", "graphql"):
        fields.insert(0, field("incidentId", _text('"inc-', F.col("user_id"), '"'), (o % 17 == 3, None)))
    if shape == "rest":
        fields.insert(0, field("ok", "true", (o % 13 == 5, "false")))
    text = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    return events.select(
        _text("reply-", o).alias("request_id"),
        _text("inc-", F.col("user_id")).alias("incident_id"),
        F.when(o % 12 == 8, F.concat(text, F.lit(" and more"))).otherwise(text).alias("reply"),
    )


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One submission body per event, with empty, falsy, null, absent and mistyped fields."""
    events = _events(spark, sf_dir)
    o = F.col("event_id")
    k = F.get_json_object("props", "$.k")
    body = F.concat(
        F.lit("{"),
        F.concat_ws(
            ",",
            F.concat(F.lit('"incidentId":'), F.when(o % 7 == 3, F.lit('""')).otherwise(_text('"inc-', F.col("user_id"), '"'))),
            F.concat(F.lit('"orgId":'), F.when(o % 19 == 7, F.lit("false")).when(o % 29 == 9, _text(F.col("user_id")))
                     .otherwise(_text('"org-', F.col("user_id") % 5, '"'))),
            F.when(o % 17 != 6, _text('"serviceName":"svc-', k.cast("int") % 7, '"')),
            F.concat(F.lit('"severity":'), F.when(o % 11 == 4, F.lit("0")).when(o % 23 == 8, F.lit("5"))
                     .otherwise(F.lit('"HIGH"'))),
            F.concat(F.lit('"message":'), F.when(o % 13 == 5, F.lit("null"))
                     .otherwise(_text('"', F.col("event_type"), '"'))),
        ),
        F.lit("}"),
    )
    return events.select(
        o.alias("submission_id"),
        F.when(o % 37 == 10, _text('"', F.col("event_type"), '"')).when(o % 41 == 11, F.lit("[]"))
        .otherwise(body).alias("body"),
        F.date_trunc("MILLISECOND", F.col("ts").cast("timestamp")).alias("received_at"),
    )


def artifact_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One upload per event, some without an incident, a file or a type, some too large."""
    events = read_events(configure(spark), sf_dir)
    o = F.col("event_id")
    k = F.get_json_object("props", "$.k")
    return events.select(
        o.alias("upload_id"),
        F.when(o % 19 == 4, None).when(o % 17 == 3, "").otherwise(_text("inc-", F.col("user_id"))).alias("incident_id"),
        F.when(o % 23 != 5, _text(F.col("event_type"), " \t", k, "\ufeff  dump.log")).alias("original_name"),
        F.when(o % 5 == 1, None).when(o % 5 == 2, "").otherwise("text/plain").alias("mime_type"),
        F.round(F.col("value") * 100000).cast("bigint").alias("size"),
        F.date_trunc("MILLISECOND", F.col("ts").cast("timestamp")).alias("received_at"),
    )


def document_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as uploaded files, whole texts as content."""
    documents = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    content = F.encode("text", "UTF-8")
    return documents.select(
        _text("inc-", F.col("doc_id") % 97).alias("incident_id"),
        _text("document ", F.col("doc_id"), ".txt").alias("original_name"),
        F.lit("text/plain").alias("mime_type"),
        F.octet_length(content).cast("bigint").alias("size"),
        fixed_time().alias("received_at"),
        F.col("doc_id").cast("string").alias("doc_id"),
        content.alias("content"),
    )
