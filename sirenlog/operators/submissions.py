"""Incident submissions: check, build the event, publish as a keyed message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sirenlog.functions import strict_json as sj
from sirenlog.functions.timestamps import iso_millis
from sirenlog.operators.parsing import REPORTED

# The input fields, in event order, and the refusal.
FIELDS = ("incidentId", "orgId", "serviceName", "severity", "message")
REQUIRED = "incidentId, orgId, serviceName, severity, and message are required"
INVALID_BODY = "body is not a JSON object"


def accept_submissions(
    submissions: DataFrame,
    mode: str = "rest",
    event_id: Column | None = None,
    received_at: Column | None = None,
) -> DataFrame:
    """Judge JSON ``body`` texts; adds ``ok``, ``error``, and the event's ``key`` and ``value``.

    ``rest`` wants five truthy fields of any type and keeps their types;
    ``graphql`` wants typed non-null fields and accepts the empty text.  Id and
    time are generated unless given; a plan that is evaluated more than once
    must be given them, or it publishes different events each time.
    """
    if mode not in ("rest", "graphql"):
        raise ValueError("mode must be 'rest' or 'graphql'")
    event_id = F.uuid() if event_id is None else event_id
    received_at = F.current_timestamp() if received_at is None else received_at
    body = sj.JsonObject("body", FIELDS)

    def accepted(name: str) -> str:
        if mode == "rest":
            return sj.is_truthy(body.kind(name), body.raw(name))
        kinds = f"'{sj.STRING}', '{sj.INTEGER}'" if name.endswith("Id") else f"'{sj.STRING}'"
        return f"coalesce({body.kind(name)} IN ({kinds}), false)"

    def written(name: str) -> str:
        return sj.as_json(body.kind(name), body.raw(name)) if mode == "rest" else sj.quoted(body.raw(name))

    complete = " AND ".join(accepted(name) for name in FIELDS)
    checked = (
        body.attach(submissions.withColumn("__id", event_id).withColumn("__time", iso_millis(received_at)))
        .selectExpr(
            *submissions.columns, "__id", "__time",
            f"{complete} AS __complete",
            # An array is a readable body without any of the fields.
            f"{body.is_object()} OR ({body.is_valid()} AND startswith(ltrim(body), '[')) AS __readable",
            f"{sj.as_key(body.kind('incidentId'), body.raw('incidentId'))} AS __key",
            *[f"{written(name)} AS __{name}" for name in FIELDS],
        )
    )
    inputs = ", ".join(f"""',"{name}":', __{name}""" for name in FIELDS[:-1])
    value = f"""concat('{{"id":', {sj.quoted("__id")}, {inputs}, ',"type":"{REPORTED}","message":', __message,
        ',"timestamp":"', __time, '"}}')"""
    return checked.selectExpr(
        *submissions.columns,
        "__complete AS ok",
        f"CASE WHEN NOT __readable THEN '{INVALID_BODY}' WHEN NOT __complete THEN '{REQUIRED}' END AS error",
        "CASE WHEN __complete THEN __key END AS key",
        f"CASE WHEN __complete THEN {value} END AS value",
    )


def published(accepted: DataFrame, topic: str = "incident-events", offset: Column | None = None) -> DataFrame:
    """The accepted submissions as messages for the log.

    A broker numbers them; for a file log, ``offset`` is each message's number in partition 0.
    """
    message = [
        F.lit(topic).alias("topic"), "key", "value",
        F.create_map().cast("map<string,string>").alias("headers"),
    ]
    if offset is not None:
        message += [F.lit(0).alias("partition"), offset.cast("bigint").alias("offset")]
    # The filter would otherwise repeat the whole check below the projection.
    return sj.evaluated_once(accepted).filter("ok").select(*message)
