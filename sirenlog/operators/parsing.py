"""Decode log messages into typed event columns and judge each on its own.

``verdict`` is the route a message takes if its id was not seen before; the
only thing left for :mod:`sirenlog.operators.routing` is the comparison with
other messages.  All of it is column expressions, so the stage is narrow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sirenlog.functions import strict_json as sj
from sirenlog.functions.timestamps import parse_iso
from sirenlog.schemas import EVENT_FIELDS

# Event kinds and the text that marks a poison message.
REPORTED = "INCIDENT_REPORTED"
ATTACHED = "ARTIFACT_ATTACHED"
POISON = "FORCE_DLQ"

# Fixed value: the largest distance from the epoch, in ms, that a date can have.
MAX_DATE_MS = 8_640_000_000_000_000

UNREADABLE = "dlq_raw"
UNPROCESSABLE = "dlq_message"
IGNORED = "ignored_type"
LOST = "lost_after_mark"
TIMELINE_ONLY = "projected_timeline_only"
FULL = "projected_full"
ARTIFACT = "projected_artifact"
DUPLICATE = "duplicate"

DEAD_ROUTES = (UNREADABLE, UNPROCESSABLE)
TIMELINE_ROUTES = (FULL, TIMELINE_ONLY)
VERDICTS = (UNREADABLE, UNPROCESSABLE, IGNORED, LOST, TIMELINE_ONLY, FULL, ARTIFACT)

_ARTIFACT_TEXTS = ("bucket", "objectKey", "originalName", "mimeType")


def event_time(kind: str, raw: str) -> str:
    """ISO text; a number counts milliseconds; null is the epoch."""
    return f"""CASE
        WHEN {kind} = '{sj.STRING}' THEN {parse_iso(raw)}
        WHEN {kind} = '{sj.NULL}' THEN timestamp_millis(0)
        WHEN {kind} = '{sj.BOOLEAN}' THEN timestamp_millis(if({raw} = 'true', 1, 0))
        WHEN {sj.is_number(kind)} AND abs(try_cast({raw} AS DOUBLE)) <= {MAX_DATE_MS}
            THEN timestamp_millis(CAST(try_cast({raw} AS DOUBLE) AS BIGINT)) END"""


def _storable_text(kind: str) -> str:
    """True when a text column accepts the value: text, null, or nothing."""
    return f"coalesce({kind} IN ('{sj.STRING}', '{sj.NULL}'), true)"


def _whole_number(kind: str, raw: str) -> str:
    """A number cut to a whole one, or the digits of one as a string."""
    return f"""CASE
        WHEN {raw} RLIKE r'{sj.INTEGER_PATTERN}' THEN try_cast({raw} AS BIGINT)
        WHEN {sj.is_number(kind)} THEN try_cast(try_cast({raw} AS DOUBLE) AS BIGINT) END"""


def parse_events(log: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Envelopes plus typed event columns, JSON kinds where they matter, and ``verdict``.

    ``columns`` names the ones wanted (default: all); ``topic``, ``partition``,
    ``offset``, ``event_id`` and ``verdict`` are always there.
    """
    event = sj.JsonObject(
        "value", EVENT_FIELDS,
        typed=[f for f in EVENT_FIELDS if f not in ("type", "artifact")],
        optional=("orgId", "serviceName"),
    )
    message_kind, message, kind = event.kind("message"), event.raw("message"), event.raw("type")
    typed = event.attach(log).selectExpr(
        *log.columns,
        # JSON null cannot be read as an event either.
        f"{event.is_valid()} AND NOT {event.is_null()} AS decodable",
        f"{event.is_null()} AS json_null",
        f"{event.string('id')} AS event_id",
        f"{event.kind('id')} AS id_kind",
        f"{event.string('incidentId')} AS incident_id",
        f"{event.kind('incidentId')} AS incident_kind",
        f"{event.raw('incidentId')} AS incident_raw",
        f"{event.string('orgId')} AS org_id",
        f"{event.string('serviceName')} AS service_name",
        f"{event.string('severity')} AS severity",
        f"{event.kind('severity')} AS severity_kind",
        f"{kind} AS event_type",
        f"{event.string('message')} AS message",
        f"{message_kind} AS message_kind",
        f"""coalesce(CASE
            WHEN {message_kind} = '{sj.STRING}' THEN contains({message}, '{POISON}')
            WHEN {sj.is_array(message_kind)} THEN array_contains(from_json({message}, 'array<string>'), '{POISON}')
            END, false) AS poison""",
        f"{event_time(event.kind('timestamp'), event.raw('timestamp'))} AS event_timestamp",
        f"CASE WHEN {kind} = '{ATTACHED}' THEN {event.raw('artifact')} END AS artifact_json",
    )
    descriptor = sj.JsonObject(
        "artifact_json", (*_ARTIFACT_TEXTS, "size"), optional=(*_ARTIFACT_TEXTS, "size"), integers=("size",)
    )
    size = _whole_number(descriptor.kind("size"), descriptor.raw("size"))
    storable = [_storable_text(descriptor.kind(name)) for name in _ARTIFACT_TEXTS]
    storable.append(f"(coalesce({descriptor.kind('size')} = '{sj.NULL}', true) OR ({size}) IS NOT NULL)")
    texts = ", ".join(f"{descriptor.string(name)} AS {name}" for name in _ARTIFACT_TEXTS)

    judged = (
        descriptor.attach(typed)
        .selectExpr(
            *typed.columns[:-1],
            # A descriptor that is no object has no fields, which is allowed.
            f"""CASE WHEN {descriptor.is_object()} THEN {' AND '.join(storable)}
                ELSE artifact_json IS NOT NULL END AS artifact_storable""",
            f"CASE WHEN artifact_json IS NOT NULL THEN struct({texts}, {size} AS size) END AS artifact",
        )
        .selectExpr("*", f"{_VERDICT} AS verdict")
    )
    kept = judged.columns if columns is None else [
        c for c in judged.columns if c in {*columns, "topic", "partition", "offset", "event_id", "verdict"}
    ]
    # A filter on ``verdict`` must not parse the text again.
    return sj.evaluated_once(judged, kept)


_KEYED = "(coalesce(incident_id, '') <> '' AND event_timestamp IS NOT NULL)"
_HEALTH_KEYED = "(coalesce(org_id, '') <> '' AND service_name IS NOT NULL)"

# First match wins.
_VERDICT = f"""CASE
    WHEN NOT decodable THEN '{UNREADABLE}'
    WHEN NOT coalesce(message_kind = '{sj.STRING}' OR {sj.is_array("message_kind")}, false) OR poison
        THEN '{UNPROCESSABLE}'
    WHEN event_id IS NULL THEN '{UNPROCESSABLE}'
    WHEN event_type = '{REPORTED}' THEN CASE
        WHEN NOT {_KEYED} OR message IS NULL THEN '{LOST}'
        WHEN NOT {_HEALTH_KEYED} OR NOT {_storable_text("severity_kind")} THEN '{TIMELINE_ONLY}'
        ELSE '{FULL}' END
    WHEN event_type = '{ATTACHED}' THEN CASE
        WHEN NOT {_KEYED} OR NOT artifact_storable THEN '{LOST}'
        ELSE '{ARTIFACT}' END
    ELSE '{IGNORED}' END"""


def reaches_mark(verdict: Column | None = None) -> Column:
    """True for messages whose id is recorded, whatever happens to them afterwards."""
    verdict = F.col("verdict") if verdict is None else verdict
    return ~verdict.isin(*DEAD_ROUTES)
