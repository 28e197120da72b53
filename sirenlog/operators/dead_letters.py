"""Dead-letter records and messages, and their bounded replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sirenlog.functions import strict_json as sj
from sirenlog.operators.numbering import numbered, part_offsets, parts_of
from sirenlog.operators.parsing import DEAD_ROUTES, UNREADABLE
from sirenlog.schemas import DEAD_LETTERS, ENVELOPE, STORED_DEAD_LETTERS

# Topics, attempts, the replay marker and the recorded errors.
EVENT_TOPIC = "incident-events"
DEAD_LETTER_TOPIC = "incident-events-dlq"
UNKNOWN_INCIDENT = "unknown"
ATTEMPTS = 3
REPLAY_HEADER = "replayedFromDlq"
NULL_VALUE = "Cannot read properties of null (reading 'toString')"
NULL_DOCUMENT = "Cannot read properties of null (reading 'id')"
ABSENT_MESSAGE = "Cannot read properties of undefined (reading 'includes')"
NULL_MESSAGE = "Cannot read properties of null (reading 'includes')"
WRONG_MESSAGE = "event.message.includes is not a function"
FORCED = "Forced failure for DLQ test"
# Ours: where a replayed message was first read, so that its own dead letters lead back to it,
# and which replay it is, from the second on.
ORIGIN_HEADER = "replayOrigin"
ATTEMPT_HEADER = "replayAttempt"
MAX_REPLAYS = 3  # ours too: a message that fails after so many replays is not replayed again
# These two depend on a JSON engine and a database driver, so the words are ours.
INVALID_JSON = "value is not valid JSON"
WRONG_ID = "message id is missing or not a string"

INPUT = (
    "topic", "value", "headers", "json_null", "incident_kind", "incident_raw", "message_kind", "poison",
)


_ERROR = f"""CASE
    WHEN value IS NULL THEN "{NULL_VALUE}"
    WHEN json_null THEN "{NULL_DOCUMENT}"
    WHEN verdict = '{UNREADABLE}' THEN "{INVALID_JSON}"
    WHEN poison THEN "{FORCED}"
    WHEN message_kind IS NULL THEN "{ABSENT_MESSAGE}"
    WHEN message_kind = '{sj.NULL}' THEN "{NULL_MESSAGE}"
    WHEN message_kind = '{sj.STRING}' OR {sj.is_array("message_kind")} THEN "{WRONG_ID}"
    ELSE "{WRONG_MESSAGE}" END"""


def _place(topic: str, partition: str, offset: str) -> str:
    """A position as text; null when any part is."""
    return f"concat({topic}, '/', CAST({partition} AS STRING), '/', CAST({offset} AS STRING))"


# Of a message: the position it was first read at, and how many replays brought it.
ORIGIN = f"coalesce(headers['{ORIGIN_HEADER}'], {_place('topic', 'partition', 'offset')})"
ATTEMPT = f"""CASE WHEN headers['{ORIGIN_HEADER}'] IS NULL THEN 0
    ELSE coalesce(try_cast(headers['{ATTEMPT_HEADER}'] AS INT), 1) END"""


def _failed(parsed: DataFrame, failed_at: Column) -> DataFrame:
    return (
        parsed.filter(F.col("verdict").isin(*DEAD_ROUTES))
        .withColumn("failedAt", failed_at)
        .selectExpr(
            f"""CASE WHEN verdict = '{UNREADABLE}' THEN '{UNKNOWN_INCIDENT}'
                WHEN incident_kind <> '{sj.NULL}' THEN incident_raw END AS incidentId""",
            "failedAt",
            f"if(verdict = '{UNREADABLE}', 0, {ATTEMPTS}) AS retryCount",
            f"{_ERROR} AS errorMessage",
            "topic AS originalTopic",
            "partition AS originalPartition",
            "CAST(offset AS STRING) AS originalOffset",
            # The message is valid JSON text, so it can be carried as it came.
            f"if(verdict = '{UNREADABLE}', NULL, value) AS originalMessage",
            f"if(verdict = '{UNREADABLE}', value, NULL) AS originalRawValue",
            f"verdict = '{UNREADABLE}' AS unreadable",
            "incident_kind", "incident_raw", f"{ORIGIN} AS origin", f"{ATTEMPT} AS attempt",
        )
    )


def dead_letter_records(parsed: DataFrame, failed_at: Column) -> DataFrame:
    """One row per dead letter; needs the ``INPUT`` columns of the parsed log."""
    return _failed(parsed, failed_at).select(DEAD_LETTERS.fieldNames())


def stored_dead_letters(parsed: DataFrame, failed_at: Column) -> DataFrame:
    """The same with ``origin`` and ``attempt``, as the tables keep them: replay then needs no look at the log."""
    return _failed(parsed, failed_at).select(STORED_DEAD_LETTERS.fieldNames())


def dead_letter_messages(parsed: DataFrame, failed_at: Column) -> DataFrame:
    """The same as keyed JSON messages: absent fields are left out, a null raw value is kept."""
    shared = "failedAt, retryCount, errorMessage, originalTopic, originalPartition, originalOffset"
    with_message = sj.splice(f"to_json(struct({shared}))", "originalMessage", "originalMessage")
    truthy = sj.is_truthy("incident_kind", "incident_raw")
    return (
        _failed(parsed, failed_at)
        .selectExpr("*", f"{sj.as_json('incident_kind', 'incident_raw')} AS incident", f"{with_message} AS whole")
        .selectExpr(
            f"'{DEAD_LETTER_TOPIC}' AS topic",
            f"""coalesce(nullif(CASE WHEN NOT unreadable AND {truthy}
                THEN {sj.as_key('incident_kind', 'incident_raw')} END, ''), '{UNKNOWN_INCIDENT}') AS key""",
            f"""CASE
                WHEN unreadable THEN to_json(
                    struct(incidentId, {shared}, originalRawValue), map('ignoreNullFields', 'false'))
                WHEN incident IS NULL THEN whole
                ELSE concat('{{"incidentId":', incident, ',', substring(whole, 2)) END AS value""",
            "CAST(map() AS map<string,string>) AS headers",
        )
    )


def numbered_messages(messages: DataFrame) -> DataFrame:
    """Dead-letter messages as envelopes of a file log of their own, numbered from 0; a broker would number them."""
    group, order = ["topic", "partition"], [F.asc("value")]
    parts = parts_of(messages.withColumn("partition", F.lit(0)), group, order)
    ranked = numbered(parts, part_offsets(parts, group), group, order, "rank")
    return ranked.withColumn("offset", F.col("rank") - 1).select(*ENVELOPE.fieldNames())


def read_dead_letters(messages: DataFrame) -> DataFrame:
    """Dead-letter messages back to table rows.

    The original message is taken as JSON text.  ``get_json_object`` unquotes
    strings, so a string original is quoted again.
    """
    scalar_fields = [f for f in DEAD_LETTERS.fields if f.name != "originalMessage"]
    ddl = ",".join(f"{f.name} {f.dataType.simpleString()}" for f in scalar_fields)
    original = F.try_variant_get(F.try_parse_json("value"), "$.originalMessage", "variant")
    rows = (
        messages.select(
            F.from_json("value", ddl).alias("record"),
            F.schema_of_variant(original).alias("kind"),
            F.get_json_object("value", "$.originalMessage").alias("text"),
        )
        .withColumn(
            "originalMessage",
            F.when(F.col("kind") == sj.NULL, "null")
            .when(F.col("kind") == sj.STRING, F.expr(sj.quoted("text")))
            .otherwise(F.col("text")),
        )
        .select("record.*", "originalMessage")
    )
    return sj.evaluated_once(rows, DEAD_LETTERS.fieldNames())


def _judged(records: DataFrame) -> DataFrame:
    """Records with ``replayable``, ``origin`` and ``attempt``; records that lack the last two are first failures."""
    origin = "origin" if "origin" in records.columns else "CAST(NULL AS STRING)"
    attempt = "coalesce(attempt, 0)" if "attempt" in records.columns else "0"
    text = "trim(originalMessage)"
    rest = [c for c in records.columns if c not in ("origin", "attempt")]
    judged = (
        records.selectExpr("*", "try_parse_json(originalMessage) AS document")
        .selectExpr(
            "*", "schema_of_variant(document) AS kind",
            "schema_of_variant(try_variant_get(document, '$.incidentId', 'variant')) AS incident_kind",
            "get_json_object(originalMessage, '$.incidentId') AS incident_raw",
        )
        .selectExpr(
            *rest, "incident_kind", "incident_raw",
            f"""coalesce(CASE WHEN kind = '{sj.STRING}' THEN {text} <> '""'
                ELSE {sj.is_truthy("kind", text)} END, false) AS replayable""",
            f"coalesce({origin}, {_place('originalTopic', 'originalPartition', 'originalOffset')}) AS origin",
            f"{attempt} AS attempt",
        )
    )
    return sj.evaluated_once(judged)


def replay_messages(records: DataFrame, replayed: DataFrame | None = None, most: int = MAX_REPLAYS) -> DataFrame:
    """Log messages for the replayable dead letters: those with a truthy original message.

    A bounded snapshot with one copy per original position, however often it
    was dead-lettered; records without a position are all kept.
    ``source_topic``, ``partition`` and ``source_offset`` keep the lineage, and headers the
    first position of all and the number of the replay.  A message that failed
    after ``most`` replays is left out, and so is one whose next replay is
    already among ``replayed``, (``origin``, ``attempt``) rows of earlier ones.
    """
    replayable = _judged(records).filter("replayable")
    columns = ["originalTopic", "originalPartition", "originalOffset", "originalMessage", "incident_kind", "incident_raw"]
    # Of an origin's failures the last one counts; the aggregate leaves one row of it per map task.
    last = replayable.filter("origin IS NOT NULL").groupBy("origin").agg(
        F.max_by(F.struct("attempt", *columns), F.struct("attempt", "originalOffset", "originalTopic")).alias("last")
    ).select("origin", "last.*")
    due = last.filter(F.col("attempt") < most)
    if replayed is not None:
        again = replayed.select("origin", (F.col("attempt") - 1).alias("attempt")).distinct()
        due = due.join(again, ["origin", "attempt"], "left_anti")
    # Records without a position cannot be told apart and have no history.
    loose = replayable.filter("origin IS NULL").select("origin", "attempt", *columns)
    return due.unionByName(loose).selectExpr(
        f"'{EVENT_TOPIC}' AS topic",
        "originalTopic AS source_topic",
        "coalesce(originalPartition, 0) AS partition",
        "CAST(originalOffset AS BIGINT) AS source_offset",
        f"{sj.as_key('incident_kind', 'incident_raw')} AS key",
        "originalMessage AS value",
        f"""map_filter(map('{REPLAY_HEADER}', 'true', '{ORIGIN_HEADER}', origin,
            '{ATTEMPT_HEADER}', CASE WHEN attempt > 0 THEN CAST(attempt + 1 AS STRING) END),
            (k, v) -> v IS NOT NULL) AS headers""",
    )


def replay_rows(messages: DataFrame) -> DataFrame:
    """(``origin``, ``attempt``) of replayed messages, to be kept as the record of a replay."""
    return messages.selectExpr(f"headers['{ORIGIN_HEADER}'] AS origin", f"{ATTEMPT} AS attempt").filter("origin IS NOT NULL")


# What became of a dead letter.
NOT_REPLAYABLE, PENDING, REPLAYED, EXHAUSTED = "not_replayable", "pending", "replayed", "exhausted"


def replay_report(records: DataFrame, replayed: DataFrame, most: int = MAX_REPLAYS) -> DataFrame:
    """One row per original: ``origin``, ``replays`` so far and ``status``.

    ``exhausted`` failed after its last replay and will not be replayed again;
    ``pending`` waits for its next replay; ``replayed`` was replayed and has not
    failed since; ``not_replayable`` holds no message.
    """
    failures = _judged(records).filter("origin IS NOT NULL").groupBy("origin").agg(
        F.max("attempt").alias("failed"), F.max("replayable").alias("replayable"))
    replays = replayed.groupBy("origin").agg(F.max("attempt").alias("replays"))
    status = (F.when(~F.col("replayable"), NOT_REPLAYABLE).when(F.col("failed") >= most, EXHAUSTED)
              .when(F.coalesce("replays", F.lit(0)) > F.col("failed"), REPLAYED).otherwise(PENDING))
    return failures.join(replays, "origin", "left").select(
        "origin", F.greatest("failed", F.coalesce("replays", F.lit(0))).cast("int").alias("replays"), status.alias("status"))


def replay_order() -> list[Column]:
    """Replayed messages in the order of their sources."""
    return [F.asc_nulls_last("source_offset"), F.asc_nulls_last("source_topic"), F.asc("value")]


def numbered_replay(log: DataFrame, replay: DataFrame) -> DataFrame:
    """Replayed messages as envelopes that follow the last offset of their topic and partition.

    A broker would number them; here they are numbered without gaps, in the
    order of their sources, however many topics those are.
    """
    group, order = ["topic", "partition"], replay_order()
    parts = parts_of(replay, group, order)
    ranked = numbered(parts, part_offsets(parts, group), group, order, "rank")
    last = log.groupBy(*group).agg(F.max("offset").alias("last"))
    return ranked.join(last, group, "left").withColumn(
        "offset", F.coalesce("last", F.lit(-1)) + F.col("rank")).select(*ENVELOPE.fieldNames())


def append_replay(log: DataFrame, replay: DataFrame) -> DataFrame:
    """The log followed by the replayed messages."""
    return log.unionByName(numbered_replay(log, replay))
