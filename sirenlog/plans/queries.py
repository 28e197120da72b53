"""The registered queries: each runs one operator over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sirenlog.functions import strict_json as sj
from sirenlog.functions.strict_json import evaluated_once
from sirenlog.functions.timestamps import iso_millis
from sirenlog.operators import artifacts as af
from sirenlog.operators import dead_letters as dl
from sirenlog.operators import projections as pj
from sirenlog.operators import routing
from sirenlog.operators import summaries as sm
from sirenlog.operators import views
from sirenlog.operators.parsing import parse_events
from sirenlog.operators.reply_store import ReplyStore
from sirenlog.operators.submissions import accept_submissions, published
from sirenlog.plans import inputs
from sirenlog.session import configure, shared_folder, stored
from sirenlog.sources.event_log import append_log, read_dead_letter_log, stream_log
from sirenlog.sources.outbox import Outbox
from sirenlog.streaming.pipeline import replay_report, replay_to_log, start_keyed_projection, start_projection
from sirenlog.streaming.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


@_query
def event_log_scan(spark, sf_dir):
    return inputs.event_log(spark, sf_dir).drop("headers")


@_query
def parse_log(spark, sf_dir):
    kind = F.col("severity_kind")
    return inputs.parsed_log(spark, sf_dir).select(
        "offset", "decodable", "event_id", "incident_id", "org_id", "service_name", "severity",
        F.when(kind == sj.STRING, "text").when(kind == sj.NULL, "null").alias("severity_kind"),
        "event_type", "message", iso_millis(F.col("event_timestamp")).alias("event_time"),
        F.col("artifact.objectKey").alias("object_key"), F.col("artifact.size").alias("size"),
    )


@_query
def route_events(spark, sf_dir):
    return routing.route_events(inputs.stored_parse(spark, sf_dir)).select("offset", "event_id", "route")


@_query
def route_counts(spark, sf_dir):
    return routing.route_counts(inputs.parsed_log(spark, sf_dir, ()))


@_query
def dedup_first_seen(spark, sf_dir):
    parsed = inputs.parsed_log(spark, sf_dir, ())
    ledger = inputs.earlier_ledger(spark, sf_dir)
    return routing.first_deliveries(parsed, ("offset",), ledger).withColumnRenamed("event_id", "message_id")


@_query
def message_deliveries(spark, sf_dir):
    return routing.first_positions(inputs.parsed_log(spark, sf_dir, ())).select(
        "message_id", routing.offset_of(F.col("first_position")).alias("first_offset"), "deliveries")


@_query
def processed_ledger(spark, sf_dir):
    first = routing.first_deliveries(inputs.parsed_log(spark, sf_dir, ()), ())
    return pj.ledger_rows(first, inputs.fixed_time()).withColumn("processed_at", iso_millis(F.col("processed_at")))


@_query
def dead_letters(spark, sf_dir):
    return dl.dead_letter_records(inputs.parsed_log(spark, sf_dir, dl.INPUT), F.lit(inputs.FIXED_TIME))


def _dead_letter_messages(spark, sf_dir):
    return dl.dead_letter_messages(inputs.parsed_log(spark, sf_dir, dl.INPUT), F.lit(inputs.FIXED_TIME))


@_query
def dead_letter_messages(spark, sf_dir):
    return _dead_letter_messages(spark, sf_dir).select("topic", "key", "value")


def _replay(spark, sf_dir):
    return dl.replay_messages(dl.read_dead_letters(_dead_letter_messages(spark, sf_dir)))


@_query
def dlq_replay(spark, sf_dir):
    return _replay(spark, sf_dir).select(
        "topic", "source_offset", "key", "value", F.col("headers")[dl.REPLAY_HEADER].alias("replayed"))


@_query
def replay_reprocess(spark, sf_dir):
    """The log and its replayed dead letters, routed together; each message is parsed once."""
    parsed = stored(inputs.parsed_log(spark, sf_dir, dl.INPUT), "parsed-log")
    messages = dl.dead_letter_messages(parsed, F.lit(inputs.FIXED_TIME))
    replay = dl.replay_messages(dl.read_dead_letters(messages))
    again = stored(parse_events(dl.numbered_replay(parsed, replay), dl.INPUT), "parsed-replay")
    return routing.route_events(parsed.unionByName(again)).select(
        "offset", F.col("headers")[dl.REPLAY_HEADER].alias("replayed"), "event_id", "route")


@_query
def replay_attempts(spark, sf_dir):
    """The log projected and its dead letters replayed until no replay is due; what became of each."""
    folder = f"{shared_folder(configure(spark))}/replay-attempts-{uuid.uuid4()}"
    log, tables = inputs.event_log(spark, sf_dir), Tables(spark, f"{folder}/tables")
    Outbox(spark, f"{folder}/log").publish("events", log, [F.asc("offset")])
    for _ in range(dl.MAX_REPLAYS + 2):
        start_projection(
            stream_log(spark, f"{folder}/log"), tables.root, f"{folder}/checkpoint", processed_at=inputs.fixed_time()
        ).awaitTermination()
        replay_to_log(spark, tables, f"{folder}/log")
    return replay_report(tables)


@_query
def incident_timeline(spark, sf_dir):
    return views.timeline_view(inputs.timeline(spark, sf_dir))


@_query
def timeline_counts(spark, sf_dir):
    return views.timeline_counts(inputs.timeline(spark, sf_dir))


@_query
def service_health_current(spark, sf_dir):
    return inputs.health(spark, sf_dir).select(
        "org_id", "service_name", "latest_incident_id", "latest_event_id", "severity", "status",
        iso_millis(F.col("last_updated")).alias("last_updated"), "message",
        F.col("arrival.offset").alias("last_offset"))


@_query
def service_health_null_severity(spark, sf_dir):
    """The variant in which an absent severity erases the stored one."""
    parsed = inputs.parsed_log(spark, sf_dir, pj.HEALTH_INPUT)
    first = routing.first_deliveries(parsed, pj.HEALTH_INPUT)
    return pj.fold_health(pj.health_changes(first, missing="null")).select(
        "org_id", "service_name", "latest_event_id", "severity", "status")


@_query
def service_health_by_org(spark, sf_dir):
    return views.health_view(inputs.health(spark, sf_dir))


@_query
def incident_artifacts(spark, sf_dir):
    return views.artifacts_view(inputs.artifacts(spark, sf_dir))


@_query
def artifact_locations(spark, sf_dir):
    view = views.artifacts_view(inputs.artifacts(spark, sf_dir))
    return views.with_location(view, inputs.fixed_time()).select(
        "artifactId", "incidentId", "location", "expiresAt")


@_query
def stored_artifact_lookup(spark, sf_dir):
    """Each stored key as an encoded path; every 29th event's path is malformed or unknown."""
    stored = inputs.artifacts(spark, sf_dir)
    number = F.substring_index(F.element_at(F.split("artifact_id", "-"), -1), "-", 1).cast("bigint")
    encoded = F.replace(F.col("object_key"), F.lit("/"), F.lit("%2F"))
    lookups = stored.filter(F.col("object_key").isNotNull()).select(
        F.when(number % 29 == 6, F.concat(encoded, F.lit("%E0%A4")))
        .when(number % 29 == 8, F.concat(encoded, F.lit("+%20copy")))
        .otherwise(encoded).alias("path"))
    return views.stored_lookup(lookups, stored).select("path", "objectKey", "bucket", "artifactId", "incidentId")


@_query
def contract_violations(spark, sf_dir):
    rows = inputs.Projected(spark, sf_dir)
    checked = [
        ("incidentTimeline", "id", views.timeline_view(rows.timeline()), views.TIMELINE_CONTRACT),
        ("serviceHealthByOrg", "latestEventId", views.health_view(rows.health()), views.HEALTH_CONTRACT),
        ("incidentArtifacts", "artifactId", views.artifacts_view(rows.artifacts()), views.ARTIFACT_CONTRACT),
    ]
    parts = [views.contract_violations(view, name, key, contract) for name, key, view, contract in checked]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@_query
def recent_events(spark, sf_dir):
    recent = sm.recent_events(inputs.timeline(spark, sf_dir), inputs.summary_requests(spark, sf_dir))
    return recent.withColumn("event_timestamp", iso_millis(F.col("event_timestamp")))


@_query
def recent_events_stored(spark, sf_dir):
    """The same from the stored timeline, through its position index."""
    tables = Tables(spark, f"{shared_folder(configure(spark))}/recent-{uuid.uuid4()}")
    tables.write("timeline", 0, stored(inputs.timeline(spark, sf_dir), "timeline"))
    tables.write("outcomes", 0, spark.createDataFrame([("projected", 1)], "route string, n bigint"))
    recent = tables.recent_events(inputs.summary_requests(spark, sf_dir))
    return recent.withColumn("event_timestamp", iso_millis(F.col("event_timestamp")))


@_query
def stored_health_by_org(spark, sf_dir):
    """One organisation's services, the one with the first name, from compacted state and the changes since."""
    tables = Tables(spark, f"{shared_folder(configure(spark))}/health-{uuid.uuid4()}")
    changes = stored(pj.health_changes(inputs.Projected(spark, sf_dir).first), "health-changes")
    last = changes.agg(F.max("arrival.offset")).first()[0]
    for batch in range(3):
        part = F.floor(F.col("arrival.offset") * 3 / (last + 1)) == batch
        tables.write("health_changes", batch, pj.fold_health(changes.filter(part)))
        tables.write("outcomes", batch, spark.createDataFrame([("projected", 1)], "route string, n bigint"))
    tables.compact("health_changes")
    key = tables.read("health_changes").agg(F.min("org_id")).first()[0]
    return views.health_view(tables.health(key))


@_query
def summary_requests(spark, sf_dir):
    return sm.request_status(inputs.summary_requests(spark, sf_dir), inputs.timeline(spark, sf_dir)).select(
        "request_id", "incident_id", "events", "status")


@_query
def requests_not_found(spark, sf_dir):
    return sm.not_found(inputs.summary_requests(spark, sf_dir), inputs.timeline(spark, sf_dir)).select(
        "request_id", "incident_id")


def _context(spark, sf_dir):
    rows, requests = inputs.Projected(spark, sf_dir), inputs.summary_requests(spark, sf_dir)
    return sm.summary_context(requests, sm.recent_events(rows.timeline(), requests), rows.health())


@_query
def summary_context(spark, sf_dir):
    return _context(spark, sf_dir)


@_query
def summary_prompts(spark, sf_dir):
    return sm.summary_prompts(_context(spark, sf_dir))


@_query
def summarize_incidents(spark, sf_dir):
    replies = sm.generate_summaries(sm.summary_prompts(_context(spark, sf_dir)))
    return _flat(sm.parse_summaries(replies)).drop("reply", "error")


def _failing_generator():
    """The stand-in, but every seventh incident's prompt is refused."""
    reply = sm.offline_generator()

    def generate(prompts):
        for prompt in prompts:
            incident = next(x for x in prompt.split("\n") if x.startswith("Incident ID: "))[len("Incident ID: "):]
            if int(incident.rpartition("-")[2]) % 7 == 0:
                raise ValueError(f"no reply for {incident}")
        return reply(prompts)

    return generate


@_query
def summarize_with_failures(spark, sf_dir):
    replies = sm.generate_summaries(sm.summary_prompts(_context(spark, sf_dir)), _failing_generator)
    return sm.parse_summaries(replies).select("request_id", "incident_id", "decoded", "error", "confidence")


@_query
def summarize_incidents_stored(spark, sf_dir):
    """Replies through the store: a run in which some prompts fail, then one that asks only for those."""
    prompts = stored(sm.summary_prompts(_context(spark, sf_dir)), "prompts")
    store = ReplyStore(spark, f"{shared_folder(configure(spark))}/replies-{uuid.uuid4()}")
    store.generate(prompts, _failing_generator)
    return _flat(sm.parse_summaries(store.generate(prompts))).drop("reply", "error")


def _flat(parsed: DataFrame) -> DataFrame:
    """Lists as one text each."""
    return parsed.withColumns({
        name: F.array_join(name, "|") for name in ("next_actions", "signals") if name in parsed.columns})


@_query
def parse_summaries(spark, sf_dir):
    return _flat(sm.parse_summaries(inputs.summary_replies(spark, sf_dir))).drop("reply")


@_query
def summary_graphql_view(spark, sf_dir):
    parsed = _flat(sm.parse_summaries(inputs.summary_replies(spark, sf_dir))).filter("decoded")
    return sm.graphql_summary(parsed)


@_query
def summary_rest_view(spark, sf_dir):
    parsed = _flat(sm.parse_summaries(inputs.summary_replies(spark, sf_dir))).filter("decoded")
    return sm.rest_summary(parsed)


def _validated(spark, sf_dir, shape):
    checked = sm.validate_replies(inputs.summary_replies(spark, sf_dir, shape), shape)
    return checked.select("request_id", F.array_join("errors", "; ").alias("errors"))


@_query
def validate_summaries(spark, sf_dir):
    return _validated(spark, sf_dir, "summary")


@_query
def validate_rest_summaries(spark, sf_dir):
    return _validated(spark, sf_dir, "rest")


@_query
def validate_graphql_summaries(spark, sf_dir):
    return _validated(spark, sf_dir, "graphql")


def _submitted(spark, sf_dir, mode):
    return accept_submissions(
        inputs.submissions(spark, sf_dir), mode,
        F.concat(F.lit("sub-"), F.col("submission_id").cast("string")), F.col("received_at"),
    ).select("submission_id", "ok", "error", "key", "value")


@_query
def submit_incidents(spark, sf_dir):
    return _submitted(spark, sf_dir, "rest")


@_query
def submit_incidents_graphql(spark, sf_dir):
    return _submitted(spark, sf_dir, "graphql")


@_query
def register_artifacts(spark, sf_dir):
    registered = af.register_artifacts(
        inputs.artifact_intake(spark, sf_dir), F.concat(F.lit("up-"), F.col("upload_id").cast("string")))
    return registered.select(
        "upload_id", "ok", "error", F.col("artifact.objectKey").alias("object_key"), "key", "value")


@_query
def store_artifacts(spark, sf_dir):
    intake = inputs.document_intake(spark, sf_dir)
    content = af.artifact_content(af.register_artifacts(intake, F.concat(F.lit("doc-"), F.col("doc_id"))))
    return content.select(
        "object_key", "mime_type", F.octet_length("content").cast("bigint").alias("size"),
        F.md5("content").alias("md5"))


FILE_ROWS = 100  # documents of a file; the number of files grows with the table


@_query
def artifact_file_intake(spark, sf_dir):
    """The documents written as text files, which are then read and registered as uploads."""
    folder = f"{shared_folder(configure(spark))}/files-{uuid.uuid4()}"
    number = F.floor(F.col("doc_id") / FILE_ROWS)
    spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        number.alias("number"), "doc_id", F.coalesce("text", F.lit("")).alias("text")).repartition("number").sortWithinPartitions(
        "number", "doc_id").select("number", "text").write.partitionBy("number").text(folder)
    name = F.concat(F.lit("documents "), F.regexp_extract("path", r"number=(\d+)", 1), F.lit(".txt"))
    files = af.read_files(spark, folder, "*.txt").select(
        F.lit("inc-files").alias("incident_id"), name.alias("original_name"), F.lit(None).cast("string").alias("mime_type"),
        "size", inputs.fixed_time().alias("received_at"), "content")
    # Refused files are judged without their content, which then is not read.
    columns = ["original_name", "size", "ok", "error", F.col("artifact.objectKey").alias("object_key")]
    refused = af.register_artifacts(files.drop("content"), F.col("original_name")).filter("NOT ok").select(
        *columns, F.lit(None).cast("string").alias("md5"))
    small = files.filter(F.col("size") <= af.MAX_BYTES)
    stored_files = af.register_artifacts(small, F.col("original_name")).filter("ok").select(
        *columns, F.md5("content").alias("md5"))
    return refused.unionByName(stored_files)


@_query
def generated_identities(spark, sf_dir):
    """Ids and times that the library makes itself: all ids differ and are random uuids, and a batch has one time."""
    submitted = published(accept_submissions(inputs.submissions(spark, sf_dir)))
    intake = inputs.artifact_intake(spark, sf_dir).withColumn("received_at", F.current_timestamp())
    attached = evaluated_once(af.register_artifacts(intake)).filter("ok")
    made = submitted.select(F.lit("submission").alias("kind"), "value").unionByName(
        attached.select(F.lit("artifact").alias("kind"), "value"))
    made = made.select("kind", F.get_json_object("value", "$.id").alias("id"), F.get_json_object("value", "$.timestamp").alias("time"))
    form = F.col("id").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")
    return made.groupBy("kind").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("id").alias("ids"), F.count_if(form).alias("well_formed"),
        F.count_distinct("time").alias("times"))


@_query
def stored_content(spark, sf_dir):
    """The documents stored twice, the second time under the same keys; one row per key comes back."""
    folder = f"{shared_folder(configure(spark))}/content-{uuid.uuid4()}"
    intake = inputs.document_intake(spark, sf_dir)
    content = af.artifact_content(af.register_artifacts(intake, F.concat(F.lit("doc-"), F.col("doc_id"))))
    af.write_content(content, folder, "1")
    af.write_content(content.withColumn("content", F.encode(F.reverse(F.decode("content", "UTF-8")), "UTF-8")), folder, "2")
    return af.read_content(spark, folder).select(
        "object_key", "mime_type", F.octet_length("content").cast("bigint").alias("size"), F.md5("content").alias("md5"))


def _stored_timeline(spark, sf_dir):
    tables = Tables(spark, f"{shared_folder(configure(spark))}/timeline-{uuid.uuid4()}")
    tables.write("timeline", 0, inputs.timeline(spark, sf_dir))
    return tables.all_batches("timeline")


@_query
def incident_timeline_by_key(spark, sf_dir):
    """The stored events of one incident, the one with the first id, and three of their columns."""
    stored_rows = _stored_timeline(spark, sf_dir)
    key = stored_rows.agg(F.min("incident_id")).first()[0]
    return views.timeline_view(stored_rows, key, ["id", "type", "timestamp"])


@_query
def stored_dead_letter_replay(spark, sf_dir):
    """Dead letters published to a log of their own, read from it and replayed."""
    folder = f"{shared_folder(configure(spark))}/dead-letters-{uuid.uuid4()}"
    messages = _dead_letter_messages(spark, sf_dir).withColumn("partition", F.lit(0))
    Outbox(spark, folder).publish("dead-letters", messages, [F.asc("value")])
    records = dl.read_dead_letters(read_dead_letter_log(spark, folder))
    return dl.replay_messages(records).select("topic", "source_topic", "source_offset", "key", "value")


@_query
def submit_publish_project(spark, sf_dir):
    """Submissions published to a log, streamed from it and projected; the timeline that comes of it."""
    folder = f"{shared_folder(configure(spark))}/submit-{uuid.uuid4()}"
    accepted = accept_submissions(
        inputs.submissions(spark, sf_dir), "rest",
        F.concat(F.lit("sub-"), F.col("submission_id").cast("string")), F.col("received_at"),
    )
    messages = published(accepted).withColumn("partition", F.lit(0))
    Outbox(spark, f"{folder}/log").publish("submissions", messages, [F.asc("value")])
    start_projection(
        stream_log(spark, f"{folder}/log"), f"{folder}/tables", f"{folder}/checkpoint", processed_at=inputs.fixed_time()
    ).awaitTermination()
    return views.timeline_view(Tables(spark, f"{folder}/tables").read("timeline"))


@_query
def stream_project(spark, sf_dir):
    return _streamed(spark, sf_dir, start_projection)


@_query
def stream_project_keyed(spark, sf_dir):
    """The same with the first-seen test in keyed state."""
    return _streamed(spark, sf_dir, start_keyed_projection)


def _streamed(spark, sf_dir, start):
    """The log written and streamed in three runs; the tables afterwards, as one listing.

    The cuts fall between the two deliveries of an id, so duplicates meet the
    ledger of an earlier run and not only their own batch.
    """
    folder = f"{shared_folder(configure(spark))}/stream_project-{uuid.uuid4()}"
    log = inputs.event_log(spark, sf_dir)
    last = log.agg(F.max("offset")).first()[0]
    cuts = [-1, last // 30 * 10 + 8, last // 30 * 20 + 8, last]
    tables = Tables(spark, f"{folder}/tables")
    for low, high in zip(cuts, cuts[1:]):
        append_log(log.filter((F.col("offset") > low) & (F.col("offset") <= high)), f"{folder}/log")
        start(
            stream_log(spark, f"{folder}/log"), tables.root, f"{folder}/checkpoint", processed_at=inputs.fixed_time()
        ).awaitTermination()
    text = lambda *columns: F.concat_ws("|", *columns)
    listings = [
        tables.read("timeline").select(
            F.lit("timeline").alias("table"), text("incident_id", "event_id").alias("key"),
            text(iso_millis(F.col("event_timestamp")), "event_type", "message").alias("detail")),
        tables.health().select(
            F.lit("health").alias("table"), text("org_id", "service_name").alias("key"),
            text("latest_event_id", "severity", "status", iso_millis(F.col("last_updated")), "message").alias("detail")),
        tables.read("artifacts").select(
            F.lit("artifacts").alias("table"), text("incident_id", "artifact_id").alias("key"),
            text(iso_millis(F.col("uploaded_at")), "object_key", F.col("size_bytes").cast("string")).alias("detail")),
        tables.read("dead_letters").select(
            F.lit("dead_letters").alias("table"), F.col("originalOffset").alias("key"),
            text(F.col("retryCount").cast("string"), "errorMessage").alias("detail")),
        tables.read("ledger").select(
            F.lit("ledger").alias("table"), F.col("message_id").alias("key"),
            iso_millis(F.col("processed_at")).alias("detail")),
        tables.read("outcomes").groupBy("route").agg(F.sum("n").cast("string").alias("detail")).select(
            F.lit("outcomes").alias("table"), F.col("route").alias("key"), "detail"),
    ]
    result = listings[0]
    for listing in listings[1:]:
        result = result.unionByName(listing)
    return result
