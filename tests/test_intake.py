"""Dead letters and replay, submissions, artifact files, summary prompts and reply checks."""

import json
import time
import uuid

import pytest
from pyspark.sql import functions as F

from sirenlog.operators import artifacts as af
from sirenlog.operators import dead_letters as dl
from sirenlog.operators import summaries as sm
from sirenlog.operators.parsing import parse_events
from sirenlog.operators.reply_store import ReplyStore
from sirenlog.operators.submissions import REQUIRED, accept_submissions
from sirenlog.schemas import ARTIFACT_CONTENT, ENVELOPE
from sirenlog.sources.event_log import from_kafka, read_dead_letter_log, to_kafka
from tests.test_routing import event
from tests.test_stream import scans_of

def now():
    return F.lit("2026-01-01T00:00:00.000Z")


def test_dead_letter_messages_and_round_trip(make_log):
    values = [event(message="FORCE_DLQ"), event(message=...), event(message=None), event(message=5), event(id=...),
              "{bad", None, "null", '"x"', event(message=..., incidentId=7), event(message=..., incidentId="")]
    parsed = parse_events(make_log(values))
    messages = dl.dead_letter_messages(parsed, now())
    by_offset = {json.loads(r.value)["originalOffset"]: (r.key, json.loads(r.value)) for r in messages.collect()}
    errors = [by_offset[str(i)][1]["errorMessage"] for i in range(9)]
    assert errors == [dl.FORCED, dl.ABSENT_MESSAGE, dl.NULL_MESSAGE, dl.WRONG_MESSAGE, dl.WRONG_ID,
                      dl.INVALID_JSON, dl.NULL_VALUE, dl.NULL_DOCUMENT, dl.ABSENT_MESSAGE]
    key, body = by_offset["0"]
    assert key == "i" and body["retryCount"] == 3 and body["originalMessage"] == json.loads(values[0])
    key, body = by_offset["6"]
    assert key == "unknown" and body["retryCount"] == 0 and body["originalRawValue"] is None
    assert "originalMessage" not in body
    assert by_offset["8"][0] == "unknown" and "incidentId" not in by_offset["8"][1]
    assert by_offset["9"][0] == "7" and by_offset["9"][1]["incidentId"] == 7
    assert by_offset["10"][0] == "unknown" and by_offset["10"][1]["incidentId"] == ""

    def plain(frame):
        # The original message comes back as equal JSON, not as equal text.
        rows = [r.asDict() for r in frame.collect()]
        return {r["originalOffset"]: {**r, "originalMessage": json.loads(r["originalMessage"] or "null")} for r in rows}

    assert plain(dl.read_dead_letters(messages)) == plain(dl.dead_letter_records(parsed, now()))


@pytest.mark.parametrize("spelling", ["compact"])
def test_replay_takes_truthy_originals_once(spark, spelling):
    originals = ['{"incidentId":"i","id":"a"}', "0", '""', "false", "null", None, "5", '"x"', "0.0", "[]"]
    bodies = [{"originalTopic": "t", "originalPartition": 0, "originalOffset": str(i)} for i in range(len(originals))]
    values = [json.dumps(b)[:-1] + ("" if o is None else f',"originalMessage":{o}') + "}" for b, o in zip(bodies, originals)]
    messages = spark.createDataFrame([(v,) for v in values + values], "value string")
    replayed = dl.replay_messages(dl.read_dead_letters(messages)).collect()
    assert sorted((r.value, r.key) for r in replayed) == sorted(
        [('{"incidentId":"i","id":"a"}', "i"), ("5", None), ('"x"', None), ("[]", None)])
    assert all(r.headers == {"replayedFromDlq": "true", "replayOrigin": f"t/0/{r.source_offset}"} for r in replayed)


def test_originals_without_a_position_are_all_replayed(spark):
    values = [json.dumps({"originalMessage": {"incidentId": "i", "id": name}}) for name in "abc"]
    replayed = dl.replay_messages(dl.read_dead_letters(spark.createDataFrame([(v,) for v in values], "value string")))
    assert sorted(json.loads(r.value)["id"] for r in replayed.collect()) == ["a", "b", "c"]
    assert {tuple(r.headers) for r in replayed.collect()} == {("replayedFromDlq",)}


def test_replayed_messages_of_two_topics_get_their_own_offsets(spark):
    rows = [{"originalTopic": t, "originalPartition": p, "originalOffset": str(5), "originalMessage": {"id": f"{t}{p}"}}
            for t in ("t1", "t2") for p in (0, 1)]
    records = dl.read_dead_letters(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string"))
    log = spark.createDataFrame([("incident-events", 0, 9, None, "v", {})], ENVELOPE)
    got = dl.append_replay(log, dl.replay_messages(records)).filter("value <> 'v'").collect()
    assert sorted((r.partition, r.offset, json.loads(r.value)["id"]) for r in got) == [
        (0, 10, "t10"), (0, 11, "t20"), (1, 0, "t11"), (1, 1, "t21")]


def test_absent_dead_letter_log_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_dead_letter_log(spark, str(tmp_path / "none"))


def test_kafka_rows_round_trip(spark):
    rows = spark.createDataFrame(
        [("t", 0, 1, bytearray(b"k"), bytearray(b"v\xff"), [("h", bytearray(b"1")), ("h", bytearray(b"2"))]),
         ("t", 0, 2, None, None, None)],
        "topic string, partition int, offset bigint, key binary, value binary, "
        "headers array<struct<key:string,value:binary>>")
    got = from_kafka(rows).orderBy("offset").collect()
    assert (got[0].key, got[0].value, got[0].headers) == ("k", "v�", {"h": "2"})
    assert (got[1].key, got[1].value, got[1].headers) == (None, None, {})
    assert to_kafka(from_kafka(rows)).orderBy("key").collect()[1].headers[0].value == bytearray(b"2")


def body(**changes):
    base = dict(incidentId="i", orgId="o", serviceName="s", severity="HIGH", message="m \"q\"")
    base.update(changes)
    return json.dumps({k: v for k, v in base.items() if v is not ...})


@pytest.mark.parametrize("mode,changes,ok", [
    ("rest", {}, True), ("rest", dict(message=""), False), ("rest", dict(severity=0), False),
    ("rest", dict(orgId=False), False), ("rest", dict(orgId=None), False), ("rest", dict(orgId=...), False),
    ("rest", dict(severity=5), True), ("rest", dict(message=[]), True), ("rest", dict(message="0"), True),
    ("graphql", {}, True), ("graphql", dict(message=""), True), ("graphql", dict(message=None), False),
    ("graphql", dict(orgId=5), True), ("graphql", dict(severity=5), False),
])
def test_submissions(spark, mode, changes, ok):
    frame = spark.createDataFrame([(body(**changes),)], "body string")
    row = accept_submissions(frame, mode, F.lit("id-1"), F.lit("2026-01-01").cast("timestamp")).first()
    assert row.ok is ok and row.error == (None if ok else REQUIRED)
    if ok:
        built = json.loads(row.value)
        assert list(built) == ["id", "incidentId", "orgId", "serviceName", "severity", "type", "message", "timestamp"]
        sent = json.loads(body(**changes))
        want = {k: str(v) if mode == "graphql" else v for k, v in sent.items()}
        assert {k: built[k] for k in sent} == want and row.key == "i"


def test_generated_ids_differ(spark):
    rows = accept_submissions(spark.createDataFrame([(body(),)] * 3, "body string")).collect()
    assert len({json.loads(r.value)["id"] for r in rows}) == 3


def test_artifact_files(spark, tmp_path):
    (tmp_path / "disk full\tlog.txt").write_bytes(b"abc")
    (tmp_path / "large.bin").write_bytes(b"x" * (af.MAX_BYTES + 1))
    files = af.read_files(spark, str(tmp_path)).select(
        F.lit("i").alias("incident_id"), "original_name", F.lit("").alias("mime_type"), "size",
        F.timestamp_millis(F.lit(1700000000000)).alias("received_at"), "content")
    judged = af.register_artifacts(files.filter(F.col("size") <= af.MAX_BYTES), F.lit("u"))
    row = judged.first()
    assert row.artifact.objectKey == "i/1700000000000-disk-full-log.txt"
    assert row.artifact.mimeType == af.DEFAULT_MIME
    assert json.loads(row.value)["message"] == "Artifact attached: disk full\tlog.txt"
    for _ in range(2):  # a load that is repeated replaces itself
        af.write_content(af.artifact_content(judged), str(tmp_path / "stored"), "1")
    assert bytes(spark.read.parquet(str(tmp_path / "stored")).first().content) == b"abc"
    refused = af.register_artifacts(files.drop("content"), F.lit("u")).filter("NOT ok").collect()
    assert [(r.original_name, r.error) for r in refused] == [("large.bin", af.TOO_LARGE)]


GOOD = dict(summary="s", customer_impact="c", likely_root_cause="l", confidence="LOW",
            next_actions=["1", "2", "3"], signals=["1", "2", "3"])


def reply(**changes):
    return json.dumps({k: v for k, v in {**GOOD, **changes}.items() if v is not ...})


@pytest.mark.parametrize("shape,text,errors", [
    ("summary", reply(), []),
    ("summary", reply(summary=..., signals=...), ["missing field: summary", "missing field: signals"]),
    ("summary", reply(summary=" ﻿\n"), ["summary must be a non-empty string"]),
    ("summary", reply(customer_impact=""), ["customer_impact must be a non-empty string"]),
    ("summary", reply(confidence="SURE"), ['confidence must be one of LOW|MEDIUM|HIGH, got "SURE"']),
    ("summary", reply(next_actions=["1"], signals="abc"),
     ["next_actions must be an array of length 3, got length 1", "signals must be an array of length 3, got length 3"]),
    ("summary", reply(signals=None), ["signals must be an array of length 3, got length undefined"]),
    ("summary", "not json", ["reply is not a JSON object"]),
    ("rest", reply(ok=True, incidentId="i", customer_impact=""), []),
    ("rest", reply(ok=False, incidentId="i"), ["ok must be true, got false"]),
    ("rest", reply(), ["missing field: ok", "missing field: incidentId"]),
    ("graphql", reply(incidentId="i"), ["missing field: customerImpact", "missing field: likelyRootCause",
                                        "missing field: nextActions"]),
])
def test_reply_validation(spark, shape, text, errors):
    assert sm.validate_replies(spark.createDataFrame([(text,)], "reply string"), shape).first().errors == errors


def test_prompt_generation_and_empty_reply(spark):
    ts = lambda minute: F.timestamp_millis(F.lit(1777044600000 + minute * 60000))
    events = spark.range(1).select(F.lit("smoke-incident-001").alias("incident_id"), F.inline(F.array(*[
        F.struct(ts(m).alias("event_timestamp"), F.lit(e).alias("event_id"), F.lit("INCIDENT_NOTE").alias("event_type"),
                 F.lit(f"message {e}").alias("message")) for m, e in ((0, "evt-1"), (4, "evt-4"), (2, "evt-3"))])))
    health = spark.createDataFrame(
        [("smoke-org", "b", "HIGH", "DEGRADED", "m"), ("smoke-org", "a", None, "ACTIVE", "m")],
        "org_id string, service_name string, severity string, status string, message string"
    ).withColumn("last_updated", ts(1))
    requests = spark.createDataFrame(
        [("r1", "smoke-incident-001", "smoke-org", None, False), ("r2", "smoke-incident-001", None, 1.0, True)],
        "request_id string, incident_id string, org_id string, limit double, limit_given boolean")
    prompts = sm.summary_prompts(sm.summary_context(requests, sm.recent_events(events, requests), health))
    text = {r.request_id: r.prompt for r in prompts.collect()}
    assert ("1. 2026-04-24T15:34:00.000Z - INCIDENT_NOTE - message evt-4\n"
            "2. 2026-04-24T15:32:00.000Z - INCIDENT_NOTE - message evt-3\n") in text["r1"]
    assert ("- a: ACTIVE (severity=null) — m @ 2026-04-24T15:31:00.000Z\n"
            "- b: DEGRADED (severity=HIGH) — m @ 2026-04-24T15:31:00.000Z") in text["r1"]
    assert "Org ID: unknown" in text["r2"] and "(not provided)" in text["r2"] and "2. 2026" not in text["r2"]
    replies = sm.generate_summaries(prompts, parallelism=2)
    assert {tuple(r.errors) for r in sm.validate_replies(replies).collect()} == {()}
    empty = sm.generate_summaries(prompts, lambda: lambda texts: ["" for _ in texts])
    assert {(r.reply, r.error) for r in empty.collect()} == {(None, "empty reply")}


def test_a_failing_prompt_is_its_own_error(spark):
    prompts = spark.createDataFrame([(f"r{n}", "i", f"p{n}") for n in range(9)],
                                    "request_id string, incident_id string, prompt string").repartition(2)

    def make():
        def generate(texts):
            if "p4" in texts:
                raise OSError("unreachable")
            return [t.upper() for t in texts] if "p7" not in texts else []
        return generate

    got = {r.request_id: (r.reply, r.error) for r in sm.generate_summaries(prompts, make, batch_size=3).collect()}
    assert got.pop("r4") == (None, "OSError: unreachable")
    assert got.pop("r7") == (None, "ValueError: 0 replies to 1 prompts")
    assert got == {f"r{n}": (f"P{n}", None) for n in range(9) if n not in (4, 7)}


def test_superseded_content_is_not_read(spark, tmp_path):
    """All keys overwritten by a later load, some by a third one; equal keys of one load give one row."""
    path = str(tmp_path / "content")
    content = lambda keys, text: spark.createDataFrame(
        [(k, "m", bytearray(text * 50_000, "ascii")) for k in keys], ARTIFACT_CONTENT)
    af.write_content(content(["a", "b", "c"], "x"), path, "1")
    af.write_content(content(["a", "b", "c", "c"], "y"), path, "2")
    af.write_content(content(["b"], "z"), path, "3")
    read = af.read_content(spark, path)
    assert sorted((r.object_key, chr(r.content[0])) for r in read.collect()) == [("a", "y"), ("b", "z"), ("c", "y")]
    size = lambda *loads: sum(f.stat().st_size for n in loads for f in (tmp_path / f"content/load={n}").glob("*.parquet"))
    scans = [s for s in scans_of(read._jdf.queryExecution().executedPlan()) if s.metrics().contains("numPartitions")]
    assert sum(s.metrics().apply("filesSize").value() for s in scans) == size(2, 3)


def logging_generator(folder, fails_on=None, error=None):
    """Replies with the prompt reversed, notes what it was asked, and fails on one prompt."""
    def make():
        def generate(texts):
            if fails_on in texts:
                time.sleep(4)  # the other tasks come to their end
                raise error
            with open(f"{folder}/{uuid.uuid4()}", "w") as note:
                note.write("\n".join(texts))
            return [t[::-1] for t in texts]
        return generate
    return make


def asked_prompts(folder):
    return sorted(t for note in folder.iterdir() for t in note.read_text().split("\n"))


class Gone(BaseException):
    """What no generator's error handling catches: the task dies."""


def test_a_failed_run_is_continued_and_asks_no_prompt_twice(spark, tmp_path):
    first, second, third = [tmp_path / name for name in ("first", "second", "third")]
    for folder in (first, second, third):
        folder.mkdir()
    store = ReplyStore(spark, str(tmp_path / "store"))
    prompts = spark.createDataFrame(
        [(f"r{i}", "inc", f"prompt {i % 40}") for i in range(60)], "request_id string, incident_id string, prompt string")
    with pytest.raises(Exception):
        store.generate(prompts, logging_generator(first, "prompt 7", Gone()), per_task=5, batch_size=5)
    kept = sorted(r.reply[::-1] for r in store.replies().collect())
    assert kept and "prompt 7" not in kept and set(kept) <= set(asked_prompts(first))
    out = store.generate(prompts, logging_generator(second), per_task=5)
    assert asked_prompts(second) == sorted({f"prompt {i}" for i in range(40)} - set(kept))
    assert {r.request_id: (r.reply, r.error) for r in out.collect()} == {
        f"r{i}": (f"prompt {i % 40}"[::-1], None) for i in range(60)}
    assert store.generate(prompts, logging_generator(third)).count() == 60 and asked_prompts(third) == []


def test_errors_are_told_and_asked_again(spark, tmp_path):
    store, folder = ReplyStore(spark, str(tmp_path / "store")), tmp_path / "asked"
    folder.mkdir()
    prompts = spark.createDataFrame([("a", "i", "x"), ("b", "i", "y"), ("c", "i", "y")], "request_id string, incident_id string, prompt string")
    out = store.generate(prompts, logging_generator(folder, "y", ValueError("no")))
    assert sorted((r.request_id, r.reply, r.error) for r in out.collect()) == [
        ("a", "x", None), ("b", None, "ValueError: no"), ("c", None, "ValueError: no")]
    out = store.generate(prompts, logging_generator(folder))
    assert sorted((r.request_id, r.reply, r.error) for r in out.collect()) == [("a", "x", None), ("b", "y", None), ("c", "y", None)]
    assert asked_prompts(folder) == ["x", "y"]
    assert store.generate(prompts.limit(0)).count() == 0
