"""Health fold, views, limits and contracts."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from sirenlog.functions.timestamps import iso_millis
from sirenlog.operators import projections as pj
from sirenlog.operators import summaries as sm
from sirenlog.operators import views
from sirenlog.operators.parsing import parse_events
from sirenlog.operators.routing import first_deliveries
from tests.test_routing import ART, event


def health_of(log, **options):
    first = first_deliveries(parse_events(log), pj.HEALTH_INPUT)
    return pj.fold_health(pj.health_changes(first, **options))


@pytest.mark.parametrize("second,missing,want", [
    (..., "keep", ("CRITICAL", "ACTIVE")),
    (None, "keep", (None, "ACTIVE")),
    (..., "null", (None, "ACTIVE")),
    ("LOW", "keep", ("LOW", "ACTIVE")),
    ("CRITICAL", "keep", ("CRITICAL", "DEGRADED")),
])
def test_severity_is_kept_or_erased(make_log, second, missing, want):
    log = make_log([event(id="1", severity="CRITICAL"), event(id="2", severity=second)])
    row = health_of(log, missing=missing).first()
    assert (row.severity, row.status, row.latest_event_id) == (*want, "2")


def test_late_event_overwrites(make_log):
    log = make_log([event(id="1", timestamp="2026-02-01T00:00:00.000Z"),
                    event(id="2", timestamp="2026-01-01T00:00:00.000Z", message="late")])
    row = health_of(log).select(iso_millis(F.col("last_updated")).alias("t"), "message").first()
    assert tuple(row) == ("2026-01-01T00:00:00.000Z", "late")


def test_fold_of_folds_is_the_fold(make_log):
    rng = random.Random(3)
    values = [event(id=str(i), serviceName=rng.choice("xyz"), severity=rng.choice(["LOW", "CRITICAL", None, ...]))
              for i in range(200)]
    first = first_deliveries(parse_events(make_log(values)), pj.HEALTH_INPUT)
    changes = pj.health_changes(first)
    parts = [pj.fold_health(changes.filter(F.col("arrival.offset") % 3 == n)) for n in range(3)]
    refolded = pj.fold_health(parts[2].unionByName(parts[0]).unionByName(parts[1]))
    assert sorted(refolded.collect()) == sorted(pj.fold_health(changes).collect())


def timeline_of(log):
    return pj.timeline_rows(first_deliveries(parse_events(log), pj.TIMELINE_INPUT))


def at(minute):
    return f"2026-04-24T{15 + minute // 60:02}:{minute % 60:02}:00.000Z"


def test_timeline_order_key_and_columns(spark, make_log, tmp_path):
    log = make_log([event(id="b", timestamp=at(1)), event(id="a", timestamp=at(1)), event(id="c", timestamp=at(5)),
                    event(id="d", incidentId="j", timestamp=at(9))])
    timeline_of(log).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    view = views.timeline_view(stored, "i", ["id", "timestamp"])
    assert [r.id for r in view.collect()] == ["c", "a", "b"]
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(incident_id,i)" in plan
    assert "message" not in plan.split("ReadSchema")[1]
    assert {r.incidentId: r.events for r in views.timeline_counts(stored).collect()} == {"i": 3, "j": 1}


def test_artifact_rows_views_and_contract(make_log):
    big = {**ART, "artifact": {**ART["artifact"], "size": 2**31}}
    bare = {**ART, "artifact": {}}
    log = make_log([event(id="1", **ART), event(id="2", timestamp=at(40), **big), event(id="3", timestamp=at(50), **bare)])
    view = views.artifacts_view(pj.artifact_rows(first_deliveries(parse_events(log), pj.ARTIFACT_INPUT)), "i")
    assert [r.artifactId for r in view.collect()] == ["3", "2", "1"]
    located = views.with_location(view, F.lit("2026-01-01T00:00:00Z").cast("timestamp")).filter("artifactId = '1'")
    assert located.first().location == "s3a://b/k"
    assert located.first().expiresAt == "2026-01-01T00:15:00.000Z"
    found = views.contract_violations(view, "v", "artifactId", views.ARTIFACT_CONTRACT).collect()
    assert {(r.key, r.column, r.reason) for r in found} == {("2", "sizeBytes", "not a 32-bit integer")} | {
        ("3", c, "null") for c in ("bucket", "objectKey", "originalName", "mimeType", "sizeBytes")}


def test_stored_lookup(spark):
    stored = spark.createDataFrame(
        [("i/1-a b+c.log", "bk", "x", "i")], "object_key string, bucket string, artifact_id string, incident_id string"
    ).withColumn("uploaded_at", F.timestamp_seconds(F.lit(0)))
    paths = spark.createDataFrame([("i%2F1-a%20b+c.log",), ("i%2",), ("%E0%A4",), ("none",)], "path string")
    got = {r.path: (r.objectKey, r.artifactId) for r in views.stored_lookup(paths, stored).collect()}
    assert got == {"i%2F1-a%20b+c.log": ("i/1-a b+c.log", "x"), "i%2": (None, None), "%E0%A4": (None, None),
                   "none": ("none", None)}


def slice_like(events, limit, given):
    if not given:
        return events[:20]
    if limit is None or math.isnan(limit):
        return []
    cut = math.trunc(limit) if math.isfinite(limit) else int(math.copysign(10**9, limit))
    return events[:cut]


LIMITS = [(None, False), (20.0, True), (3.0, True), (0.0, True), (-1.0, True), (-3.0, True), (-500.0, True), (None, True),
          (float("nan"), True), (2.9, True), (-1.9, True), (1500.0, True), (float("inf"), True), (5.0, True)]


def test_limits_match_brute_force(spark, make_log):
    """A hot incident next to a small one; every kind of limit on both."""
    rng = random.Random(5)
    values = [event(id=f"h{i:03}", incidentId="hot", timestamp=at(rng.randrange(300))) for i in range(120)]
    values += [event(id=f"s{i}", incidentId="small", timestamp=at(i)) for i in range(4)]
    rows = [json.loads(v) for v in values]
    requests = [(f"{incident}-{n}", incident, None, limit, given)
                for incident in ("hot", "small", "none", "", None) for n, (limit, given) in enumerate(LIMITS)]
    frame = spark.createDataFrame(
        requests, "request_id string, incident_id string, org_id string, limit double, limit_given boolean")
    timeline = timeline_of(make_log(values))
    recent = sm.recent_events(timeline, frame).collect()
    got = {}
    for r in recent:
        got.setdefault(r.request_id, {})[r.position] = r.event_id
    want = {}
    for request_id, incident, _, limit, given in requests:
        events = sorted((r for r in rows if r["incidentId"] == incident), key=lambda r: r["id"])
        events.sort(key=lambda r: r["timestamp"], reverse=True)
        taken = slice_like([r["id"] for r in events], limit, given)
        if taken:
            want[request_id] = {i + 1: name for i, name in enumerate(taken)}
    assert got == want
    status = {r.request_id: r.status for r in sm.request_status(frame, timeline).collect()}
    assert status["hot-1"] == "OK" and status["hot-3"] == "NOT_FOUND" and status["None-0"] == "INVALID"
    assert {r.request_id for r in sm.not_found(frame, timeline).collect()} == (
        {r[0] for r in requests} - set(want))


def test_one_hot_hour_and_limits_around_a_thousand(spark):
    """Most events share one hour, a third one instant; every limit goes the same way."""
    rng = random.Random(8)
    moments = [1777044600000 + (rng.randrange(3_600_000) if n % 3 else 1_000) for n in range(1300)]
    moments += [1777044600000 + 7_200_000 * n for n in range(1, 20)]
    rows = [("hot", f"e{n:05}", m) for n, m in enumerate(moments)] + [("cold", "c", 1777044600000)]
    timeline = spark.createDataFrame(rows, "incident_id string, event_id string, ms bigint").select(
        "incident_id", F.timestamp_millis("ms").alias("event_timestamp"), "event_id",
        F.lit("t").alias("event_type"), F.lit("m").alias("message")).repartition(6)
    limits = [999.0, 1000.0, 1001.0, -1.0, 1.0, 5000.0, 1e300, -1e300]
    frame = spark.createDataFrame(
        [(f"r{n}", "hot", None, limit, True) for n, limit in enumerate(limits)],
        "request_id string, incident_id string, org_id string, limit double, limit_given boolean")
    got = {}
    for r in sm.recent_events(timeline, frame).collect():
        got.setdefault(r.request_id, {})[r.position] = r.event_id
    newest = [e for _, e, _ in sorted((r for r in rows if r[0] == "hot"), key=lambda r: (-r[2], r[1]))]
    for n, limit in enumerate(limits):
        taken = newest[:int(limit)]
        assert got.get(f"r{n}", {}) == {i + 1: e for i, e in enumerate(taken)}, limit
    status = {r.request_id: r.events for r in sm.request_status(frame, timeline).collect()}
    assert status == {f"r{n}": len(newest[:int(limit)]) for n, limit in enumerate(limits)}


def test_no_window_ranks_a_whole_incident(spark, make_log):
    frame = spark.createDataFrame(
        [("r", "i", None, 3.0, True)],
        "request_id string, incident_id string, org_id string, limit double, limit_given boolean")
    recent = sm.recent_events(timeline_of(make_log([event()])), frame)
    plan = recent._jdf.queryExecution().optimizedPlan().toString()
    ranks = [line for line in plan.split("\n") if "row_number()" in line]
    assert ranks and all("part#" in line for line in ranks)
    assert "row_number" not in sm.request_status(frame, timeline_of(make_log([event()])))._jdf.queryExecution(
        ).optimizedPlan().toString()


def test_health_text_of_requested_organisations_only(spark):
    requests = spark.createDataFrame(
        [("a", "i", "o1"), ("b", "i", None), ("c", "i", "")], "request_id string, incident_id string, org_id string")
    recent = spark.createDataFrame(
        [(r, 1, "e", "t", "m") for r in "abc"],
        "request_id string, position bigint, event_id string, event_type string, message string"
    ).withColumn("event_timestamp", F.timestamp_millis(F.lit(0)))
    health = spark.createDataFrame(
        [(o, "s", "LOW", "ACTIVE", "m") for o in ("o1", "o2", "")],
        "org_id string, service_name string, severity string, status string, message string"
    ).withColumn("last_updated", F.timestamp_millis(F.lit(0)))
    got = {r.request_id: r.services for r in sm.summary_context(requests, recent, health).collect()}
    assert got == {"a": 1, "b": 0, "c": 0}


def test_last_upload_of_a_key_is_found(spark):
    stored = spark.createDataFrame(
        [("k", "b", "x", "i", 1), ("k", "b", "y", "i", 2)],
        "object_key string, bucket string, artifact_id string, incident_id string, s int"
    ).withColumn("uploaded_at", F.timestamp_seconds("s"))
    paths = spark.createDataFrame([("k",), ("k",)], "path string")
    assert [r.artifactId for r in views.stored_lookup(paths, stored).collect()] == ["y", "y"]
