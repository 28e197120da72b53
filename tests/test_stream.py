"""The streamed tables against the batch operators; retries, replay, quarantine, compaction."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from sirenlog.operators import newest
from sirenlog.operators import projections as pj
from sirenlog.operators import routing, views
from sirenlog.operators.parsing import parse_events
from sirenlog.sources.event_log import append_log, publish_stream, read_log, stream_log
from sirenlog.streaming.pipeline import project_batch, replay_to_log, start_projection, wait_until_projected
from sirenlog.operators.routing import CONSUMER_GROUP
from sirenlog.sources.outbox import Outbox
from sirenlog.streaming import tables as stored
from sirenlog.schemas import ENVELOPE, HEALTH_CHANGES, SUMMARY_REQUEST, TIMELINE
from sirenlog.streaming.pipeline import replay_report, start_keyed_projection
from sirenlog.streaming.tables import Tables
from tests.test_routing import ART, event


def messages(n=120):
    rng = random.Random(11)
    values = []
    for i in range(n):
        changes = dict(id=f"e{rng.randrange(n // 2)}", incidentId=rng.choice("pq"), serviceName=rng.choice("xyz"),
                       severity=rng.choice(["LOW", "CRITICAL", None, ...]),
                       message=rng.choice(["m", "m", "m", "FORCE_DLQ", ...]),
                       timestamp=rng.choice(["2026-04-24T15:30:00.000Z", "2026-04-23T15:30:00.000Z", "bad"]))
        values.append("{oops" if rng.random() < 0.05 else event(**{**changes, **(ART if rng.random() < 0.2 else {})}))
    return values


def contents(tables):
    drop = {"ledger": ["processed_at"], "health": ["arrival", "severity_arrival"]}
    frames = {name: tables.read(name) for name in ("ledger", "timeline", "artifacts", "dead_letters")}
    frames["health"] = tables.health()
    return {name: sorted(map(repr, f.drop(*drop.get(name, [])).collect())) for name, f in frames.items()}


def now():
    return F.lit("2026-01-01T00:00:00Z").cast("timestamp")


@pytest.fixture(scope="module")
def streamed(spark, make_log, tmp_path_factory):
    """Three runs over a growing log, each resuming from the checkpoint."""
    folder = str(tmp_path_factory.mktemp("stream"))
    values, tables = messages(), Tables(spark, f"{folder}/tables")
    for low, high in ((0, 37), (37, 80), (80, len(values))):
        append_log(make_log(values[low:high], low).coalesce(1), f"{folder}/log")
        query = start_projection(stream_log(spark, f"{folder}/log"), tables.root, f"{folder}/ckpt", processed_at=now())
        assert wait_until_projected(query, 120)
    return folder, tables


def test_stream_equals_batch(spark, streamed):
    folder, tables = streamed
    parsed = parse_events(read_log(spark, f"{folder}/log"))
    batch = Tables(spark, f"{folder}/one_batch")
    project_batch(read_log(spark, f"{folder}/log"), 0, batch, processed_at=now())
    assert contents(tables) == contents(batch)
    counts = {r.route: r.n for r in tables.read("outcomes").groupBy("route").agg(F.sum("n").alias("n")).collect() if r.n}
    assert counts == {r.route: r.n for r in routing.route_counts(parsed).collect()}
    first = routing.first_deliveries(parsed, pj.TIMELINE_INPUT)
    assert sorted(views.timeline_view(tables.read("timeline")).collect()) == sorted(
        views.timeline_view(pj.timeline_rows(first)).collect())


def test_repeated_batch_changes_nothing(spark, streamed):
    folder, tables = streamed
    before = contents(tables)
    last = read_log(spark, f"{folder}/log").filter(F.col("offset") >= 80)
    project_batch(last, 2, tables, processed_at=now())
    assert contents(tables) == before


def test_uncommitted_batch_is_not_read(spark, make_log, tmp_path):
    tables = Tables(spark, str(tmp_path))
    project_batch(make_log([event()]), 0, tables)
    stray = tables.read("timeline").withColumn("event_id", F.lit("stray"))
    tables.write("timeline", 1, stray)
    assert [r.event_id for r in tables.read("timeline").collect()] == ["a"]


def test_compaction_keeps_contents_and_removes_folders(spark, streamed):
    folder, tables = streamed
    before, names = contents(tables), ("ledger", "timeline", "artifacts", "dead_letters", "health_changes")
    assert len(tables.folders("timeline")) == 3
    for name in names:
        tables.compact(name)
    assert contents(tables) == before
    for name in (*names, "accepted", "received"):
        assert tables.folders(name) == ["batch_id=2"], name
        if name not in ("accepted", "received"):
            assert tables.folders(f"compacted_{name}") == ["through=1"]
    # The newest batch may still be repeated, and a further run and compaction follow.
    last = read_log(spark, f"{folder}/log").filter(F.col("offset") >= 80)
    project_batch(last, 2, tables, processed_at=now())
    assert contents(tables) == before
    again = read_log(spark, f"{folder}/log").filter("offset < 50")
    project_batch(again, 3, tables, processed_at=now())
    assert contents(tables)["ledger"] == before["ledger"] and contents(tables)["timeline"] == before["timeline"]
    tables.compact("ledger")
    assert tables.folders("compacted_ledger") == ["through=2"] and contents(tables)["ledger"] == before["ledger"]
    with pytest.raises(ValueError):
        tables.read_before("ledger", 1)


def scans_of(plan):
    """The file scans of an executed plan, below its query stages too."""
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.finalPhysicalPlan()
    leaves, found = plan.collectLeaves(), []
    for leaf in [leaves.apply(i) for i in range(leaves.size())]:
        if "Stage" in leaf.nodeName():
            found += scans_of(leaf.plan())
        elif leaf.metrics().contains("numFiles"):
            found.append(leaf)
    return found


def files_read(frame):
    """Files that the scans of an executed plan read, by the folder of their table."""
    frame.collect()
    found = {}
    for scan in scans_of(frame._jdf.queryExecution().executedPlan()):
        name = scan.relation().location().rootPaths().head().toString().split("/tables/")[1].split("/")[0]
        found[name] = found.get(name, 0) + scan.metrics().apply("numFiles").value()
    return found


def ledger_of(spark, tables, ids, batch):
    rows = ids.select(F.lit(CONSUMER_GROUP).alias("consumer_group"), "message_id", now().alias("processed_at"))
    tables.write("ledger", batch, rows)
    tables.write("outcomes", batch, spark.createDataFrame([("x", 1)], "route string, n bigint"))


@pytest.fixture(scope="module")
def large_ledger(spark, tmp_path_factory):
    """100,000 ids, compacted into many folders, and a few in the newest batch."""
    tables = Tables(spark, f"{tmp_path_factory.mktemp('ledger')}/tables")
    names = lambda low, high: spark.range(low, high).select(F.concat(F.lit("id-"), F.col("id")).alias("message_id"))
    patch = pytest.MonkeyPatch()
    patch.setattr(stored, "BUCKET_IDS", 200)
    for batch, (low, high) in enumerate([(0, 60_000), (60_000, 100_000), (100_000, 100_010)]):
        ledger_of(spark, tables, names(low, high), batch)
    tables.compact("ledger")
    patch.undo()  # a lookup goes by what the marker says, not by the setting
    return tables, names


def test_ledger_lookup_finds_all_known_ids(spark, large_ledger):
    tables, names = large_ledger
    ids = names(99_000, 101_000)
    held = {r.message_id for r in tables.ledger_before(3, ids).collect()}
    assert {f"id-{i}" for i in range(99_000, 100_010)} <= held
    unseen = routing.unseen(ids, tables.ledger_before(3, ids), "message_id")
    assert sorted(r.message_id for r in unseen.collect()) == sorted(f"id-{i}" for i in range(100_010, 101_000))


def test_ledger_lookup_reads_a_bounded_share(spark, large_ledger):
    tables, names = large_ledger
    everything = files_read(tables.read("ledger"))["compacted_ledger"]
    new = files_read(tables.ledger_before(3, names(200_000, 201_000)))
    one = files_read(tables.ledger_before(3, names(5, 6)))
    assert everything >= 500
    assert new.get("compacted_ledger", 0) < everything / 20   # a thousand new ids: only those the filter cannot tell
    assert 1 <= one["compacted_ledger"] <= 2
    suspects = tables.suspects(names(200_000, 300_000), *((d := tables._compacted("ledger", 2))[0], d[2]))
    assert suspects.count() < 1_500                            # of 100,000


def test_ledger_lookup_of_a_batch_too_large_to_send(spark, large_ledger, monkeypatch):
    tables, names = large_ledger
    ids = names(99_990, 100_020)
    small = sorted(r.message_id for r in tables.ledger_before(3, ids).collect())
    monkeypatch.setattr(stored, "SMALL_BATCH", 3)
    lookup = tables.suspects(ids, *((d := tables._compacted("ledger", 2))[0], d[2]))
    assert "rightHint" not in lookup._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.message_id for r in tables.ledger_before(3, ids).collect()) == small


def test_compaction_after_compaction_takes_new_numbers(spark, tmp_path, monkeypatch):
    tables = Tables(spark, f"{tmp_path}/tables")
    ids = lambda low, high: spark.range(low, high).select(F.col("id").cast("string").alias("message_id"))
    for batch, size in enumerate((50, 100, 40)):
        monkeypatch.setattr(stored, "BUCKET_IDS", size)
        ledger_of(spark, tables, ids(batch * 100, batch * 100 + 100), batch)
        tables.compact("ledger")
    known = {r.message_id for r in tables.ledger_before(3, ids(0, 300)).collect()}
    assert known == {str(i) for i in range(300)}
    assert tables.folders("compacted_ledger_filter") == ["through=1"] and tables._compacted("ledger", 2) == (1, 5, 50)


def test_replay_and_quarantine(spark, make_log, tmp_path):
    log, tables = str(tmp_path / "log"), Tables(spark, str(tmp_path / "tables"))
    append_log(make_log([event(id="1", message="FORCE_DLQ"), event(id="2", timestamp="bad"), "{oops"]), log)
    project_batch(read_log(spark, log), 0, tables, after_mark_failure="quarantine")
    assert sorted(r.originalOffset for r in tables.read("dead_letters").collect()) == ["0", "1", "2"]
    replay_to_log(spark, tables, log)
    appended = read_log(spark, log).filter(F.col("offset") > 2).orderBy("offset").collect()
    assert [(r.offset, r.headers) for r in appended] == [
        (3, {"replayedFromDlq": "true", "replayOrigin": "incident-events/0/0"}),
        (4, {"replayedFromDlq": "true", "replayOrigin": "incident-events/0/1"})]
    routes = routing.route_events(parse_events(read_log(spark, log))).orderBy("offset").collect()
    assert [r.route for r in routes] == ["dlq_message", "lost_after_mark", "dlq_raw", "dlq_message", "duplicate"]


def test_successive_replays_append_each_original_once(spark, make_log, tmp_path):
    log, tables = str(tmp_path / "log"), Tables(spark, str(tmp_path / "tables"))
    append_log(make_log([event(id="1", message="FORCE_DLQ"), event(id="2", message="FORCE_DLQ")]), log)
    done = 0
    for run in range(3):
        rows = read_log(spark, log)
        project_batch(rows.filter(F.col("offset") >= done), run, tables)
        done = rows.count()
        replay_to_log(spark, tables, log)
    offsets = sorted(r.offset for r in read_log(spark, log).collect())
    assert offsets == list(range(8))  # two originals and two more a run, without gaps
    origins = [r.headers.get("replayOrigin") for r in read_log(spark, log).collect()]
    assert sorted(filter(None, origins)) == ["incident-events/0/0"] * 3 + ["incident-events/0/1"] * 3


def test_a_poison_message_is_replayed_as_often_as_the_cap_says(spark, make_log, tmp_path):
    log, tables = str(tmp_path / "log"), Tables(spark, str(tmp_path / "tables"))
    append_log(make_log([event(id="1", message="FORCE_DLQ"), "{oops", event(id="2")]), log)
    done, seen = 0, []
    for run in range(5):
        rows = read_log(spark, log)
        project_batch(rows.filter(F.col("offset") >= done), run, tables)
        done = rows.count()
        replay_to_log(spark, tables, log, most=2)
        replay_to_log(spark, tables, log, most=2)  # no new batch, nothing new to append
        seen.append({r.origin: (r.replays, r.status) for r in replay_report(tables, most=2).collect()})
    raw = {"incident-events/0/1": (0, "not_replayable")}
    poison = lambda *state: {"incident-events/0/0": state, **raw}
    assert seen == [poison(1, "replayed"), poison(2, "replayed"), *[poison(2, "exhausted")] * 3]
    assert [r.headers for r in read_log(spark, log).filter("offset > 2").orderBy("offset").collect()] == [
        {"replayedFromDlq": "true", "replayOrigin": "incident-events/0/0"},
        {"replayedFromDlq": "true", "replayOrigin": "incident-events/0/0", "replayAttempt": "2"}]


def test_a_replay_that_waits_is_not_appended_again(spark, make_log, tmp_path):
    """A batch that does not hold the replayed messages is projected in between."""
    log, tables = str(tmp_path / "log"), Tables(spark, str(tmp_path / "tables"))
    append_log(make_log([event(id="1", message="FORCE_DLQ")]), log)
    project_batch(read_log(spark, log), 0, tables)
    replay_to_log(spark, tables, log)
    project_batch(make_log([event(id="other")], 50), 1, tables)
    replay_to_log(spark, tables, log)
    assert sorted(r.offset for r in read_log(spark, log).collect()) == [0, 1]


def messages_of(spark, values, partitions=3):
    rows = [("t", i % 2, v, v, {"h": "x"}) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "topic string, partition int, key string, value string, headers map<string,string>"
                                 ).repartition(partitions)


@pytest.mark.parametrize("ends", ["allotted", "staged", "moved", "before the mark"])
def test_a_publish_that_ended_half_way_is_repeated(spark, tmp_path, monkeypatch, ends):
    path, box = str(tmp_path / "log"), Outbox(spark, str(tmp_path / "log"))
    box.publish("a", messages_of(spark, ["1", "2", "3"]), [F.asc("value")])
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "7")  # several files a load
    moved, move = [], Outbox._move

    def failing(self, *names):
        moved.append(names)
        if len(moved) == 2:
            raise OSError("lost")
        move(self, *names)

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        if ends == "allotted":
            patch.setattr("sirenlog.sources.outbox.numbered", lost)
        elif ends == "staged":
            patch.setattr(Outbox, "_move", lost)
        elif ends == "moved":
            patch.setattr(Outbox, "_move", failing)
        else:
            patch.setattr(Outbox, "_touch", lost)
        with pytest.raises(OSError):
            box.publish("b", messages_of(spark, [f"b{i}" for i in range(40)], 8), [F.asc("value")])
    for _ in range(2):
        box.publish("b", messages_of(spark, [f"b{i}" for i in range(40)], 8), [F.asc("value")])
    spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    box.publish("c", messages_of(spark, ["c"]), [F.asc("value")])
    rows = read_log(spark, path).collect()
    assert sorted(r.value for r in rows) == sorted(["1", "2", "3", "c", *(f"b{i}" for i in range(40))])
    for partition in (0, 1):
        mine = sorted((r.offset, r.value) for r in rows if r.partition == partition)
        assert [o for o, _ in mine] == list(range(len(mine)))
        assert [v for _, v in mine][-1] == ("c" if partition == 0 else max(f"b{i}" for i in range(1, 40, 2)))


def test_offsets_come_from_the_allotments_alone(spark, make_log, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    append_log(make_log(["x", "y"], 5), path)  # a log without allotments is scanned once
    Outbox(spark, path).publish("a", messages_of(spark, ["1"]).withColumn("topic", F.lit("incident-events")), [F.asc("value")])
    monkeypatch.setattr("sirenlog.sources.outbox.read_log", None)
    Outbox(spark, path).publish("b", messages_of(spark, ["2", "3"]).withColumn("topic", F.lit("incident-events")), [F.asc("value")])
    assert sorted((r.partition, r.offset, r.value) for r in read_log(spark, path).collect()) == [
        (0, 5, "x"), (0, 6, "y"), (0, 7, "1"), (0, 8, "2"), (1, 0, "3")]
    with pytest.raises(ValueError):
        Outbox(spark, path).publish("a/b", messages_of(spark, ["1"]), [F.asc("value")])


def test_a_stream_reads_each_published_message_once(spark, tmp_path):
    path, target = str(tmp_path / "log"), str(tmp_path / "copy")
    for load in ("a", "b"):
        Outbox(spark, path).publish(load, messages_of(spark, [f"{load}{i}" for i in range(9)]), [F.asc("value")])
        publish_stream(stream_log(spark, path), str(tmp_path / "c"), target).awaitTermination()
    assert sorted(r.value for r in read_log(spark, target).collect()) == sorted(f"{x}{i}" for x in "ab" for i in range(9))


def test_published_stream_equals_its_source(spark, make_log, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    append_log(make_log([event(id="1"), "{oops", None]), source)
    for _ in range(2):
        publish_stream(stream_log(spark, source), str(tmp_path / "c"), target).awaitTermination()
    assert sorted(map(str, read_log(spark, target).collect())) == sorted(map(str, read_log(spark, source).collect()))
    with pytest.raises(ValueError):
        publish_stream(stream_log(spark, source), str(tmp_path / "d"))


def keyed_run(spark, folder, tables, **options):
    query = start_keyed_projection(
        stream_log(spark, f"{folder}/log"), tables.root, f"{folder}/ckpt", processed_at=now(), **options)
    assert wait_until_projected(query, 240)
    return query


def test_keyed_state_gives_the_tables_of_the_ledger(spark, streamed, make_log, tmp_path):
    values, tables = messages(), Tables(spark, f"{tmp_path}/tables")
    for low, high in ((0, 37), (37, 80), (80, len(values))):  # each run starts anew from the checkpoint
        append_log(make_log(values[low:high], low).coalesce(1), f"{tmp_path}/log")
        keyed_run(spark, tmp_path, tables)
    batch = Tables(spark, f"{tmp_path}/one_batch")
    project_batch(read_log(spark, f"{tmp_path}/log"), 0, batch, processed_at=now())
    assert contents(tables) == contents(batch)
    counts = {r.route: r.n for r in tables.read("outcomes").groupBy("route").agg(F.sum("n").alias("n")).collect() if r.n}
    assert counts == {r.route: r.n for r in routing.route_counts(parse_events(read_log(spark, f"{tmp_path}/log"))).collect()}


def test_keyed_state_knows_ids_that_come_back_at_smaller_positions(spark, tmp_path):
    tables = Tables(spark, f"{tmp_path}/tables")
    rows = [("incident-events", 3, 5, "a", 1), ("incident-events", 0, 0, "a", 2), ("incident-events", 1, 7, "b", 2),
            ("incident-events", 0, 9, "b", 3), ("incident-events", 2, 1, "a", 3)]
    for run in (1, 2, 3):
        part = [(t, p, o, None, event(id=i, message=f"run {n}"), {}) for t, p, o, i, n in rows if n == run]
        append_log(spark.createDataFrame(part, ENVELOPE).coalesce(1), f"{tmp_path}/log")
        keyed_run(spark, tmp_path, tables)
    assert sorted((r.event_id, r.message) for r in tables.read("timeline").collect()) == [("a", "run 1"), ("b", "run 2")]
    assert {(r.batch_id, r.route): r.n for r in tables.all_batches("outcomes").collect() if r.n} == {
        (0, "projected_full"): 1, (1, "projected_full"): 1, (1, "duplicate"): 1, (2, "duplicate"): 2}


def test_keyed_batch_repeated_after_a_failure(spark, make_log, tmp_path, monkeypatch):
    """The second batch fails when half of its tables are written; the next run repeats it from the same state."""
    tables, write = Tables(spark, f"{tmp_path}/tables"), Tables.write
    append_log(make_log([event(id="1"), event(id="2")]).coalesce(1), f"{tmp_path}/log")
    keyed_run(spark, tmp_path, tables, after_mark_failure="quarantine")
    append_log(make_log([event(id="2"), event(id="3"), event(id="4", timestamp="bad")], 2).coalesce(1), f"{tmp_path}/log")

    def failing(self, name, batch_id, rows):
        if name == "artifacts":
            raise OSError("lost")
        write(self, name, batch_id, rows)

    with monkeypatch.context() as patch:
        patch.setattr(Tables, "write", failing)
        with pytest.raises(Exception, match="lost"):
            keyed_run(spark, tmp_path, tables, after_mark_failure="quarantine")
    assert sorted(r.event_id for r in tables.read("timeline").collect()) == ["1", "2"]
    keyed_run(spark, tmp_path, tables, after_mark_failure="quarantine")
    assert sorted(r.event_id for r in tables.read("timeline").collect()) == ["1", "2", "3"]
    assert [r.originalOffset for r in tables.read("dead_letters").collect()] == ["4"]
    assert sorted(r.message_id for r in tables.read("ledger").collect()) == ["1", "2", "3", "4"]


def newest_of(rows, limit, limit_given=True):
    """The newest events of one incident, plainly."""
    ordered = sorted(rows, key=lambda r: (r.event_timestamp is None, -(r.event_timestamp or now_time()).timestamp(), r.event_id))
    keep = 20 if not limit_given else int(limit) if limit >= 0 else max(0, len(rows) + int(limit))
    return [(i, r.event_id) for i, r in enumerate(ordered[:keep], 1)]


def now_time():
    return datetime.datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def timeline_tables(spark, tmp_path_factory):
    """Four batches of events, out of order, one hot incident, some events without a time."""
    tables, rng = Tables(spark, f"{tmp_path_factory.mktemp('newest')}/tables"), random.Random(5)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", "c"]),
             None if rng.random() < 0.02 else now_time() + datetime.timedelta(seconds=rng.randrange(5000)),
             f"e{i}", "t", "m") for i in range(3000)]
    for batch in range(4):
        part = rows[batch * 750:(batch + 1) * 750]
        tables.write("timeline", batch, spark.createDataFrame(part, TIMELINE).repartition(8))
        tables.write("outcomes", batch, spark.createDataFrame([("x", 1)], "route string, n bigint"))
    return tables


LIMITS = [("hot", 5.0, True), ("hot", 1.0, False), ("hot", -2400.0, True), ("hot", 1e9, True), ("a", 3.0, True),
          ("b", -1.0, True), ("c", 0.0, True), ("none", 4.0, True), ("", 4.0, True)]


def check_newest(spark, tables):
    asked = spark.createDataFrame([(f"r{i}", *x[:1], None, *x[1:]) for i, x in enumerate(LIMITS)], SUMMARY_REQUEST)
    got = {}
    for r in tables.recent_events(asked).collect():
        got.setdefault(r.request_id, []).append((r.position, r.event_id))
    rows = tables.read("timeline").collect()
    want = {f"r{i}": newest_of([r for r in rows if r.incident_id == x[0]], *x[1:]) for i, x in enumerate(LIMITS)}
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}


def test_newest_events_through_the_index(spark, timeline_tables):
    check_newest(spark, timeline_tables)


def test_newest_events_open_only_the_files_that_hold_them(spark, tmp_path):
    tables = Tables(spark, f"{tmp_path}/tables")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "50")
    for batch in range(4):  # in order of time, so that old files hold nothing new
        rows = [("hot", now_time() + datetime.timedelta(seconds=1000 * batch + i), f"{batch}-{i}", "t", "m") for i in range(1000)]
        tables.write("timeline", batch, spark.createDataFrame(rows, TIMELINE))
        tables.write("outcomes", batch, spark.createDataFrame([("x", 1)], "route string, n bigint"))
    spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    index = tables.read("timeline_index")
    assert index.count() >= 80
    asked = spark.createDataFrame([("r", "hot", None, 60.0, True)], SUMMARY_REQUEST)
    kept = newest.kept_by_index(index, asked)
    assert len(newest.needed_files(index, newest.needed_from(index, kept))) <= 2
    assert [r.event_id for r in tables.recent_events(asked).orderBy("position").collect()] == [f"3-{i}" for i in range(999, 939, -1)]


def test_newest_events_after_compaction(spark, timeline_tables):
    timeline_tables.compact("timeline")
    assert timeline_tables.folders("timeline_index") == ["batch_id=3"]
    assert timeline_tables.folders("compacted_timeline_index") == ["through=2"]
    check_newest(spark, timeline_tables)


def test_one_organisation_is_read_from_its_files(spark, tmp_path):
    tables = Tables(spark, f"{tmp_path}/tables")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "10")
    arrival = lambda b, i: (b, 0, i)
    for batch in range(3):
        rows = [(f"org-{o:03}", f"svc-{s}", "i", f"e{batch}", "LOW", "ACTIVE", now_time(), "m", arrival(batch, s), arrival(batch, s))
                for o in range(100) for s in range(2)]
        tables.write("health_changes", batch, spark.createDataFrame(rows, HEALTH_CHANGES).repartition(6))
        tables.write("outcomes", batch, spark.createDataFrame([("x", 1)], "route string, n bigint"))
    tables.compact("health_changes")
    spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    one = tables.health("org-042")
    assert sorted((r.service_name, r.latest_event_id) for r in one.collect()) == [("svc-0", "e2"), ("svc-1", "e2")]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(org_id,org-042)") >= 2
    # Row groups that cannot hold the organisation give no rows.
    scans = scans_of(one._jdf.queryExecution().executedPlan())
    assert sum(s.metrics().apply("numOutputRows").value() for s in scans) <= 40  # of 400
