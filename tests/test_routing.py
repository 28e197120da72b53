"""Routing truth table, first-seen semantics, and skewed ids against brute force."""

import json
import random

import pytest
from pyspark.sql import functions as F

from sirenlog.functions import strict_json as sj
from sirenlog.operators import routing
from sirenlog.operators.parsing import parse_events
from sirenlog.schemas import ENVELOPE


def event(**changes):
    base = dict(id="a", incidentId="i", orgId="o", serviceName="s", severity="HIGH", type="INCIDENT_REPORTED",
                message="m", timestamp="2026-04-24T15:30:00.000Z")
    base.update(changes)
    return json.dumps({k: v for k, v in base.items() if v is not ...})


ART = dict(type="ARTIFACT_ATTACHED", artifact=dict(bucket="b", objectKey="k", originalName="n", mimeType="t", size=3))

SINGLE = [
    ('{"id":"a","message":"m"} trailing', "dlq_raw"),
    ("{'id':'a'}", "dlq_raw"),
    ("", "dlq_raw"),
    (None, "dlq_raw"),
    ("null", "dlq_raw"),
    (" null ", "dlq_raw"),
    ('{"id":"a","message":"m"},{"id":"b","message":"m"}', "dlq_raw"),
    ('{"id":"a","message":"m"}],[1', "dlq_raw"),
    ('{"id":"a","message":"m","x":NaN}', "dlq_raw"),
    ('{"id":"a","message":"m",}', "dlq_raw"),
    ("5", "dlq_message"),
    ('"x"', "dlq_message"),
    ("[1]", "dlq_message"),
    (event(message=5), "dlq_message"),
    (event(message={}), "dlq_message"),
    (event(message=True), "dlq_message"),
    (event(message=None), "dlq_message"),
    (event(message=...), "dlq_message"),
    (event(message=["FORCE_DLQ"]), "dlq_message"),
    (event(message="a FORCE_DLQ b"), "dlq_message"),
    (event(message="force_dlq"), "projected_full"),
    (event(message="true"), "projected_full"),
    (event(message="12"), "projected_full"),
    (event(message="[FORCE]"), "projected_full"),
    (event(id=...), "dlq_message"),
    (event(id=None), "dlq_message"),
    (event(id=7), "dlq_message"),
    (event(id="7"), "projected_full"),
    (event(id=""), "projected_full"),
    (event(type="OTHER"), "ignored_type"),
    (event(type=...), "ignored_type"),
    (event(type=5), "ignored_type"),
    (event(incidentId=""), "lost_after_mark"),
    (event(incidentId=...), "lost_after_mark"),
    (event(incidentId=5), "lost_after_mark"),
    (event(timestamp="not-a-time"), "lost_after_mark"),
    (event(timestamp="15:30:00"), "lost_after_mark"),
    (event(timestamp=...), "lost_after_mark"),
    (event(timestamp=None), "projected_full"),
    (event(timestamp=1700000000000), "projected_full"),
    (event(timestamp="2026-04-24T15:30Z"), "projected_full"),
    (event(timestamp="2026-04-24"), "projected_full"),
    (event(timestamp="2026-04-24 15:30:00"), "projected_full"),
    (event(timestamp="2026-04-24 15:30:00 GMT"), "projected_full"),
    (event(timestamp="2026-04-24T15:30:00+0000"), "projected_full"),
    (event(timestamp="Fri, 24 Apr 2026 15:30:00 GMT"), "projected_full"),
    (event(timestamp="24 Apr 2026 15:30:00 +0200"), "projected_full"),
    (event(timestamp="Fri, 24 Foo 2026 15:30:00 GMT"), "lost_after_mark"),
    (event(message=["x"]), "lost_after_mark"),
    (event(orgId=""), "projected_timeline_only"),
    (event(orgId=5), "projected_timeline_only"),
    (event(serviceName=None), "projected_timeline_only"),
    (event(serviceName=""), "projected_full"),
    (event(severity=5), "projected_timeline_only"),
    (event(severity=None), "projected_full"),
    (event(severity=...), "projected_full"),
    (event(**ART), "projected_artifact"),
    (event(**{**ART, "message": ["x"]}), "projected_artifact"),
    (event(**{**ART, "artifact": None}), "lost_after_mark"),
    (event(**{**ART, "artifact": ...}), "lost_after_mark"),
    (event(**{**ART, "artifact": {}}), "projected_artifact"),
    (event(**{**ART, "artifact": 5}), "projected_artifact"),
    (event(**{**ART, "artifact": {"bucket": 5}}), "lost_after_mark"),
    (event(**{**ART, "artifact": {"size": "12"}}), "projected_artifact"),
    (event(**{**ART, "artifact": {"size": "x"}}), "lost_after_mark"),
    (event(**{**ART, "timestamp": "x"}), "lost_after_mark"),
]


def test_each_message_alone(spark, make_log):
    parsed = parse_events(make_log([v for v, _ in SINGLE]))
    got = {r.offset: r.verdict for r in parsed.select("offset", "verdict").collect()}
    wrong = [(v, want, got[i]) for i, (v, want) in enumerate(SINGLE) if got[i] != want]
    assert not wrong


SEQUENCES = [
    ([event(type="OTHER"), event()], ["ignored_type", "duplicate"]),
    ([event(timestamp="bad"), event()], ["lost_after_mark", "duplicate"]),
    ([event(message="FORCE_DLQ"), event()], ["dlq_message", "projected_full"]),
    ([event(), event(message="FORCE_DLQ"), event()], ["projected_full", "dlq_message", "duplicate"]),
    (['{"id":"a","id":"b","message":"m"}', event(id="b"), event(id="a")],
     ["ignored_type", "duplicate", "projected_full"]),
]


@pytest.mark.parametrize("values,routes", SEQUENCES)
def test_sequences(make_log, values, routes):
    rows = routing.route_events(parse_events(make_log(values))).orderBy("offset").collect()
    assert [r.route for r in rows] == routes


def test_ledger_makes_duplicates(spark, make_log):
    ledger = spark.createDataFrame(
        [(routing.CONSUMER_GROUP, "a"), ("another-group", "b")], "consumer_group string, message_id string")
    rows = routing.route_events(parse_events(make_log([event(), event(id="b")])), ledger).orderBy("offset").collect()
    assert [r.route for r in rows] == ["duplicate", "projected_full"]


@pytest.mark.parametrize("seed", [1, 2])
def test_hot_id_and_shuffled_arrival_match_brute_force(spark, make_log, seed):
    """A third of all messages carry one id, over two log partitions, in any physical order."""
    rng = random.Random(seed)
    rows = []
    for offset in range(900):
        name = "hot" if rng.random() < 1 / 3 else f"e{rng.randrange(300)}"
        kind = rng.choice(["INCIDENT_REPORTED", "OTHER"])
        message = "FORCE_DLQ" if rng.random() < 0.1 else "m"
        rows.append(("t", rng.randrange(2), offset, None, event(id=name, type=kind, message=message), {}))
    rng.shuffle(rows)
    seen, want = set(), {}
    for _, partition, offset, _, value, _ in sorted(rows, key=lambda r: (r[1], r[2])):
        body = json.loads(value)
        if "FORCE_DLQ" in body["message"]:
            want[offset] = "dlq_message"
        elif body["id"] in seen:
            want[offset] = "duplicate"
        else:
            seen.add(body["id"])
            want[offset] = "projected_full" if body["type"] == "INCIDENT_REPORTED" else "ignored_type"
    log = spark.createDataFrame(rows, make_log([]).schema).repartition(5)
    parsed = parse_events(log)
    assert {r.offset: r.route for r in routing.route_events(parsed).collect()} == want
    counts = {r.route: r.n for r in routing.route_counts(parsed).collect()}
    assert counts == {route: list(want.values()).count(route) for route in set(want.values())}
    firsts = routing.first_deliveries(parsed, ("offset",)).select("offset").collect()
    assert {r.offset for r in firsts} == {o for o, route in want.items() if not route.startswith(("dlq", "dup"))}


def test_text_is_parsed_once_under_filters(make_log):
    parsed = parse_events(make_log([event()])).filter(F.col("verdict") == "projected_full").select("event_id")
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    # Long struct lists are cut in the plan's text, so the descriptor's parse may not show.
    assert 1 <= plan.count("parseJson") <= 2
    assert plan.index("Filter (verdict") < plan.index("Generate inline")
    assert "Python" not in plan


def test_two_topics_at_one_position_stay_two_messages(spark):
    rows = [(t, 0, 5, None, event(id=t), {}) for t in ("t1", "t2")]
    log = spark.createDataFrame(rows, ENVELOPE)
    routes = routing.route_events(parse_events(log)).collect()
    assert [r.route for r in routes] == ["projected_full"] * 2
    same = spark.createDataFrame([(t, 0, 5, None, event(), {}) for t in ("t1", "t2")], ENVELOPE)
    assert sorted(r.route for r in routing.route_events(parse_events(same)).collect()) == ["duplicate", "projected_full"]
    assert {r.route: r.n for r in routing.route_counts(parse_events(same)).collect()} == {"duplicate": 1, "projected_full": 1}


def test_date_spellings_give_one_time(spark):
    from sirenlog.functions.timestamps import iso_millis, parse_iso

    texts = ["2026-04-24T15:30:00.000Z", "2026-04-24 15:30:00", "2026-04-24T15:30:00+0000", "2026-04-24 17:30:00+0200",
             "2026-04-24 15:30 UTC", "Fri, 24 Apr 2026 15:30:00 GMT", "24 Apr 2026 17:30:00 +0200"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(F.expr(parse_iso("t")).alias("ts"))
    assert {r[0] for r in frame.select(iso_millis(F.col("ts"))).collect()} == {"2026-04-24T15:30:00.000Z"}


def test_a_size_of_nineteen_digits(spark, make_log):
    log = make_log([event(**{**ART, "artifact": {"size": size}}) for size in (2**63 - 1, str(2**63 - 1), "9" * 19)])
    got = parse_events(log).orderBy("offset").select("verdict", "artifact.size").collect()
    assert [tuple(r) for r in got] == [("projected_artifact", 2**63 - 1)] * 2 + [("lost_after_mark", None)]


def test_a_field_that_is_only_absent_needs_no_second_parse(spark):
    event = sj.JsonObject("value", ("id", "severity"))
    rows = [
        ('{"id":"a"}', False, None), ('{"id":"a","severity":null}', True, "VOID"), ('{"id":"a","severity":"x"}', False, "STRING"),
        ('{"id":"a","\\u0073everity":7}', True, "BIGINT"), ('{"id":"a","\\u0073everity":null}', True, "VOID"),
        ('{"id":"a","other":{"severity":1}}', True, None), ('{"id":"a\\\\"}', True, None), ('{"id":"a","Severity":1}', False, None),
        ("null", True, None), ("[]", True, None), ('"severity"', True, None), ("7", True, None), ("{}", False, None),
        ('{"id":null,"severity":"x","severity":null}', True, "VOID"),
    ]
    texts = spark.createDataFrame([(text,) for text, _, _ in rows], "value string")
    read = texts.selectExpr("value", "from_json(value, 'id string, severity string') AS typed").selectExpr(
        "value", "if(value LIKE '{%', typed, NULL) AS __value_first").selectExpr(
            "value", f"{event._doubtful('severity')} AS doubt")
    assert {r.value: r.doubt for r in read.collect()} == {text: doubt for text, doubt, _ in rows}
    kinds = event.attach(texts).selectExpr(
        "value", f"{event.kind('severity')} AS kind", f"{event.is_null()} AS empty", f"{event.is_valid()} AS valid")
    got = {r.value: r for r in kinds.collect()}
    assert {text: got[text].kind for text, _, _ in rows} == {text: kind for text, _, kind in rows}
    assert all(r.valid for r in got.values()) and [t for t, r in got.items() if r.empty] == ["null"]
