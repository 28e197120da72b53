import json

import pytest
from pyspark.sql import functions as F

from sirenlog.llm import canonical_json as cj
from sirenlog.llm import tool_calls as t

SCHEMA = {"type": "object", "required": ["q"], "additionalProperties": False, "properties": {
    "q": {"type": "string", "minLength": 2, "maxLength": 5, "pattern": "^[a-z]"}, "n": {"type": ["integer", "null"], "minimum": 1, "maximum": 9},
    "kind": {"enum": ["a", 1]}, "list": {"type": "array", "items": {"type": "number"}}, "flag": {"type": "boolean"}}}


@pytest.mark.parametrize("value, text", [
    ({"b": 1, "a": [True, None, "é\n\"\\"]}, '{"a":[true,null,"é\\n\\"\\\\"],"b":1}'),
    ({"\U0001F600": 1, "דּ": 2, "ö": 3}, '{"ö":3,"\U0001F600":1,"דּ":2}'),
    ([1.0, -0.0, 1e21, 1e-7, 0.000001, 1.5e300, 123456.789, 1e20], "[1,0,1e+21,1e-7,0.000001,1.5e+300,123456.789,100000000000000000000]"),
    ({}, "{}"), ([], "[]"), ("", '""'), (12345678901234567890, "12345678901234567890"),
])
def test_canonical_text(value, text):
    assert cj.dump(value) == text
    assert json.loads(text) == value


@pytest.mark.parametrize("text", ["", "{", "NaN", '{"a":1,"a":2}', "[1e999]", "{'a':1}", "1 2"])
def test_no_canonical_form(text):
    assert t.check_arguments("f", text, {"f": {}})[0] is None


@pytest.mark.parametrize("value, wrong", [
    ({"q": "abc"}, []), ({"q": "abc", "n": None, "kind": 1, "list": [1, 2.5], "flag": True}, []),
    ({}, ["$.q: missing"]), ({"q": "a"}, ["$.q: too short"]), ({"q": "ABC"}, ["$.q: does not match"]),
    ({"q": "abcdef", "x": 1}, ["$.q: too long", "$.x: not expected"]), ([], ["$: not object"]),
    ({"q": "abc", "n": 0}, ["$.n: too small"]), ({"q": "abc", "n": 10}, ["$.n: too large"]), ({"q": "abc", "n": True}, ["$.n: not integer or null"]),
    ({"q": "abc", "n": 2.0}, []), ({"q": "abc", "kind": "b"}, ["$.kind: not one of the listed values"]),
    ({"q": "abc", "list": [1, "x"]}, ["$.list[1]: not number"]), ({"q": {"$ref": "c1"}}, []), ({"$ref": "c1"}, ["$.q: missing", "$.$ref: not expected"]),
])
def test_schema(value, wrong):
    assert cj.violations(value, SCHEMA) == wrong


def test_levels():
    assert t.levels_of([("a", []), ("b", ["a"]), ("c", ["a", "b"]), ("d", ["gone"]), ("e", ["f"]), ("f", ["e"]), ("g", ["e"])]) == {
        "a": 0, "b": 1, "c": 2, "d": 0}


def _link(spark, calls, results):
    c = spark.createDataFrame(calls, "conv_id long, turn long, place int, call_id string, name string, arguments string").repartition(3)
    r = spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string").repartition(2)
    return t.link_calls(c.withColumn("status", F.lit("x")), r.withColumn("level", F.lit(9)), {"f": {}, "g": SCHEMA}).collect()


ref = lambda *ids: json.dumps([{"$ref": i} for i in ids])

CALLS = [
    (1, 1, 0, "a", "f", ref("b")), (1, 1, 1, "b", "f", '{"z": 1, "y": "é"}'), (1, 3, 0, "c", "f", ref("a", "b", "zz")),
    (1, 5, 0, "a", "f", "{}"), (1, 7, 0, "d", "g", '{"n": 0}'), (1, 9, 0, "e", "f", ref("h")), (1, 9, 1, "h", "f", ref("e")),
    (2, 1, 0, "a", "nope", None), (2, 3, 0, None, "f", "1"), (None, 1, 0, "a", "f", "1"), (3, 1, 0, "s", "f", ref("s")),
    (4, 1, 0, "q", None, "1"), (4, 1, 0, "q", None, "1"),
]
RESULTS = [(1, 2, "a", "ra"), (1, 4, "b", None), (1, 6, "a", "later"), (2, 2, "b", "lost"), (1, 8, "x", "orphan"), (5, 1, None, "no id")]


@pytest.mark.parametrize("whole", [5000, 0])
def test_linking(spark, monkeypatch, whole):
    monkeypatch.setattr(t, "WHOLE", whole)
    rows = _link(spark, CALLS, RESULTS)
    got = {(r.conv_id, r.call_id, r.turn): r for r in rows}
    assert len(rows) == len(CALLS) + 4
    want = {
        (1, "a", 1): (1, "linked", []), (1, "b", 1): (0, "linked", []), (1, "c", 3): (2, "no_result", ["no call zz"]),
        (1, "a", 5): (None, "repeated_call", []), (1, "d", 7): (0, "no_result", ["$.q: missing", "$.n: too small"]),
        (1, "e", 9): (None, "no_result", ["references form a circle"]), (1, "h", 9): (None, "no_result", ["references form a circle"]),
        (2, "a", 1): (0, "no_result", ["$: no JSON"]), (2, None, 3): (None, "unlinked", []), (None, "a", 1): (None, "unlinked", []),
        (3, "s", 1): (None, "no_result", ["references form a circle"]), (1, "a", 6): (None, "repeated_result", []),
        (2, "b", 2): (None, "orphan_result", []), (1, "x", 8): (None, "orphan_result", []), (5, None, 1): (None, "orphan_result", []),
    }
    for key, (level, status, errors) in want.items():
        assert (got[key].level, got[key].status, list(got[key].errors)) == (level, status, errors), key
    assert got[1, "b", 1].message == '{"call":{"arguments":{"y":"é","z":1},"id":"b","name":"f"},"result":{"content":null,"id":"b"}}'
    assert got[1, "x", 8].message == '{"result":{"content":"orphan","id":"x"}}'
    for r in rows:
        assert cj.dump(json.loads(r.message)) == r.message


def test_a_long_chain_either_way(spark, monkeypatch):
    calls = [(1, i, 0, f"c{i}", "f", ref(f"c{i + 1}") if i < 6 else "1") for i in range(7)]
    for whole in (5000, 3):
        monkeypatch.setattr(t, "WHOLE", whole)
        assert {r.turn: r.level for r in _link(spark, calls, [])} == {i: 6 - i for i in range(7)}


def test_empty(spark):
    assert _link(spark, [], []) == []


def test_results_that_tie_are_all_reported(spark):
    calls = [(1, 1, 0, c, "f", "1") for c in "abcd"]
    results = [(1, 2, "a", "x"), (1, 2, "a", "y"), (1, 2, "a", None), (1, 4, "a", "z"), (1, 2, "b", "same"), (1, 2, "b", "same"),
               (1, 2, "b", "same"), (1, None, "c", "p"), (1, None, "c", "q"), (1, None, "d", "late"), (1, 3, "d", "early")]
    rows = _link(spark, calls, results)
    assert len(rows) == len(results)
    content = lambda r: json.loads(r.message)["result"]["content"]
    for call in "abcd":
        mine = [r for r in rows if r.call_id == call]
        linked = [r for r in mine if r.status == "linked"]
        assert len(linked) == 1 and all(r.status == "repeated_result" for r in mine if r is not linked[0])
        assert sorted((content(r) for r in mine), key=str) == sorted((c for _, _, i, c in results if i == call), key=str)
        later = [(r.turn, content(r)) for r in mine if r is not linked[0]]
        given = [(turn, c) for _, turn, i, c in results if i == call]
        assert all(x in given for x in later)
    first = {r.call_id: content(r) for r in rows if r.status == "linked"}
    assert first["a"] in ("x", "y") and first["b"] == "same" and first["d"] == "early"


@pytest.mark.parametrize("text, error", [
    ("[" * 2000 + "]" * 2000, "nested too deeply"), ('{"a":' * 100_000 + "1" + "}" * 100_000, "nested too deeply"),
    ("9" * 5000, "number out of range"), ('{"a": "\\ud800"}', "half a surrogate pair"), ('{"\\udc00": 1}', "half a surrogate pair"),
    ("1e999", "number out of range"),
])
def test_odd_arguments_are_errors_of_their_row(text, error):
    assert t.check_arguments("f", text, {"f": {}}) == (None, [f"$: {error}"], [])


def test_arguments_at_the_depth_limit():
    text = "[" * cj.DEPTH + "]" * cj.DEPTH
    assert t.check_arguments("f", text, {"f": {"items": {"type": "array"}}}) == (text, [], [])
    assert t.check_arguments("f", '"\\ud83d\\ude00"', {"f": {}})[0] == '"\U0001F600"'
