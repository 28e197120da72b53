"""Tool-call linking for chat formatting.

Calls and results of a conversation meet by identifier in a hash join.  The
first call and the first result of an identifier count; later ones are reported
as repeated.  Arguments are checked against the schema of their tool, and the
pair is written as canonical JSON.  A call whose arguments hold
``{"$ref": id}`` comes after the call with that id: ``level`` is the length of
the longest chain of such references before it, and (level, turn, place) is a
topological order.  Calls on a circle have no level.

Conversations of up to WHOLE calls are ordered in one piece each, many to a
task; larger ones in rounds of joins, one round a level, so that no
conversation has to fit in a task.

Defined results: calls without an id or conversation are never linked (status
``unlinked``), results without one are orphans; null arguments are no JSON;
a reference to an id that the conversation lacks, or to a repeated one's later
copy, is an error and orders nothing; equal rows are separate, the first in the
order of (turn, place) counts, and of wholly equal ones all are alike.  Results
of one turn have no place: those with content come first, in the order of a hash
of it, and every result but the first is reported, equal ones by their count.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sirenlog.llm import canonical_json as cj
from sirenlog.llm.common import materialize

WHOLE = 5_000
CALL_COLUMNS = ("conv_id", "turn", "place", "call_id", "name", "arguments")
RESULT_COLUMNS = ("conv_id", "turn", "call_id", "content")
_CHECKED = T.StructType([
    T.StructField("canonical", T.StringType()), T.StructField("errors", T.ArrayType(T.StringType())),
    T.StructField("refs", T.ArrayType(T.StringType()))])


def check_arguments(name: str | None, arguments: str | None, schemas: dict[str, Any]) -> tuple[str | None, list[str], list[str]]:
    """Canonical arguments (None if there are none), what is wrong with them, and the ids they refer to."""
    try:
        value = cj.parse(arguments if arguments is not None else "")
        canonical = cj.dump(value)
    except cj.Invalid as error:
        return None, [f"$: {error}"], []
    errors = [f"no tool {name}"] if name not in schemas else cj.violations(value, schemas[name])
    return canonical, errors, cj.references(value)


def _checked(calls: DataFrame, schemas: dict[str, Any]) -> DataFrame:
    names = calls.columns
    schema = T.StructType([*calls.schema.fields, *_CHECKED.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [check_arguments(n.as_py(), a.as_py(), schemas)
                   for n, a in zip(batch.column("name"), batch.column("arguments"))]
            columns = list(zip(*out)) if out else [[], [], []]
            lists = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(columns[0], pa.string()), pa.array(columns[1], lists),
                 pa.array(columns[2], lists)], [*names, "canonical", "errors", "refs"])

    return calls.mapInArrow(run, schema)


def levels_of(calls: list[tuple[str, list[str]]]) -> dict[str, int]:
    """The level of each call of one conversation; calls on or behind a circle are missing."""
    known = dict(calls)
    after: dict[str, list[str]] = {}
    waits = {}
    for call, refs in known.items():
        needed = [r for r in refs if r in known]
        waits[call] = len(needed)
        for r in needed:
            after.setdefault(r, []).append(call)
    level = {call: 0 for call, n in waits.items() if n == 0}
    todo = list(level)
    for call in todo:  # grows while it is read; a call joins when its last reference is placed
        for later in after.get(call, ()):
            waits[later] -= 1
            if waits[later] == 0:
                level[later] = 1 + max(level[r] for r in known[later] if r in known)
                todo.append(later)
    return level


def topological_levels(nodes: DataFrame) -> DataFrame:
    """``conv_id``, ``call_id`` and ``level`` of (conv_id, call_id, refs) rows with unique ids; circles are left out."""
    sizes = nodes.groupBy("conv_id").agg((F.count(F.lit(1)) > WHOLE).alias("large"))
    nodes = materialize(nodes.join(sizes, "conv_id"), "tool-nodes")
    schema = T.StructType([nodes.schema["conv_id"], nodes.schema["call_id"], T.StructField("level", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, conversation = [], None
        keys: list[Any] = []

        def ordered() -> pa.RecordBatch:
            level = levels_of(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([conversation] * len(level), kind), pa.array(list(level), pa.string()),
                 pa.array(list(level.values()), pa.int32())], schema.names)

        for batch in batches:
            kind = batch.column("conv_id").type
            keys = batch.column("conv_id").to_pylist()
            for key, call, refs in zip(keys, batch.column("call_id").to_pylist(), batch.column("refs").to_pylist()):
                if key != conversation:
                    if held:
                        yield ordered()
                    held, conversation = [], key
                held.append((call, refs))
        if held:
            yield ordered()

    small = nodes.filter("NOT large").select("conv_id", "call_id", "refs").repartition("conv_id").sortWithinPartitions(
        "conv_id", "call_id").mapInArrow(run, schema)
    large = nodes.filter("large").select("conv_id", "call_id", "refs")
    return small if large.isEmpty() else small.unionByName(_levels_by_rounds(large))


def _levels_by_rounds(nodes: DataFrame) -> DataFrame:
    """One join a level: a call is placed once all calls it refers to are."""
    ids = nodes.select("conv_id", F.col("call_id").alias("ref"))
    edges = materialize(nodes.select("conv_id", "call_id", F.explode("refs").alias("ref")).join(
        ids, ["conv_id", "ref"]), "tool-edges")
    bound = edges.select("conv_id", "call_id").distinct()
    placed = materialize(nodes.join(bound, ["conv_id", "call_id"], "left_anti").select(
        "conv_id", "call_id", F.lit(0).alias("level")), "tool-levels")
    parts, depth, new = [placed], 0, placed
    while not new.isEmpty():
        depth += 1
        done = new.select("conv_id", F.col("call_id").alias("ref"))
        met = edges.join(done, ["conv_id", "ref"], "left_semi")
        edges_left = materialize(edges.join(done, ["conv_id", "ref"], "left_anti"), "tool-edges")
        new = materialize(met.select("conv_id", "call_id").distinct().join(
            edges_left.select("conv_id", "call_id").distinct(), ["conv_id", "call_id"], "left_anti"
        ).withColumn("level", F.lit(depth)), "tool-levels")
        edges = edges_left
        parts.append(new)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, Any]) -> DataFrame:
    """One row per call, and one per result that belongs to none.

    ``conv_id``, ``call_id``, ``turn``, ``place``, ``name``, ``level``,
    ``status`` (linked, no_result, repeated_call, repeated_result, orphan_result,
    unlinked), ``errors`` and ``message``, the canonical JSON of the call and its result.
    """
    calls = calls.select(*CALL_COLUMNS)
    results = results.select(*RESULT_COLUMNS)
    key = ["conv_id", "call_id"]
    has_key = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    checked = materialize(_checked(calls, schemas), "tool-checked")
    # The first of each identifier, found before any payload moves.
    first_call = checked.filter(has_key).groupBy(key).agg(F.min(F.struct("turn", "place")).alias("first"))
    order = F.struct(F.col("turn").isNull().alias("late"), "turn", F.col("content").isNull().alias("bare"),
                     F.xxhash64("content").alias("tie"))
    first_result = results.filter(has_key).groupBy(key).agg(F.min(order).alias("first_result"))
    is_first = order.eqNullSafe(F.col("first_result"))
    answers = results.join(first_result, key).filter(is_first).groupBy(key).agg(
        F.min("content").alias("content"), F.lit(True).alias("answered"), F.min("turn").alias("first_turn"),
        F.count(F.lit(1)).alias("equal_results"))
    nodes = checked.join(first_call, key).filter(F.struct("turn", "place").eqNullSafe(F.col("first"))).groupBy(key).agg(
        F.min("refs").alias("refs"))
    levels = topological_levels(nodes)

    known = first_call.select("conv_id", F.col("call_id").alias("ref"), F.lit(True).alias("exists"))
    lost = checked.filter(has_key).select("conv_id", "call_id", "turn", "place", F.explode("refs").alias("ref")).join(
        known, ["conv_id", "ref"], "left_anti").groupBy("conv_id", "call_id", "turn", "place").agg(
            F.array_sort(F.collect_set(F.concat(F.lit("no call "), "ref"))).alias("lost"))

    ranked = checked.join(first_call.hint("shuffle_hash"), key, "left").withColumn(
        "repeated", ~F.struct("turn", "place").eqNullSafe(F.col("first")) & F.col("first").isNotNull()).drop("first")
    answer = answers.drop("first_turn", "equal_results")
    met = ranked.join(answer.hint("shuffle_hash"), key, "left").join(levels.hint("shuffle_hash"), key, "left")
    same = [met[c].eqNullSafe(lost[c]) for c in ("turn", "place")]
    met = met.join(lost, [met["conv_id"] == lost["conv_id"], met["call_id"] == lost["call_id"], *same], "left").select(
        met["*"], F.coalesce("lost", F.array().cast("array<string>")).alias("lost"))
    status = (F.when(~has_key, "unlinked").when(F.col("repeated"), "repeated_call")
              .when(F.col("answered"), "linked").otherwise("no_result"))
    met = met.withColumn("status", status)
    linked = met.select(
        "conv_id", "call_id", "turn", "place", "name",
        F.when(F.col("status").isin("linked", "no_result"), F.col("level")).alias("level"), "status",
        F.array_compact(F.concat("errors", "lost", F.when(
            F.col("status").isin("linked", "no_result") & F.col("level").isNull(),
            F.array(F.lit("references form a circle"))).otherwise(F.array().cast("array<string>")))).alias("errors"),
        F.when(F.col("status") == "linked", F.col("content")).alias("content"), "canonical")
    first_only = results.join(first_call, key, "left_semi")
    spare = first_only.join(first_result, key).filter(~is_first).select(*results.columns).unionByName(
        answers.filter("equal_results > 1").join(first_call, key, "left_semi").withColumn(
            "copy", F.explode(F.sequence(F.lit(2), "equal_results"))).withColumnRenamed(
                "first_turn", "turn").select(*results.columns)).withColumn("status", F.lit("repeated_result"))
    orphans = results.join(first_call, key, "left_anti").withColumn("status", F.lit("orphan_result"))
    none = [F.lit(None).cast(linked.schema[c].dataType).alias(c) for c in ("place", "name", "level")]
    rest = spare.select(*orphans.columns).unionByName(orphans).select(
        "conv_id", "call_id", "turn", *none, "status", F.array().cast("array<string>").alias("errors"), "content",
        F.lit(None).cast("string").alias("canonical"))
    return _written(linked.unionByName(rest))


def _written(rows: DataFrame) -> DataFrame:
    """Adds ``message`` in place of its parts."""
    names = [c for c in rows.columns if c not in ("content", "canonical")]
    schema = T.StructType([rows.schema[c] for c in names] + [T.StructField("message", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = {c: batch.column(c).to_pylist() for c in ("call_id", "name", "status", "content", "canonical")}
            texts = []
            for call_id, name, status, content, canonical in zip(*read.values()):
                parts = []
                if status not in ("orphan_result", "repeated_result"):
                    # Canonical arguments go in as they are; the key order is that of the canonical form.
                    parts.append(f'"call":{{"arguments":{canonical or "null"},"id":{cj.dump(call_id)},'
                                 f'"name":{cj.dump(name)}}}')
                if status not in ("no_result", "repeated_call", "unlinked"):
                    parts.append(f'"result":{{"content":{cj.dump(content)},"id":{cj.dump(call_id)}}}')
                texts.append("{" + ",".join(parts) + "}")
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(texts, pa.string())], [*names, "message"])

    return rows.mapInArrow(run, schema)
