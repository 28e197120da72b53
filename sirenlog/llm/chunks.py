"""Document fingerprints from content-defined chunks.

A gear hash of the last bytes decides where a text is cut: a strict pattern
before the usual chunk size, a loose one after it, so sizes gather around it,
and a forced cut at the greatest size.  Cuts depend on nearby bytes only, so an
insertion moves no cut beyond its surroundings.  A fingerprint is the set of
chunk digests with their lengths; the likeness of two is the lesser of the two
containments, by bytes.

``neighbours`` gives each row the next row's text in the order of a key, with
one exchange of the texts: the rows are dealt by ranges and sorted, and only
the last row of each partition meets the first of the next one separately.

Defined results: a null text is empty; an empty text has the empty fingerprint,
whose likeness to itself is 1 and to any other 0; rows that tie on the key are
ordered by a hash of their text; null keys come first; an empty table gives no
rows; only the named columns are read by ``neighbours``, whatever the others are
called; a text is hashed and cut as a whole, in memory.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sirenlog.llm.common import ordered_parts

LEAST, USUAL, MOST = 24, 48, 192
STRICT, LOOSE = np.uint32(0x3F << 20), np.uint32(0x0F << 20)  # bits that see the last 21 to 26 bytes
DIGEST_BITS = 48


def _gear() -> np.ndarray:
    values = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    return (values >> np.uint64(32)).astype(np.uint32)


_GEAR = _gear()


def gear_hash(data: np.ndarray) -> np.ndarray:
    """h[i] = 2 h[i - 1] + gear[data[i]] for all i, by doubling the number of bytes seen."""
    h = _GEAR[data]
    seen = 1
    while seen < min(32, len(h)):
        h[seen:] = h[seen:] + (h[:-seen] << np.uint32(seen))
        seen *= 2
    return h


def cuts(data: np.ndarray) -> list[int]:
    """The ends of all chunks."""
    n = len(data)
    h = gear_hash(data)
    loose_at = np.flatnonzero((h & LOOSE) == 0)
    strict = (loose_at[(h[loose_at] & STRICT) == 0] + 1).tolist()
    loose = (loose_at + 1).tolist()
    ends, start, i, j = [], 0, 0, 0
    while n - start > LEAST:
        i = bisect_left(strict, start + LEAST, i)
        if i < len(strict) and strict[i] < start + USUAL:
            start = strict[i]
        else:
            j = bisect_left(loose, start + USUAL, j)
            start = loose[j] if j < len(loose) and loose[j] < start + MOST else min(start + MOST, n)
        ends.append(start)
    if start < n:
        ends.append(n)
    return ends


def chunk_set(text: bytes) -> dict[int, int]:
    """Digest to length of every different chunk."""
    found, start, digest = {}, 0, xxhash.xxh3_64_intdigest
    for end in cuts(np.frombuffer(text, np.uint8)):
        found[digest(text[start:end]) >> 64 - DIGEST_BITS] = end - start
        start = end
    return found


def as_text(chunks: dict[int, int]) -> str:
    """digest-length pairs in hexadecimal, ordered by digest."""
    return " ".join([f"{d:012x}{n:x}" for d, n in sorted(chunks.items())])


def from_text(fingerprint: str) -> dict[int, int]:
    return {int(x[:12], 16): int(x[12:], 16) for x in fingerprint.split()}


def containment(inner: dict[int, int], outer: dict[int, int]) -> float:
    """The share of ``inner``'s bytes in chunks that ``outer`` has."""
    if not inner:
        return 1.0 if not outer else 0.0
    return sum(inner[d] for d in inner.keys() & outer.keys()) / sum(inner.values())


def likeness(a: dict[int, int], b: dict[int, int]) -> float:
    return min(containment(a, b), containment(b, a))


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as much of the beginning of the following text."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def map_neighbours(documents: DataFrame, key: str, text: str, function: Callable[[str, str], tuple],
                   result: T.StructType) -> DataFrame:
    """``key`` and ``function(text, next text)`` of every row; after the last row comes the first."""
    spark = documents.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = documents.select(F.col(key), F.coalesce(text, F.lit("")).alias("__text")).withColumn(
        "_tie", F.xxhash64("__text"))
    ordered = ordered_parts(source, [key, "_tie"], n)  # used twice, with the same partitions
    schema = T.StructType([source.schema[key], *result.fields])
    kind = source.schema[key]

    def rows(batches):
        for batch in batches:
            yield from zip(batch.column(0), batch.column(1))

    def table(keys: list, values: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*values)) if values else [[] for _ in result.fields]
        arrays = [pa.array(keys, key_type[0])] + [
            pa.array(c, _ARROW[f.dataType.typeName()]) for c, f in zip(columns, result.fields)]
        return pa.RecordBatch.from_arrays(arrays, schema.names)

    key_type: list[pa.DataType] = [pa.int64()]

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All rows but the last one of the partition."""
        held, keys, values = None, [], []
        for at, value in rows(batches):
            key_type[0] = at.type
            now = (at.as_py(), value.as_py())
            if held is not None:
                keys.append(held[0])
                values.append(function(held[1], now[1]))
            held = now
            if len(keys) == 128:
                yield table(keys, values)
                keys, values = [], []
        if keys:
            yield table(keys, values)

    def limits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first and the last row of the partition."""
        first = last = None
        for batch in batches:
            if batch.num_rows:
                first = first if first is not None else batch.slice(0, 1)
                last = batch.slice(batch.num_rows - 1, 1)
        if first is not None:
            part = pa.array([TaskContext.get().partitionId()], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part, first.column(1), last.column(0), last.column(1)], ["part", "first", key, "last"])

    ends = ordered.mapInArrow(limits, T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("first", T.StringType()), kind,
        T.StructField("last", T.StringType())]))
    # One row a partition: each last row with the first text of the next partition.
    order = Window.orderBy("part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    met = ends.select(key, "last", F.coalesce(F.lead("first").over(order), F.first("first").over(whole)).alias("next"))

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key_type[0] = batch.column(0).type
            yield table(batch.column(0).to_pylist(), [
                function(a.as_py(), b.as_py()) for a, b in zip(batch.column(1), batch.column(2))])

    return ordered.mapInArrow(inner, schema).unionByName(met.mapInArrow(outer, schema))


_ARROW = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
EDITED = T.StructType([
    T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])


def compare_with_next(text: str, following: str) -> tuple:
    changed = edited(text, following).encode("utf-8")
    own, other, after = chunk_set(text.encode("utf-8")), chunk_set(changed), chunk_set(following.encode("utf-8"))
    return (len(text), hashlib.sha256(changed).hexdigest(), as_text(own), as_text(other),
            likeness(own, other), likeness(own, after))


def fingerprints(documents: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default all) and the ``fingerprint`` of each text."""
    names = [c for c in (documents.columns if keep is None else keep) if c != "fingerprint"]
    source = documents.select(*names, F.coalesce(text, F.lit("")).cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names]
                + [pa.array([as_text(chunk_set(x.as_py())) for x in batch.column("__text")], pa.string())],
                [*names, "fingerprint"])

    return source.mapInArrow(run, T.StructType([source.schema[n] for n in names] + [
        T.StructField("fingerprint", T.StringType())]))
