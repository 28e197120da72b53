"""SimHash near-copies by bit-sliced comparison.

A fingerprint's 64 bits are the majority bits of the XXH64 values of its
three-word shingles.  Fingerprints link at RADIUS or fewer differing bits.

Candidates: two such fingerprints agree wholly on one of RADIUS + 1 bands of
bits, so fingerprints meet by (band, value).  Equal fingerprints are one from
the start.  What meets is compared in blocks held as bit planes: word j of
plane i has bit i of 64 fingerprints, and a carry-save counter of a few words
adds up the differing bits of 64 pairs at a time.  A query is dropped, and at
last the block abandoned, once all its distances exceed the radius.  A block
yields a spanning forest of its links, never all pairs.

A (band, value) group is cut into parts of PART fingerprints by hash, and each
pair of parts is a unit of work of its own, so no group is one task.

Defined results: a null text is empty; a text without words has fingerprint
zero and links like any other; repeated rows share a component; null ids get
their fingerprint's component and are never its smallest id; columns of the
input that carry a name of the result are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sirenlog.llm.common import materialize, slices
from sirenlog.llm.components import components

SHINGLE, SEED, RADIUS = 3, 42, 3
PART = 2048       # fingerprints of a part of a group
BLOCK = 1024      # small groups are compared together up to this size
QUERIES = 256     # fingerprints that are compared with a block at once


def shingle_values(text: bytes, size: int) -> np.ndarray:
    """The XXH64 values of all shingles of a text, repeats included."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum([len(x) + 1 for x in words]) - 1
    starts = [0, *(ends[:-size] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1:].tolist())], np.uint64)


def majority(values: np.ndarray) -> np.uint64:
    """The bits that are set in over half of the values."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(values), 1 << 16):
        part = np.ascontiguousarray(values[i:i + (1 << 16)], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return np.packbits(2 * counts > len(values), bitorder="little").view("<u8")[0]


def fingerprint(text: bytes) -> int:
    """The unsigned fingerprint of one text."""
    return int(majority(shingle_values(text, SHINGLE)))


def fingerprints(documents: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default all) and ``fingerprint`` as a signed long."""
    names = [c for c in (documents.columns if keep is None else keep) if c != "fingerprint"]
    source = documents.select(*names, F.coalesce(text, F.lit("")).cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(x.as_py()) for x in batch.column("__text")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(found.view(np.int64))], [*names, "fingerprint"])

    return source.mapInArrow(run, T.StructType([source.schema[n] for n in names] + [
        T.StructField("fingerprint", T.LongType())]))


def as_hex(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


# --- bit-sliced comparison -------------------------------------------------


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """Plane i holds bit i of all fingerprints (rows of 64-bit words), 64 to a word; the rest is filled up with zeros."""
    padded = np.zeros((-(-len(prints) // 64) * 64, prints.shape[1]), "<u8")
    padded[:len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(len(padded), -1), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def within(planes: np.ndarray, queries: np.ndarray, asked: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Which members of a block lie within the radius of each query.

    ``asked`` (queries x words) has the members to compare.  Gives the numbers
    of the queries that have any, and their bits.
    """
    digits = max(1, radius.bit_length())
    rest = (1 << digits) - 1 - radius  # the counters start there, so that they run over just past the radius
    alive, who = asked.copy(), np.arange(len(queries))
    counter = [np.full_like(alive, np.uint64(0xFFFFFFFFFFFFFFFF) if rest >> i & 1 else np.uint64(0))
               for i in range(digits)]
    for i in range(len(planes)):
        bit = (queries[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
        carry = planes[i][None, :] ^ (np.uint64(0) - bit)[:, None]
        for digit in counter:
            up = digit & carry
            digit ^= carry
            carry = up
        alive &= ~carry
        if i % 8 == 7:
            on = alive.any(1)
            if not on.all():
                alive, who, queries = alive[on], who[on], queries[on]
                counter = [digit[on] for digit in counter]
            if not len(who):
                break
    return who, alive


def links(prints: np.ndarray, radius: int = RADIUS, split: int = 0) -> np.ndarray:
    """A spanning forest (pairs of places) of the links in a block.

    With ``split``, only pairs across that place are compared.
    """
    n = len(prints)
    prints = prints.reshape(n, -1)
    planes = bit_planes(prints)
    label, edges = np.arange(n), []
    place = np.arange(planes.shape[1] * 64)
    for low in range(0, split or n, QUERIES):
        ask = np.arange(low, min(low + QUERIES, split or n))
        wanted = (place[None, :] >= split) if split else (place[None, :] > ask[:, None])
        wanted = np.broadcast_to(wanted & (place < n), (len(ask), len(place)))
        asked = np.ascontiguousarray(np.packbits(wanted, axis=1, bitorder="little")).view("<u8")
        for at, bits in zip(*within(planes, prints[ask], asked, radius)):
            near = np.flatnonzero(np.unpackbits(bits[None, :].view(np.uint8), bitorder="little"))
            own = label[ask[at]]
            others, first = np.unique(label[near], return_index=True)
            for other, member in zip(others, near[first]):
                if other != own:
                    edges.append((ask[at], member))
                    label[label == other] = own
    return np.array(edges, np.int64).reshape(-1, 2)


def candidate_units(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(unit, side, fingerprint): what has to be compared; ``nodes`` has distinct fingerprints.

    A unit is a part of a (band, value) group, or a pair of parts, of which the
    sides are compared with each other.
    """
    bands = radius + 1
    width = 64 // bands
    fp = F.col("fingerprint")
    band = F.array(*[
        F.struct(F.lit(i).alias("band"), F.shiftrightunsigned(fp, i * width).bitwiseAND(
            F.lit((1 << (width if i < bands - 1 else 64 - width * i)) - 1)).alias("value")) for i in range(bands)])
    banded = nodes.select("fingerprint", F.explode(band).alias("b")).select("fingerprint", "b.*")
    return _units(banded, "fingerprint")


def _units(banded: DataFrame, node: str) -> DataFrame:
    """Rows of (band, value) groups of at least two, cut into parts by a hash of the node and paired."""
    sizes = banded.groupBy("band", "value").count().filter("count > 1").withColumn(
        "parts", F.ceil(F.col("count") / PART).cast("int")).drop("count")
    part = F.pmod(F.xxhash64(node, F.lit("part")), F.col("parts")).cast("int")
    parted = banded.join(sizes, ["band", "value"]).withColumn("part", part)
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    kept = [c for c in banded.columns if c not in ("band", "value")]
    return parted.withColumn("other", other).select(
        F.xxhash64("band", "value", low, high).alias("unit"), "band", "value",
        low.alias("low"), high.alias("high"), (F.col("part") > F.col("other")).alias("side"), *kept)


def link_edges(units: DataFrame, radius: int = RADIUS, node: str = "fingerprint",
               prints: tuple[str, ...] = ("fingerprint",)) -> DataFrame:
    """Edges (a, b) of nodes that span the links of all units."""
    key = ["band", "value", "low", "high"]
    dealt = units.repartition("unit").sortWithinPartitions("unit", *key, "side", node)

    def compare(group: list[tuple[np.ndarray, np.ndarray]], split: int) -> Iterator[pa.RecordBatch]:
        nodes, values = (np.concatenate(x) for x in zip(*group))
        found = links(values, radius, split)
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[found[:, 0]]), pa.array(nodes[found[:, 1]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Groups that lie on one part are compared together; extra links found across them are true ones.
        small: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for paired, side, nodes, values in _unit_groups(batches, node, prints):
            if paired:
                split = int(np.searchsorted(side, True))
                if 0 < split < len(nodes):
                    yield from compare([(nodes, values)], split)
                continue
            if held and held + len(nodes) > BLOCK:
                yield from compare(small, 0)
                small, held = [], 0
            small.append((nodes, values))
            held += len(nodes)
        if held:
            yield from compare(small, 0)

    columns = list(dict.fromkeys(["unit", *key, "side", node, *prints]))
    return dealt.select(*columns).mapInArrow(run, "a long, b long").distinct()


def _unit_groups(batches: Iterator[pa.RecordBatch], node: str, prints: tuple[str, ...]):
    """(whether it is a pair of parts, sides, nodes, fingerprints) of each unit; rows come sorted by unit."""
    key, held = None, []
    names = ("unit", "band", "value", "low", "high")

    def whole():
        sides, nodes, values = (np.concatenate(x) for x in zip(*held))
        return key[3] != key[4], sides, nodes, values

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        side = batch.column("side").to_numpy(zero_copy_only=False)
        nodes = batch.column(node).to_numpy(zero_copy_only=False)
        values = np.stack([batch.column(p).to_numpy(zero_copy_only=False) for p in prints], 1).view(np.uint64)
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            here = tuple(int(c[a]) for c in columns)
            if here != key and key is not None:
                yield whole()
                held = []
            key = here
            held.append((side[a:b], nodes[a:b], values[a:b]))
    if key is not None:
        yield whole()


def near_copy_groups(prints: DataFrame, key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """``prints`` (a stored table with ``key`` and ``fingerprint``) with ``component_id``, the smallest key reachable."""
    nodes = materialize(prints.groupBy("fingerprint").agg(F.min(key).alias("least")), "simhash-nodes")
    edges = link_edges(candidate_units(nodes.select("fingerprint"), radius), radius)
    return _named(prints, nodes, edges, "fingerprint")


def _named(rows: DataFrame, nodes: DataFrame, edges: DataFrame, node: str) -> DataFrame:
    """The rows with ``component_id``, the least key of their node's component."""
    found = materialize(components(edges), "simhash-components")
    linked = nodes.select(node, "least").join(found, F.col(node) == F.col("node") if node != "node" else "node")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = linked.join(least, "component").select(node, "component_id")
    of_node = nodes.select(node, "least").join(named, node, "left").select(
        node, F.coalesce("component_id", "least").alias("component_id"))
    return rows.drop("component_id").join(of_node, node, "left")


def components_of(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``prints`` (a stored table with ``fingerprint``) with ``component``, the smallest fingerprint reachable."""
    nodes = prints.select("fingerprint").distinct()
    found = materialize(components(link_edges(candidate_units(nodes, radius), radius)), "simhash-components")
    return prints.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "component", F.coalesce("component", "fingerprint"))


def keep_one(documents: DataFrame, text: str = "text", key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """One document of each group of near copies: the one with the smallest key.

    Groups are those of ``component``, whatever keys their rows have: a null or
    repeated key joins nothing.  Rows of a group that repeat its smallest key are
    told apart by their fingerprint and a hash of the text; of wholly equal rows
    one stays, and null keys come last.
    """
    prints = materialize(fingerprints(documents.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("mark")), "text",
        ["key", "mark"]), "simhash-prints")
    # Only what is kept, one row per component, meets the texts again.
    first = components_of(prints, radius).groupBy("component").agg(F.min(F.struct(
        F.col("key").isNull().alias("none"), "key", "fingerprint", "mark")).alias("f")).select("f.key", "f.mark")
    whole = documents.select(F.struct("*").alias("row"), F.col(key).alias("key"), F.xxhash64(text).alias("mark"))
    kept = whole.join(first, whole["key"].eqNullSafe(first["key"]) & (whole["mark"] == first["mark"]), "left_semi")
    # Equal rows share a key and a mark; the group limit is applied before any further exchange.
    order = Window.partitionBy("key", "mark").orderBy("key")
    return kept.withColumn("at", F.row_number().over(order)).filter("at = 1").select("row.*")
