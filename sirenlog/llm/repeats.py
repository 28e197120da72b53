"""Repeated passages: every string of LENGTH bytes that starts at more than one place.

1. Anchors.  In each window of LENGTH bytes the GRAM-byte string with the least
   hash (the first of them) is its anchor, so equal windows have equal anchors.
   Successive windows with one anchor form a run of at most LENGTH + SPAN bytes.
   Texts become rows of anchor and run hashes, about one for 75 bytes.
2. Runs.  Only anchors that occur twice can have repeated windows.  Where all
   their runs are equal, every window is repeated; that settles copies of whole
   texts and of long passages, however many there are, by counting.
3. Suffixes.  Where an anchor has different runs, one of each is cut from its
   text; shards of such runs get a suffix order and their longest previous
   factors (for the first mode) or previous and next ones (for the other).  An
   anchor with more than HOT different runs is counted by hashes of pieces of
   its runs and of single windows instead, which may be spread over tasks.
4. The windows found become byte ranges, which are joined back to the texts.

``keep="first"`` removes windows that occur earlier, in the order of (key, a
hash of the text, place); ``keep="none"`` removes every occurrence.  Matches
never cross texts, and overlapping windows count.

Defined results: a null text is empty; texts below LENGTH bytes lose nothing;
rows that repeat both key and text get the same result; null keys come first in
the order; columns of the input that carry a name of the result are replaced.

Runs are told apart by 64-bit hashes within one anchor's 64-bit hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sirenlog.llm import words as w
from sirenlog.llm.common import materialize, slices, text_bytes
from sirenlog.llm.suffixes import Suffixes

LENGTH, GRAM = 200, 50
SPAN = LENGTH - GRAM + 1     # grams of a window
# A step of a Python worker takes about 100 bytes for a byte of text, a suffix order about 200.
SLICE = 1 << 19              # bytes of texts that are looked at together
SHARD = 1 << 18              # bytes of a suffix order
HOT = 2048                   # different runs of one anchor that one suffix order takes
PIECE = 16                   # windows of a piece of a hot anchor's run
PART = 1 << 19               # bytes of a longer text that are looked at together
_PLACE = 28                  # bits of a place in a part


def sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` successive values."""
    n = len(values)
    padded = np.full(-(-n // size) * size, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, size)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - size + 1], ahead[size - 1:n])


def runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text number, first window (from the text's start), windows, anchor hash and run hash of every run."""
    if len(data) < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    if len(data) > PART and len(bounds) == 2:
        # A very long text in parts, by where windows start; runs that a limit cuts are judged by their suffixes.
        step = PART - LENGTH
        cuts = [(a, data[a:a + step + LENGTH - 1]) for a in range(0, len(data) - LENGTH + 1, step)]
        parts = [(a, runs(piece, np.array([0, len(piece)]))) for a, piece in cuts]
        return tuple(np.concatenate([x[i] + a if i == 1 else x[i] for a, x in parts]) for i in range(5))
    hashes = w.Hashes(data)
    grams = hashes.windows(GRAM)
    place = np.arange(len(grams), dtype=np.uint64)
    mask = np.uint64((1 << _PLACE) - 1)
    least = sliding_least((grams & ~mask) | place, SPAN) & mask  # of the window at each byte
    n = len(least)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    whole = np.arange(n) + LENGTH <= bounds[text + 1]
    new = np.ones(n, bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | ~whole[:-1]
    first = np.flatnonzero(new & whole)
    # A run goes on to the window before the next new one, or to the last whole one.
    stop = np.flatnonzero(np.concatenate([new[1:] | ~whole[1:], [True]]) & whole) + 1
    anchor = least[first].astype(np.int64)
    content = hashes.of(first, stop + LENGTH - 1)
    run = w.mix(content + (anchor - first).astype(np.uint64) * w.BASE)
    return text[first], first - bounds[text[first]], stop - first, grams[anchor].view(np.int64), run.view(np.int64)


def _keyed(documents: DataFrame, text: str, key: str) -> DataFrame:
    return documents.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_digest"),
                            F.coalesce(text, F.lit("")).alias("_text"))


def occurrences(keyed: DataFrame) -> DataFrame:
    """One row per run of every text."""
    kind = keyed.schema["_key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", SLICE):
            data, bounds = text_bytes(batch.column("_text"))
            text, place, windows, anchor, run_hash = runs(data, bounds)
            at = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key").take(at), batch.column("_digest").take(at), pa.array(place, pa.int32()),
                 pa.array(windows, pa.int32()), pa.array(anchor, pa.int64()), pa.array(run_hash, pa.int64())],
                ["_key", "_digest", "place", "windows", "anchor", "run"])

    return keyed.mapInArrow(run, T.StructType([kind] + [T.StructField("_digest", T.LongType())] + [
        T.StructField("place", T.IntegerType()), T.StructField("windows", T.IntegerType()),
        T.StructField("anchor", T.LongType()), T.StructField("run", T.LongType())]))


def _cut_runs(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted runs, or the hashes of their windows where their anchor is hot."""
    by_text = wanted.groupBy("_key", "_digest").agg(
        F.collect_list(F.struct("anchor", "place", "windows", "hot")).alias("wanted"))
    joined = keyed.join(by_text.withColumnsRenamed({"_key": "_k", "_digest": "_d"}),
                        F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_digest") == F.col("_d"))).select(
                            "_key", "_digest", "_text", "wanted")
    kind = keyed.schema["_key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", SLICE):
            data, bounds = text_bytes(batch.column("_text"))
            lists = batch.column("wanted")
            fields = dict(zip(("anchor", "place", "windows", "hot"), lists.flatten().flatten()))
            count = np.diff(lists.offsets.to_numpy()[:len(lists) + 1])
            text = np.repeat(np.arange(len(lists)), count)
            place = fields["place"].to_numpy()
            windows = fields["windows"].to_numpy()
            hot = fields["hot"].to_numpy(zero_copy_only=False)
            start = bounds[text] + place
            raw = data.tobytes()
            strings = [None if h else raw[a:b] for h, a, b in zip(
                hot.tolist(), start.tolist(), (start + windows + LENGTH - 1).tolist())]
            every = w.Hashes(data) if hot.any() else None
            grams = every.windows(GRAM).view(np.int64) if hot.any() else None
            anchor = fields["anchor"].to_numpy()
            pieces = [_pieces(every, grams, k, a, n) if h else None
                      for h, k, a, n in zip(hot.tolist(), anchor.tolist(), start.tolist(), windows.tolist())]
            at = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [fields["anchor"], batch.column("_key").take(at), batch.column("_digest").take(at),
                 fields["place"], pa.array(strings, pa.binary()), pa.array(pieces, _PIECES)],
                ["anchor", "_key", "_digest", "place", "content", "pieces"])

    return joined.mapInArrow(run, T.StructType([
        T.StructField("anchor", T.LongType()), kind, T.StructField("_digest", T.LongType()),
        T.StructField("place", T.IntegerType()), T.StructField("content", T.BinaryType()),
        T.StructField("pieces", T.ArrayType(T.StructType([
            T.StructField("at", T.IntegerType()), T.StructField("core", T.LongType()),
            T.StructField("same", T.LongType()), T.StructField("hashes", T.ArrayType(T.LongType()))])))]))


_PIECES = pa.list_(pa.struct([("at", pa.int32()), ("core", pa.int64()), ("same", pa.int64()),
                              ("hashes", pa.list_(pa.int64()))]))


def _pieces(every: w.Hashes, grams: np.ndarray, anchor: int, start: int, windows: int) -> list[dict]:
    """The windows of a run in groups of PIECE by their distance from the anchor.

    All windows of such a group share a core of bytes, at the same distances,
    whatever run they are in.  Gives the group's first window, the hashes of
    its core and of its whole content, and those of its windows.
    """
    low = start + windows - 1
    place = low + int(np.flatnonzero(grams[low:start + SPAN] == anchor)[0])
    first = np.arange(start, start + windows)
    hashes = every.of(first, first + LENGTH).view(np.int64)
    group = (place - first) // PIECE
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), windows]
    out = []
    for a, b in zip(edges, edges[1:]):
        near = place - int(group[a]) * PIECE
        ends = np.array([near, start + a]), np.array([near - PIECE + 1 + LENGTH, start + b - 1 + LENGTH])
        core, content = every.of(*ends)
        salt = np.array([int(group[a]), place - start - a], np.uint64)
        core, same = w.mix(np.array([core, content]) + salt * w.BASE).view(np.int64).tolist()
        out.append({"at": a, "core": core, "same": same, "hashes": hashes[a:b].tolist()})
    return out


def _by_suffixes(cut: DataFrame, keep: str) -> DataFrame:
    """Ranges of repeated windows within the runs, by suffix order."""
    order = ["anchor", "_key", "_digest", "place"]
    dealt = cut.filter("content IS NOT NULL").drop("pieces").repartition("anchor").sortWithinPartitions(*order)
    kind = cut.schema["_key"]

    def judge(rows: pa.Table) -> pa.RecordBatch:
        strings = rows.column("content").to_pylist()
        s = Suffixes(strings, LENGTH)
        # Only windows that lie wholly in their run can be found again.
        whole = np.zeros(len(s.order), bool)
        for a, b in zip(s.starts, s.starts[1:]):
            whole[a:max(a, b - LENGTH)] = True
        longest = s.factors(among=whole)
        if keep == "none":
            longest = np.maximum(longest, s.factors(earlier=False, among=whole))
        found = np.zeros(len(longest) + 1, np.int8)
        found[:-1] = longest >= LENGTH
        edge = np.diff(found, prepend=np.int8(0))
        first, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        at = np.searchsorted(s.starts, first, "right") - 1
        place = rows.column("place").to_numpy()[at] + first - s.starts[at]
        take = pa.array(at)
        return pa.RecordBatch.from_arrays(
            [rows.column("_key").combine_chunks().take(take), rows.column("_digest").combine_chunks().take(take),
             pa.array(place, pa.int32()), pa.array(place + (stop - first) + LENGTH - 1, pa.int32())],
            ["_key", "_digest", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            # Equal rows of one place (a repeated document) count once.
            anchor = batch.column("anchor").to_numpy()
            place, digest = batch.column("place").to_numpy(), batch.column("_digest").to_numpy()
            again = np.zeros(len(anchor), bool)
            again[1:] = (anchor[1:] == anchor[:-1]) & (place[1:] == place[:-1]) & (digest[1:] == digest[:-1])
            again[0] = last is not None and last[:3] == (anchor[0], place[0], digest[0])
            for i in np.flatnonzero(again):
                before = batch.column("_key")[int(i) - 1] if i else last[3]
                again[i] = before.equals(batch.column("_key")[int(i)])
            end = batch.num_rows - 1
            last = (anchor[end], place[end], digest[end], batch.column("_key")[end])
            batch = batch.filter(pa.array(~again))
            anchor = anchor[~again]
            if not batch.num_rows:
                continue
            total = size + np.cumsum(_sizes(batch.column("content")))
            start = 0
            held_anchor = held[-1].column("anchor")[-1].as_py() if held else None
            for i in np.flatnonzero(np.concatenate([[anchor[0] != held_anchor], anchor[1:] != anchor[:-1]])):
                if (total[i - 1] if i else size) - (total[start - 1] if start else 0) >= SHARD:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    if held:
                        yield judge(pa.Table.from_batches(held))
                    held, start = [], int(i)
            if start < batch.num_rows:
                held.append(batch.slice(start))
            size = int(sum(_sizes(b.column("content")).sum() for b in held))
        if held:
            yield judge(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, T.StructType([kind] + [
        T.StructField("_digest", T.LongType()), T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType())]))


def _sizes(contents: pa.Array) -> np.ndarray:
    return np.diff(np.frombuffer(contents.buffers()[1], np.int32)[contents.offset:contents.offset + len(contents) + 1])


def _by_counting(cut: DataFrame, keep: str) -> DataFrame:
    """The same for hot anchors, by counting: pieces first, single windows where pieces with one core differ."""
    key = F.struct("_key", "_digest", "start")
    pieces = cut.filter("pieces IS NOT NULL").select("anchor", "_key", "_digest", "place", F.explode("pieces").alias("p")).select(
        "anchor", "p.core", "p.same", "p.hashes", "_key", "_digest", (F.col("place") + F.col("p.at")).alias("start"))
    cores = pieces.groupBy("anchor", "core").agg(
        F.count(F.lit(1)).alias("n"), F.min("same").alias("low"), F.max("same").alias("high"), F.min(key).alias("first")
    ).filter("n > 1")
    met = pieces.join(cores, ["anchor", "core"])
    equal = met.filter("low = high")
    windows = met.filter("low <> high").select(
        "anchor", "_key", "_digest", "start", F.posexplode("hashes").alias("at", "hash")).select(
            "anchor", "hash", "_key", "_digest", (F.col("start") + F.col("at")).alias("start"))
    seen = windows.groupBy("anchor", "hash").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first")).filter("n > 1")
    single = windows.join(seen, ["anchor", "hash"])
    if keep == "first":
        equal, single = (x.filter(~key.eqNullSafe(F.col("first"))) for x in (equal, single))
    return equal.select(
        "_key", "_digest", "start", (F.col("start") + F.size("hashes") + (LENGTH - 1)).alias("end")
    ).unionByName(single.select("_key", "_digest", "start", (F.col("start") + LENGTH).alias("end")))


def repeated_ranges(documents: DataFrame, text: str = "text", key: str = "doc_id", keep: str = "none") -> DataFrame:
    """``_key``, ``_digest`` and ``ranges`` (start, end in bytes; may overlap) of every text that loses something."""
    keyed = _keyed(documents, text, key)
    found = materialize(occurrences(keyed), "repeat-runs")
    sizes = found.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("run").alias("low"), F.max("run").alias("high")).filter("n > 1")
    candidates = materialize(found.join(sizes, "anchor").select(
        *found.columns, (F.col("low") != F.col("high")).alias("mixed")), "repeat-candidates")
    first = F.min(F.struct("_key", "_digest", "place")).alias("first")
    kinds = materialize(candidates.groupBy("anchor", "run").agg(
        F.count(F.lit(1)).alias("copies"), F.max("windows").alias("windows"),
        F.max("mixed").alias("mixed"), first), "repeat-kinds")
    mixed = kinds.filter("mixed")
    hot = mixed.groupBy("anchor").agg((F.count(F.lit(1)) > HOT).alias("hot"))
    wanted = mixed.select("anchor", "first.*", "windows").join(hot, "anchor")
    cut = materialize(_cut_runs(keyed, wanted), "repeat-cut")
    copied = candidates.join(kinds.filter("copies > 1").select("anchor", "run", "first"), ["anchor", "run"])
    if keep == "first":
        copied = copied.filter(~F.struct("_key", "_digest", "place").eqNullSafe(F.col("first")))
    ranges = copied.select(
        "_key", "_digest", F.col("place").alias("start"), (F.col("place") + F.col("windows") + (LENGTH - 1)).alias("end")
    ).unionByName(_by_suffixes(cut, keep)).unionByName(_by_counting(cut, keep))
    return ranges.groupBy("_key", "_digest").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))


def _with_ranges(documents: DataFrame, ranges: DataFrame, text: str, key: str) -> DataFrame:
    """``row`` (all columns) and ``ranges`` (null where nothing is removed)."""
    rows = documents.select(F.struct("*").alias("row"), F.col(key).alias("_k"), F.xxhash64(text).alias("_d"))
    return rows.join(ranges, F.col("_k").eqNullSafe(F.col("_key")) & (F.col("_d") == F.col("_digest")), "left").select(
        "row", "ranges")


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Touching and overlapping ranges made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def without(data: bytes, ranges: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for start, end in ranges:
        parts.append(data[at:start])
        at = end
    return b"".join([*parts, data[at:]])


def _row_slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The rows with their ranges, in parts of about SLICE bytes of text."""
    return slices((b.append_column("_text", b.column("row").field(text)) for b in batches), "_text", SLICE)


def _rows(batch: pa.RecordBatch, text: str) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    lists = batch.column("ranges")
    flat = lists.flatten()
    start, end = (x.to_numpy().tolist() for x in flat.flatten()) if len(flat) else ([], [])
    at = 0
    sizes = [0 if n is None else n for n in pc.list_value_length(lists).to_pylist()]
    for value, n in zip(batch.column("row").field(text), sizes):
        raw = value.as_py()
        raw = raw.encode("utf-8") if isinstance(raw, str) else raw or b""
        yield raw, merged(list(zip(start[at:at + n], end[at:at + n])))
        at += n


def removal_digests(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` when every occurrence goes."""
    ranges = repeated_ranges(documents, text, key, "none")
    joined = _with_ranges(documents.select(key, text), ranges, text, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _row_slices(batches, text):
            out = [(len(raw), sum(b - a for a, b in spans), len(spans), hashlib.sha256(without(raw, spans)).hexdigest())
                   for raw, spans in _rows(batch, text)]
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").field(key), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
                [key, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.mapInArrow(run, T.StructType([documents.schema[key]] + [
        T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")] + [
        T.StructField("kept_sha256", T.StringType())]))


def whole_characters(data: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges without characters that they hold only in part."""
    def is_tail(i: int) -> bool:
        return i < len(data) and data[i] & 0xC0 == 0x80

    out = []
    for start, end in ranges:
        while is_tail(start):
            start += 1
        if is_tail(end):
            while is_tail(end):
                end -= 1
        if start < end:
            out.append((start, end))
    return out


def remove_later_copies(documents: DataFrame, text: str = "text", key: str = "doc_id", keep: str = "first") -> DataFrame:
    """All rows and columns, texts without what is repeated; the first occurrence stays (or none)."""
    columns = documents.columns
    ranges = repeated_ranges(documents, text, key, keep)
    joined = _with_ranges(documents, ranges, text, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _row_slices(batches, text):
            texts = [raw if not spans else without(raw, whole_characters(raw, spans))
                     for raw, spans in _rows(batch, text)]
            kept = pa.array(texts, pa.binary()).cast(pa.string())
            row = batch.column("row")
            kept = pc.if_else(row.field(text).is_null(), pa.scalar(None, pa.string()), kept)
            yield pa.RecordBatch.from_arrays([kept if c == text else row.field(c) for c in columns], columns)

    return joined.mapInArrow(run, documents.schema)
