"""Quality rules: simple text counts, then a hashed n-gram log-likelihood ratio.

Two multinomials over hashed byte n-grams are counted: one over trusted
documents, one over the whole raw corpus.  A document's score is the mean of
log(p_trusted / p_raw) over its n-grams, in fixed-point numbers, so it does not
depend on how rows are batched.  One threshold, found on labelled documents,
decides every document.

The raw counts cover every row, the trusted counts and the threshold every
labelled one.  Labels and documents meet by joins, so labels may be as many as
documents; only the trusted texts' join ever shuffles texts.

Defined results: null and empty texts have no words and fail the base rules;
documents without n-grams score 0; without labels all scores are 0 and only the
base rules decide; labels of one document that differ count as not trusted;
columns of the input that carry a name of the result are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sirenlog.llm import words as w
from sirenlog.llm.common import slices, text_bytes

GRAM = 3            # bytes of an n-gram
BITS = 16           # n-grams are hashed to 2**BITS counts
SCALE = 10_000      # fixed point of the log ratios
MIN_WORDS, MAX_REPEAT = 50, 50
SLICE = 1 << 21
RANGE = 1 << 12     # buckets whose counts travel as one row of a task
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Model:
    """Fixed-point log ratios of the 2**BITS n-gram buckets, and the least mean ratio that is kept."""

    ratios: np.ndarray
    threshold: float


def buckets(data: np.ndarray) -> np.ndarray:
    """The bucket of the n-gram at every position but the last GRAM - 1."""
    n = max(0, len(data) - GRAM + 1)
    key = np.zeros(n, np.uint32)
    for i in range(GRAM):
        key = key * np.uint32(257) + data[i:i + n]
    return (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def _gram_ranges(bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of each text lie wholly inside it."""
    return np.minimum(bounds[:-1], n), np.maximum(np.minimum(bounds[:-1], n), np.minimum(bounds[1:] - GRAM + 1, n))


def base_counts(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    start, end, at = w.word_ranges(data, bounds)
    hashes = w.Hashes(data)
    chars = ~w.is_space(data) & ((data & 0xC0) != 0x80)
    counts = {"n_words": np.diff(at), "word_chars": w.sums_by_text(chars, bounds),
              "n_symbols": w.sums_by_text(_SYMBOL[data], bounds)}
    text_of = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(at))

    # Lines: each ends at \n or at the end of its text.
    first = np.unique(np.concatenate([bounds[:-1], np.flatnonzero(data == 10) + 1]))
    line_of = np.searchsorted(bounds, first, "right") - 1
    first, line_of = first[first < len(data)], line_of[first < len(data)]
    last = np.minimum(np.concatenate([first[1:], [len(data)]]), bounds[line_of + 1])
    last = np.where((last > first) & (data[np.maximum(last - 1, 0)] == 10), last - 1, last)
    worded = np.searchsorted(start, last) > np.searchsorted(start, first)
    first, last, line_of = first[worded], last[worded], line_of[worded]
    keys = w.mix(hashes.of(first, last) + line_of.astype(np.uint64) * w.BASE)
    _, new = np.unique(keys, return_index=True)
    again = np.ones(len(keys), bool)
    again[new] = False
    counts["n_dup_lines"] = np.bincount(line_of, again, len(bounds) - 1).astype(np.int64)

    # Words in three-word windows that are found at least twice in their text.
    h = hashes.of(start, end)
    covered = np.zeros(len(h), bool)
    if len(h) >= 3:
        window = w.mix(w.mix(w.mix(h[:-2] + text_of[:-2]) + h[1:-1]) * w.BASE + h[2:])
        here = text_of[:-2] == text_of[2:]
        twice = np.zeros(len(window), bool)
        twice[here] = w.repeated(window[here])
        for i in range(3):
            covered[i:i + len(twice)] |= twice
    counts["n_repeat_words"] = w.sums_by_text(covered, at)
    return counts


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT * counts["n_words"])


def scores(data: np.ndarray, bounds: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """The mean log ratio of each text."""
    key = buckets(data)
    low, high = _gram_ranges(bounds, len(key))
    total = np.zeros(len(key) + 1, np.int64)
    np.cumsum(ratios[key], out=total[1:])
    return (total[high] - total[low]) / (SCALE * np.maximum(high - low, 1))


def label_rows(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, trusted, poor) of every labelled key, one row each."""
    one = labels.filter(F.col(key).isNotNull() & F.col("quality").isNotNull()).groupBy(key).agg(
        F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    return one.select(
        key, ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("_trusted"), (F.col("quality") == 0).alias("_poor"))


def gram_counts(texts: DataFrame) -> np.ndarray:
    """How often each n-gram bucket occurs in the column ``__text``; 2**BITS rows come to the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BITS, np.int64)
        for batch in slices(batches, "__text", SLICE):
            data, bounds = text_bytes(batch.column("__text"))
            grams = buckets(data)
            low, high = _gram_ranges(bounds, len(grams))
            edge = np.zeros(len(grams) + 1, np.int8)
            np.add.at(edge, low, 1)
            np.add.at(edge, high, -1)
            total += np.bincount(grams[np.cumsum(edge[:-1]).astype(bool)], minlength=1 << BITS)
        used = np.flatnonzero(total)
        at = pa.array(np.searchsorted(used, np.arange(0, (1 << BITS) + 1, RANGE)), pa.int32())
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(len(at) - 1), pa.int32()), pa.ListArray.from_arrays(at, pa.array(used, pa.int32())),
            pa.ListArray.from_arrays(at, pa.array(total[used]))], ["part", "bucket", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            np.add.at(total, batch.column("bucket").flatten().to_numpy(), batch.column("n").flatten().to_numpy())
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["bucket", "n"])

    ranges = texts.mapInArrow(count, "part int, bucket array<int>, n array<long>").repartition("part")
    found = ranges.mapInArrow(add, "bucket int, n long").toPandas()
    counts = np.zeros(1 << BITS)
    counts[found["bucket"]] = found["n"]
    return counts


def fit(documents: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> Model:
    """Count both multinomials and find the threshold.

    The counts (2**BITS rows) and the histogram of labelled scores come to the
    driver; neither grows with the corpus.
    """
    marks = label_rows(labels, key).withColumnRenamed(key, "__key")
    source = documents.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    # By shuffling at every size: labels grow with the documents, so they cannot stay small enough to be sent around.
    trusted = gram_counts(
        source.join(marks.filter("_trusted").hint("merge"), "__key", "left_semi").select("__text"))
    if not trusted.sum():
        return Model(np.zeros(1 << BITS, np.int32), 0.0)
    raw = gram_counts(source.select("__text"))
    # One more count in each bucket, so that none is impossible.
    p, q = (trusted + 1) / (trusted + 1).sum(), (raw + 1) / (raw + 1).sum()
    ratios = np.rint(SCALE * np.log(p / q)).astype(np.int32)

    # Every text is graded where it lies, and only its key and grade meet the labels.
    schema = T.StructType([source.schema["__key"], T.StructField("grade", T.LongType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text", SLICE):
            data, bounds = text_bytes(batch.column("__text"))
            fine = ~base_failed(base_counts(data, bounds))
            grade = np.floor(scores(data, bounds, ratios) * 1000).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("__key").filter(pa.array(fine)), pa.array(grade[fine])], schema.names)

    graded = source.mapInArrow(judge, schema).join(marks.filter("_trusted OR _poor").hint("merge"), "__key").groupBy("grade").agg(
        F.count(F.when(F.col("_poor"), 1)).alias("poor"), F.count(F.when(~F.col("_poor"), 1)).alias("good")).toPandas()
    return Model(ratios, _threshold(graded["grade"].to_numpy(), graded["poor"].to_numpy(), graded["good"].to_numpy()))


def _threshold(grade: np.ndarray, poor: np.ndarray, good: np.ndarray) -> float:
    """Where the share of poor documents below exceeds that of good ones the most; the lowest such gap's middle."""
    if not good.sum() or not poor.sum():
        return float("-inf")
    order = np.argsort(grade)
    grade = grade[order].astype(float)
    lost = np.concatenate([[0], np.cumsum(good[order])]) / good.sum()
    caught = np.concatenate([[0], np.cumsum(poor[order])]) / poor.sum()
    cut = int(np.argmax(caught - lost))
    if cut == 0:
        return float("-inf")
    return float(grade[cut - 1] + 1 + (grade[cut] if cut < len(grade) else grade[cut - 1] + 1)) / 2000


RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def assess(documents: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default all) with the counts, ``score``, ``base_failed`` and ``kept``."""
    added = [*RESULT, "score", "base_failed", "kept"]
    names = [c for c in (documents.columns if keep is None else keep) if c not in added]
    source = documents.select(*names, F.col(text).alias("__text"))
    schema = T.StructType([source.schema[n] for n in names] + [T.StructField(n, T.LongType()) for n in RESULT] + [
        T.StructField("score", T.DoubleType()), T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType())])
    ratios, threshold = model.ratios, model.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text", SLICE):
            data, bounds = text_bytes(batch.column("__text"))
            counts = base_counts(data, bounds)
            failed, score = base_failed(counts), scores(data, bounds, ratios)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(counts[n].astype(np.int64)) for n in RESULT]
                + [pa.array(score), pa.array(failed), pa.array(~failed & (score >= threshold))], [*names, *added])

    return source.mapInArrow(run, schema)


def kept_documents(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows that the model keeps, with their own columns only."""
    ratios, threshold = model.ratios, model.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, SLICE):
            data, bounds = text_bytes(batch.column(text))
            kept = ~base_failed(base_counts(data, bounds)) & (scores(data, bounds, ratios) >= threshold)
            yield batch.filter(pa.array(kept))

    return documents.mapInArrow(run, documents.schema)
