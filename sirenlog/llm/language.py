"""Language identification by nearest centroids.

A text is a vector of hashed letter n-grams (one to three letters, blanks
included inside), sub-linear counts times inverse document frequency, of
length one.  Each language has several centroids, found by clustering a sample
of its documents; a text takes the language of the centroid with the greatest
cosine, and is marked as rejected when it is farther from it than nearly all
documents of that language were.

Document frequencies cover all training rows.  The centroids are fitted on at
most PER_LANGUAGE rows a language, the first by a hash of their ids.

Defined results: a null text or one without letters is ``und`` with score 0,
rejected; without training rows every text is; ties go to the first language
by name; columns of the input that carry a name of the result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sirenlog.llm.common import slices

DIMENSIONS = 1 << 12
PER_LANGUAGE = 1_000     # documents a language that the centroids are fitted on
CLUSTERS, ROUNDS = 4, 8
REJECT_SHARE = 0.005     # of a language's sample is farther than its limit
ROWS, CHARS = 256, 1 << 20
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """Centroids (rows), their languages and limits, and the idf of each dimension."""

    languages: tuple[str, ...]
    centroids: np.ndarray
    limits: np.ndarray
    idf: np.ndarray


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts (texts x DIMENSIONS), and which texts have a letter."""
    lowered = [t.lower() for t in texts]
    ends = np.cumsum([len(t) for t in lowered]) if lowered else np.zeros(0, np.int64)
    table = np.zeros((len(texts), DIMENSIONS), np.float32)
    row = np.repeat(np.arange(len(texts), dtype=np.int64), [len(t) for t in lowered])
    code = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    code = np.where(letter, code, 0).astype(np.uint32)
    # No n-gram passes the end of its text: what follows it counts as a blank.
    later = code.copy()
    start = np.zeros(len(code) + 1, bool)
    start[ends[:-1] if len(ends) else ends] = True
    last = start[1:]
    keys, rows = [], []
    one = (code * np.uint32(0x9E3779B1))
    keys.append(one[letter])
    rows.append(row[letter])
    follow = np.zeros_like(code)
    follow[:-1] = later[1:]
    follow[last] = 0
    two = (one ^ (follow * np.uint32(0x85EBCA77) + np.uint32(0x165667B1)))
    keys.append(two[letter])
    rows.append(row[letter])
    before = np.zeros_like(code)
    before[1:] = later[:-1]
    before[start[:-1]] = 0
    three = (two * np.uint32(0x27D4EB2F)) ^ (before * np.uint32(0xC2B2AE3D) + np.uint32(0x9E3779B1))
    keys.append(three[letter])
    rows.append(row[letter])
    for k, r in zip(keys, rows):
        k = k ^ (k >> np.uint32(15))
        k = (k * np.uint32(0x2C1B3C6D)) >> np.uint32(20)
        table += np.bincount(r * DIMENSIONS + k, minlength=table.size).reshape(table.shape)
    return table, np.bincount(row[letter], minlength=len(texts)) > 0


def vectors(table: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = np.log1p(table) * idf
    norm = np.sqrt((weights * weights).sum(1, keepdims=True))
    return weights / np.maximum(norm, 1e-9)


def cluster(points: np.ndarray, k: int = CLUSTERS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart starts; centroids and each point's cosine to its own."""
    middle = points.mean(0)
    chosen = [int(np.argmax(points @ middle))]
    near = points @ points[chosen[0]]
    while len(chosen) < min(k, len(points)):
        far = int(np.argmin(near))
        if near[far] > 1 - 1e-6:
            break
        chosen.append(far)
        near = np.maximum(near, points @ points[far])
    centroids = points[chosen]
    for _ in range(rounds):
        own = np.argmax(points @ centroids.T, 1)
        sums = np.stack([points[own == i].sum(0) if (own == i).any() else centroids[i] for i in range(len(centroids))])
        centroids = sums / np.maximum(np.sqrt((sums * sums).sum(1, keepdims=True)), 1e-9)
    return centroids, (points @ centroids.T).max(1)


def _parts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, column, CHARS):
        for i in range(0, batch.num_rows, ROWS):
            yield batch.slice(i, ROWS)


def _texts(batch: pa.RecordBatch, column: str) -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


def fit(documents: DataFrame, training: Column, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """Learn from the rows where ``training`` holds and the language is known."""
    spark = documents.sparkSession
    known = documents.filter(training & F.col(lang).isNotNull())

    def frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0, np.zeros(DIMENSIONS, np.int64)
        for batch in _parts(batches, "__text"):
            table, lettered = counts(_texts(batch, "__text"))
            seen += (table > 0).sum(0)
            total += int(lettered.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, DIMENSIONS), pa.int32()), pa.array(np.concatenate([[total], seen]))],
            ["dimension", "n"])

    found = known.select(F.col(text).alias("__text")).mapInArrow(frequency, "dimension int, n long").groupBy(
        "dimension").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros(DIMENSIONS + 1, np.int64)
    seen[found["dimension"] + 1] = found["n"]
    idf = np.log((1 + seen[0]) / (1 + seen[1:])).astype(np.float32) + np.float32(1)

    # A language's sample is taken from its rows themselves, whatever their ids are: the first by a hash
    # of id and text.  Rows beyond twice the sample's share of the hash range never leave their tasks.
    rows = known.select(F.col(lang).alias("_lang"), F.col(text).alias("__text"), F.xxhash64(key, text).alias("_hash"),
                        F.xxhash64(text, key).alias("_tie"))
    sizes = rows.groupBy("_lang").count().collect()  # a row a language, as the model has
    limits = [(r["_lang"], min(1.0, 2 * PER_LANGUAGE / r["count"]) * 2.0**64 - 2.0**63) for r in sizes]
    limit = F.element_at(F.create_map(*[F.lit(x) for pair in limits for x in pair]), F.col("_lang")) if limits else F.lit(0.0)
    order = Window.partitionBy("_lang").orderBy("_hash", "_tie")
    sample = rows.filter(F.col("_hash").cast("double") <= limit).withColumn("_at", F.row_number().over(order)).filter(
        F.col("_at") <= PER_LANGUAGE).select("_lang", "__text")

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        tables = [counts([x or "" for x in group["__text"][i:i + ROWS]]) for i in range(0, len(group), ROWS)]
        points = np.concatenate([vectors(t, idf)[has] for t, has in tables])
        if not len(points):
            return pd.DataFrame({"lang": [], "centroid": [], "limit": []})
        points = points[np.lexsort(points.T[:8])]
        middles, cosines = cluster(points)
        limit = float(np.quantile(cosines, REJECT_SHARE))
        return pd.DataFrame({"lang": group["_lang"].iloc[0], "centroid": [m.tolist() for m in middles], "limit": limit})

    rows = sample.groupBy("_lang").applyInPandas(
        centroids, "lang string, centroid array<float>, limit double").collect()
    rows.sort(key=lambda r: (r["lang"], r["centroid"]))
    return Model(tuple(r["lang"] for r in rows),
                 np.array([r["centroid"] for r in rows], np.float32).reshape(-1, DIMENSIONS),
                 np.array([r["limit"] for r in rows]), idf)


def predict(documents: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default all) with ``lang_pred``, ``score`` (cosine) and ``rejected``."""
    added = ["lang_pred", "score", "rejected"]
    names = [c for c in (documents.columns if keep is None else keep) if c not in added]
    source = documents.select(*names, F.col(text).alias("__text"))
    languages = np.array([*model.languages, UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, "__text"):
            table, lettered = counts(_texts(batch, "__text"))
            if len(model.languages):
                cosine = vectors(table, model.idf) @ model.centroids.T
                best = np.argmax(cosine, 1)
                score = np.clip(cosine[np.arange(len(best)), best], 0, 1).astype(float)
                far = score < model.limits[best]
            else:
                best, score = np.zeros(len(table), int), np.zeros(len(table))
                lettered = np.zeros(len(table), bool)
                far = lettered
            best, score = np.where(lettered, best, len(languages) - 1), np.where(lettered, score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names]
                + [pa.array(languages[best], pa.string()), pa.array(score), pa.array(far | ~lettered)], [*names, *added])

    return source.mapInArrow(run, T.StructType([source.schema[n] for n in names] + [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType())]))


def held_out(key: str = "doc_id") -> Column:
    """A third of all documents, by their ids."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))
