"""Ranked lexical search: dense blocked products of item weights and document impacts, exact to the last unit.

Items come in blocks of bounded size, each with its own compact vocabulary.
One pass over all texts counts their terms and keeps, per document, those of
the block's vocabulary; corpus counts are sums over all rows.  A second pass
multiplies tiles: documents by terms (impacts) times terms by items (weights),
in float64.  All factors are whole numbers, and a tile has so few terms that no
partial sum reaches 2**53, so every product is exact in any order of addition;
tiles are added up as 64-bit integers.  Each task keeps the best ``k`` of every
item, equal scores by document key, and the tasks' lists are merged twice, by
item and part and then by item.

The work grows with documents times blocks; memory is bounded by a tile, a
block of items, ``k`` and the longest text.

Defined results: null and empty texts hold no term; items without a known term
have no rows; equal scores go by ascending key, null keys last; repeated rows
and repeated items count and rank separately; empty tables give no rows; only
the named columns of the inputs are read, whatever the others are called.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sirenlog.llm import words as w
from sirenlog.llm.common import materialize, new_folder, slices, text_bytes

BLOCK_ITEMS, BLOCK_TERMS = 256, 65_536   # a block of items ends before it exceeds either
TILE_DOCUMENTS, TILE_TERMS = 512, 1024
PARTS = 64                               # parts in which the tasks' lists are merged first
SLICE = 1 << 22
EXACT = 1 << 53
IMPACT = 1_000_000                       # impacts are below
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts in order, A-Z lower-cased, and the number of terms before each text (and in all)."""
    data, bounds = text_bytes(texts)
    inside = _TERM[data]
    start, end, at = w.runs(inside, bounds)
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    kept = _LOWER[data[inside]]
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]), at


def term_counts(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms in each text; and text, term and occurrences of every pair that is in the vocabulary, sorted."""
    found, at = terms(texts)
    index = pc.index_in(found, vocabulary)
    known = np.flatnonzero(index.is_valid().to_numpy(zero_copy_only=False))
    text = np.searchsorted(at, known, "right") - 1
    number = index.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
    pairs, n = np.unique(text * max(1, len(vocabulary)) + number, return_counts=True)
    return np.diff(at), pairs // max(1, len(vocabulary)), pairs % max(1, len(vocabulary)), n


def blocks(items: Iterator[Row], text: str) -> Iterator[list[tuple[Row, list[bytes]]]]:
    """Items with their different terms, in blocks of bounded size (an item alone may exceed it)."""
    block, vocabulary = [], set()
    for row in items:
        own = sorted(set(terms(pa.array([row[text]], pa.string()))[0].to_pylist()))
        if block and (len(block) == BLOCK_ITEMS or len(vocabulary.union(own)) > BLOCK_TERMS):
            yield block
            block, vocabulary = [], set()
        block.append((row, own))
        vocabulary.update(own)
    if block:
        yield block


_COUNTED = "n bigint, terms array<int>, counts array<bigint>"


def count_terms(documents: DataFrame, key: str, text: str, vocabulary: list[bytes]) -> DataFrame:
    """``key``, ``n`` and the vocabulary's terms with their counts, for every document; stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.large_binary())
        for part in slices(batches, "text", SLICE):
            n, row, term, count = term_counts(part.column("text"), known)
            offsets = pa.array(np.searchsorted(row, np.arange(len(n) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array(n.astype(np.int64)),
                 pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(count))], ["key", "n", "terms", "counts"])

    narrow = documents.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    return materialize(narrow.mapInArrow(run, f"key bigint, {_COUNTED}"), "term-counts")


def weight(n_documents: int, n_holding: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * n_holding + 1)))


def impacts(count: np.ndarray, n: np.ndarray, n_documents: int, n_terms: int) -> np.ndarray:
    """The impact of ``count`` occurrences in texts of ``n`` terms; lengths in Python's integers, which cannot overflow."""
    longer = {x: 50 + 50 * x * n_documents // n_terms for x in np.unique(n).tolist()}
    m = np.array([longer[x] for x in n.tolist()], np.int64)
    return (1_000_000_000 * count) // (1000 * count + 20 * m)


class Best:
    """The best ``k`` documents of every item so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.zeros(n_items, np.int64)
        self.item = self.score = self.at = np.zeros(0, np.int64)
        self.keys, self.waiting, self.n_waiting = pa.array([], pa.int64()), [], 0

    def add(self, scores: np.ndarray, keys: pa.Array) -> None:
        """``scores`` is documents by items; only rows that may still matter are kept, equal ones included."""
        document, item = np.nonzero((scores > 0) & (scores >= self.least))
        self.waiting.append((item, scores[document, item], keys.take(pa.array(document))))
        self.n_waiting += len(item)
        if self.n_waiting > 4 * self.k * len(self.least):
            self.settle()

    def settle(self) -> None:
        item = np.concatenate([self.item, *(x[0] for x in self.waiting)])
        score = np.concatenate([self.score, *(x[1] for x in self.waiting)])
        keys = pa.concat_arrays([self.keys, *(x[2].combine_chunks() if isinstance(x[2], pa.ChunkedArray) else x[2]
                                              for x in self.waiting)])
        self.waiting, self.n_waiting = [], 0
        order = np.lexsort((keys.fill_null(0).to_numpy(), keys.is_null().to_numpy(zero_copy_only=False), -score, item))
        item, score = item[order], score[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = place < self.k
        self.item, self.score, self.keys = item[kept], score[kept], keys.take(pa.array(order[kept]))
        last = place[kept] == self.k - 1
        self.least[self.item[last]] = self.score[last]


def tile_scores(row: np.ndarray, term: np.ndarray, impact: np.ndarray, n_rows: int,
                entries: tuple[np.ndarray, np.ndarray, np.ndarray], n_items: int) -> np.ndarray:
    """Scores of one tile of documents against all items of the block; ``entries`` are (term, item, weight) by term."""
    scores = np.zeros((n_rows, n_items), np.int64)
    if not len(term):
        return scores
    order = np.argsort(term, kind="stable")
    row, term, impact = row[order], term[order], impact[order]
    of_term, of_item, weights = entries
    width = max(1, min(TILE_TERMS, (EXACT - 1) // (IMPACT * max(1, int(weights.max())))))
    for low in range(0, int(term[-1]) + 1, width):
        a, b = np.searchsorted(term, [low, low + width])
        c, d = np.searchsorted(of_term, [low, low + width])
        if a == b or c == d:
            continue
        left = np.zeros((n_rows, width))
        left[row[a:b], term[a:b] - low] = impact[a:b]
        right = np.zeros((width, n_items))
        right[of_term[c:d] - low, of_item[c:d]] = weights[c:d]
        scores += (left @ right).astype(np.int64)
    return scores


def best_of_block(counted: DataFrame, block: list[tuple[Row, list[bytes]]], vocabulary: list[bytes], k: int) -> DataFrame:
    """``item`` (its place in the block), ``rank``, ``key`` and ``score``."""
    whole = counted.filter("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    n_documents, n_terms = whole[0], whole[1] or 0
    holding = dict(counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # <= the vocabulary
    weights = np.array([weight(n_documents, holding.get(i, 0)) for i in range(len(vocabulary))], np.int64)
    number = {t: i for i, t in enumerate(vocabulary)}
    pairs = sorted((number[t], i) for i, (_, own) in enumerate(block) for t in own)
    of_term, of_item = (np.array([p[j] for p in pairs], np.int64) for j in range(2))
    entries, n_items = (of_term, of_item, weights[of_term]), len(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(n_items, k)
        for batch in batches:
            for start in range(0, batch.num_rows, TILE_DOCUMENTS):
                tile = batch.slice(start, TILE_DOCUMENTS)
                count = tile.column("counts").flatten().to_numpy()
                row = np.repeat(np.arange(tile.num_rows), pc.list_value_length(tile.column("terms")).to_numpy())
                impact = impacts(count, tile.column("n").to_numpy()[row], n_documents, n_terms)
                term = tile.column("terms").flatten().to_numpy().astype(np.int64)
                best.add(tile_scores(row, term, impact, tile.num_rows, entries, n_items), tile.column("key"))
        best.settle()
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item.astype(np.int32)), best.keys, pa.array(best.score)], ["item", "key", "score"])

    found = counted.filter("size(terms) > 0").mapInArrow(run, "item int, key bigint, score bigint")
    order = [F.desc("score"), F.asc_nulls_last("key")]
    part = F.coalesce(F.pmod(F.xxhash64("key"), F.lit(PARTS)), F.lit(0))
    for by in (["item", "part"], ["item"]):
        found = found.withColumn("part", part).withColumn("rank", F.row_number().over(
            Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)
    return found.select("item", "rank", "key", "score")


def search(documents: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id",
           text: str = "text", k: int = 50) -> DataFrame:
    """``item_key``, ``rank``, ``key`` (as a long) and ``score`` of the best ``k`` documents of every item."""
    spark, folder = documents.sparkSession, new_folder(documents.sparkSession, "ranked")
    item_type = items.schema[item_key].dataType
    asked = items.select(F.col(item_key).alias("item"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField(item_key, item_type), T.StructField("rank", T.IntegerType()),
                           T.StructField(key, T.LongType()), T.StructField("score", T.LongType())])
    n_blocks = 0
    for block in blocks(asked.toLocalIterator(), "text"):
        vocabulary = sorted({t for _, own in block for t in own})
        counted = count_terms(documents, key, text, vocabulary)
        names = spark.createDataFrame(
            [(i, row["item"]) for i, (row, _) in enumerate(block)],
            T.StructType([T.StructField("item", T.IntegerType()), T.StructField("name", item_type)]))
        found = best_of_block(counted, block, vocabulary, k).join(F.broadcast(names), "item")  # <= BLOCK_ITEMS rows
        found.select(F.col("name").alias(item_key), "rank", F.col("key").alias(key), "score").write.parquet(
            f"{folder}/block={n_blocks}")
        n_blocks += 1
    if not n_blocks:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{folder}/block={i}" for i in range(n_blocks)])
