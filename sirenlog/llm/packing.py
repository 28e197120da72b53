"""Batches of similar lengths: bucket limits by dynamic programming, a token budget per batch.

The histogram of lengths is gathered over all rows on a grid: lengths below
2**GRID_BITS are exact, longer ones are rounded up by less than 2**-(GRID_BITS-1)
of their size, so that the histogram has a proven bound (about 2**(GRID_BITS-1)
entries per doubling) at any corpus size.  The dynamic program then finds the
limits, among grid values, that minimise the padding of all rows.  Inside a
bucket, rows are dealt by hash into chunks of about CHUNK_ROWS, and batches
form inside each chunk, so no bucket is ever sorted in one task.

Defined results: a null or negative length counts as 0; an empty table gives no
rows and no bucket; a row longer than the budget is a batch of its own; equal
rows are separate members.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GRID_BITS = 10
CHUNK_ROWS = 100_000


def grid_length(length: Column) -> Column:
    """The length itself, or rounded up to GRID_BITS significant bits."""
    extra = F.greatest(F.length(F.bin(length)) - GRID_BITS, F.lit(0))
    step = F.pow(F.lit(2.0), extra).cast("bigint")
    return (F.floor((length + step - 1) / step) * step).cast("bigint")


def bucket_limits(lengths: np.ndarray, counts: np.ndarray, totals: np.ndarray, buckets: int) -> list[int]:
    """The upper limits (ascending, among ``lengths``) of at most ``buckets`` buckets with least padding.

    ``totals`` are the summed true lengths of each entry.  Ties go to the
    smaller limits.
    """
    order = np.argsort(lengths)
    v = np.asarray(lengths, np.int64)[order]
    if not len(v):
        return []
    c = np.concatenate([[0], np.cumsum(np.asarray(counts, np.int64)[order])])
    t = np.concatenate([[0], np.cumsum(np.asarray(totals, np.int64)[order])])
    m = len(v)
    best = v * c[1:] - t[1:]  # one bucket over the first j + 1 entries
    back = [np.full(m, -1)]
    for _ in range(1, min(buckets, m)):
        now, came = best.copy(), np.full(m, -2)
        for j in range(1, m):
            # the last bucket starts after entry i
            cost = best[:j] + v[j] * (c[j + 1] - c[1:j + 1]) - (t[j + 1] - t[1:j + 1])
            i = int(np.argmin(cost))
            if cost[i] < now[j]:
                now[j], came[j] = cost[i], i
        best, back = now, [*back, came]
    limits, j, k = [], m - 1, len(back) - 1
    while j >= 0:
        while back[k][j] == -2:  # one bucket fewer is as good
            k -= 1
        limits.append(int(v[j]))
        j, k = int(back[k][j]), k - 1
    return limits[::-1]


def length_histogram(rows: DataFrame, length: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grid lengths, rows and summed lengths over the whole table; bounded by the grid."""
    found = rows.groupBy(grid_length(F.col(length)).alias("g")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(length).alias("t")).collect()
    return tuple(np.array([r[i] for r in found], np.int64) for i in range(3))


def pack(rows: DataFrame, length: str, keys: list[str], buckets: int = 16, budget: int = 65_536) -> DataFrame:
    """The rows with ``bucket``, ``bucket_length``, ``chunk``, ``batch`` and ``place``.

    A batch is (bucket, chunk, batch); its rows, padded to ``bucket_length``,
    fit the budget.  ``keys`` are the columns that order and deal the rows.
    ``rows`` is read twice, so it should be a stored table.
    """
    added = ["bucket", "bucket_length", "chunk", "batch", "place"]
    rows = rows.drop(*added).withColumn(length, F.greatest(F.coalesce(length, F.lit(0)), F.lit(0)).cast("bigint"))
    lengths, counts, totals = length_histogram(rows, length)
    limits = bucket_limits(lengths, counts, totals, buckets)
    if not limits:
        return rows.select("*", *[F.lit(None).cast("bigint").alias(name) for name in added])
    held = [int(counts[(lengths <= high) & (lengths > low)].sum()) for low, high in zip([-1, *limits], limits)]
    pick = lambda values: F.element_at(F.array(*[F.lit(x).cast("bigint") for x in values]), F.col("bucket") + 1)
    dealt = rows.withColumn(
        "bucket", sum((F.col(length) > x).cast("int") for x in limits[:-1]) if len(limits) > 1 else F.lit(0)
    ).withColumn("bucket_length", pick(limits)).withColumn(
        "chunk", F.pmod(F.xxhash64(*keys), pick([-(-n // CHUNK_ROWS) for n in held])))
    place = F.row_number().over(Window.partitionBy("bucket", "chunk").orderBy(*keys)) - 1
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest("bucket_length", F.lit(1)))).cast("bigint")
    return dealt.withColumn("__at", place.cast("bigint")).withColumns({
        "batch": F.floor(F.col("__at") / per_batch), "place": F.col("__at") % per_batch}).drop("__at")
