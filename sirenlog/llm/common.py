"""What several operators of this folder share: folders, tables, text buffers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sirenlog.session import shared_folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(frame: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and repeats no work."""
    folder = new_folder(frame.sparkSession, name)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


SAMPLED = 64  # rows of the sample that sets the limits, for each part


def ordered_parts(rows: DataFrame, by: list[str], n: int) -> DataFrame:
    """The rows in ``n`` partitions of rising ``by``, sorted.

    Unlike a range exchange, which samples its limits anew whenever it is
    planned, this one takes limits that were collected once (``n`` - 1 of them):
    every use of the result has the same rows in the same partitions.
    """
    narrow = rows.select(*by)
    sample = narrow.orderBy(F.xxhash64(*by), *by).limit(SAMPLED * n).orderBy(*by).collect()
    limits = [sample[i * len(sample) // n] for i in range(1, n) if sample]
    part = F.lit(0)
    if limits:
        held = F.array(*[F.struct(*[F.lit(r[c]).cast(narrow.schema[c].dataType).alias(c) for c in by]) for r in limits])
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(limits).bit_length()))])
        # Binary search for the number of limits below a row; null values come first, as in the sort.
        part = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
            (at + step <= len(limits)) & (F.get(held, at + step - 1) < F.struct(*by)), at + step).otherwise(at))
    return rows.repartitionById(n, part).sortWithinPartitions(*by)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of the batches whose texts hold about ``limit`` bytes; a longer text is a part of its own."""
    for batch in batches:
        ends = _byte_ends(batch.column(column))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _byte_ends(texts: pa.Array) -> np.ndarray:
    lengths = pc.binary_length(texts).fill_null(0)
    return np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow string column as one byte array, and the row limits in it; null is empty."""
    ends = _byte_ends(texts)
    bounds = np.concatenate([np.zeros(1, np.int64), ends])
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    first, last = int(offsets[texts.offset]), int(offsets[texts.offset + len(texts)])
    data = texts.buffers()[2]
    if data is None or first == last:
        return np.zeros(0, np.uint8), bounds
    return np.frombuffer(data, np.uint8)[first:last], bounds
