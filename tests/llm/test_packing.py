from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from sirenlog.llm import packing as p


def padding(limits, lengths):
    return sum(min(x for x in limits if x >= n) - n for n in lengths)


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("buckets", [1, 2, 3, 5])
def test_limits_are_optimal(seed, buckets):
    rng = np.random.default_rng(seed)
    lengths = (rng.zipf(1.6, rng.integers(1, 60)) % 40).tolist()
    count = Counter(lengths)
    values = sorted(count)
    limits = p.bucket_limits(np.array(values), np.array([count[v] for v in values]),
                             np.array([v * count[v] for v in values]), buckets)
    best = min(padding([*c, values[-1]], lengths) for k in range(buckets) for c in combinations(values[:-1], k))
    assert padding(limits, lengths) == best and len(limits) <= buckets and limits == sorted(limits)


def test_grid(spark):
    lengths = [0, 1, 1023, 1024, 1025, 2047, 2049, 4100, 123_457, (1 << 40) + 1]
    frame = spark.createDataFrame([(n,) for n in lengths], "n long")
    from pyspark.sql import functions as F
    got = [r[0] for r in frame.select(p.grid_length(F.col("n"))).collect()]
    for n, g in zip(lengths, got):
        step = 1 << max(0, n.bit_length() - p.GRID_BITS)
        assert g == -(-n // step) * step


@pytest.mark.parametrize("chunk", [100_000, 50])
def test_batches(spark, monkeypatch, chunk):
    monkeypatch.setattr(p, "CHUNK_ROWS", chunk)
    rng = np.random.default_rng(1)
    rows = [(i, int(n), "mine") for i, n in enumerate(rng.zipf(1.4, 1500) % 900)]
    rows += [(2000, None, "mine"), (2001, -5, "mine"), (2002, 5000, "mine"), (7, 3, "mine"), (7, 3, "mine"), (None, 4, "mine")]
    frame = spark.createDataFrame(rows, "doc_id long, n long, batch string").repartition(4)
    out = p.pack(frame, "n", ["doc_id"], buckets=6, budget=1200).collect()
    assert len(out) == len(rows)
    batches = {}
    for r in out:
        assert r.bucket_length >= r.n >= 0
        batches.setdefault((r.bucket, r.chunk, r.batch), []).append(r)
    for rows_of in batches.values():
        assert sorted(r.place for r in rows_of) == list(range(len(rows_of)))
        assert len(rows_of) == 1 or len(rows_of) * rows_of[0].bucket_length <= 1200
    limits = sorted({r.bucket_length for r in out})
    assert len(limits) == 6 and all(r.bucket_length == min(x for x in limits if x >= r.n) for r in out)
    again = p.pack(frame.repartition(2), "n", ["doc_id"], buckets=6, budget=1200)
    assert sorted(map(str, again.collect())) == sorted(map(str, out))


def test_empty(spark):
    out = p.pack(spark.createDataFrame([], "doc_id long, n long"), "n", ["doc_id"])
    assert out.count() == 0 and "batch" in out.columns
