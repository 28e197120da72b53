import hashlib

import numpy as np
import pytest

from pyspark.sql import types as T

from sirenlog.llm import chunks as c


def plain_gear(data):
    h, out = 0, []
    for b in data:
        h = (2 * h + int(c._GEAR[b])) & 0xFFFFFFFF
        out.append(h)
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 31, 32, 33, 500])
def test_gear_hash(n):
    data = np.random.default_rng(n).integers(0, 256, n).astype(np.uint8)
    assert c.gear_hash(data).tolist() == plain_gear(data.tolist())


def plain_cuts(data):
    h, ends, start = plain_gear(data), [], 0
    for i in range(len(data)):
        size = i + 1 - start
        pattern = int(c.STRICT) if size < c.USUAL else int(c.LOOSE)
        if size == c.MOST or c.LEAST <= size and h[i] & pattern == 0:
            ends.append(i + 1)
            start = i + 1
    return ends + ([len(data)] if start < len(data) else [])


@pytest.mark.parametrize("n", [0, 1, 24, 25, 100, 5000])
def test_cuts(n):
    rng = np.random.default_rng(n)
    for data in (rng.integers(0, 256, n), rng.integers(97, 100, n), np.zeros(n)):
        data = data.astype(np.uint8)
        ends = c.cuts(data)
        # A text's last piece may be at most LEAST long and is never searched.
        plain = plain_cuts(data.tolist())
        assert ends == plain or ends[:-1] == plain[:-1] and ends[-1] == plain[-1] == n


def test_an_insertion_moves_few_chunks():
    rng = np.random.default_rng(0)
    text = bytes(rng.integers(97, 123, 20_000).astype(np.uint8))
    changed = text[:9000] + b"inserted words" + text[9000:]
    assert c.likeness(c.chunk_set(text), c.chunk_set(changed)) > 0.97
    other = bytes(rng.integers(97, 123, 20_000).astype(np.uint8))
    assert c.likeness(c.chunk_set(text), c.chunk_set(other)) == 0


def test_likeness_limits():
    a = c.chunk_set(b"some text " * 50)
    assert c.likeness(a, a) == 1 and c.likeness({}, {}) == 1 and c.likeness(a, {}) == c.likeness({}, a) == 0
    assert c.from_text(c.as_text(a)) == a


@pytest.mark.parametrize("partitions", [1, 5])
def test_neighbours(spark, documents, odd_rows, partitions):
    rows = [(i, t) for i, t in odd_rows if i is not None and i not in (9, 11)] + [(50 + i, f"text {i} " * i) for i in range(20)]
    out = c.map_neighbours(documents(rows, partitions), "doc_id", "text", c.compare_with_next, c.EDITED)
    got = {r.doc_id: tuple(r)[1:] for r in out.collect()}
    texts = [(i, t or "") for i, t in sorted(rows)]
    for (i, text), (_, after) in zip(texts, texts[1:] + texts[:1]):
        cut = len(text) // 4
        changed = text[:len(text) - cut] + after[:cut]
        assert got[i] == c.compare_with_next(text, after) and got[i][0] == len(text)
        assert got[i][1] == hashlib.sha256(changed.encode()).hexdigest()
        assert got[i][5] == c.likeness(c.chunk_set(text.encode()), c.chunk_set(after.encode()))
    assert len(got) == len(rows)


def test_ties_and_few_rows(spark, documents, odd_rows):
    assert c.map_neighbours(documents(odd_rows), "doc_id", "text", c.compare_with_next, c.EDITED).count() == len(odd_rows)
    [row] = c.map_neighbours(documents([(1, "alone with itself")]), "doc_id", "text", c.compare_with_next, c.EDITED).collect()
    assert row.near_next == 1
    assert c.map_neighbours(documents([]), "doc_id", "text", c.compare_with_next, c.EDITED).count() == 0


def test_fingerprints_keep_columns(documents, odd_rows):
    docs = documents(odd_rows).selectExpr("*", "1 AS fingerprint", "2 AS other")
    out = c.fingerprints(docs)
    assert out.columns == [*docs.drop("fingerprint").columns, "fingerprint"]
    by_text = {}
    for r in out.collect():
        assert by_text.setdefault(r.text or "", r.fingerprint) == r.fingerprint


def test_every_row_has_its_neighbour_however_the_plan_is_made(spark, documents, monkeypatch):
    """More rows than the sample of the limits, without the optimizer's reuse of exchanges and without adaptive plans."""
    from sirenlog.llm import common
    monkeypatch.setattr(common, "SAMPLED", 2)
    rows = [(None, f"none {i}") for i in range(5)] + [(i // 2, f"text {i}") for i in range(3000)]
    want = None
    for reuse in ("true", "false"):
        for adaptive in ("true", "false"):
            spark.conf.set("spark.sql.exchange.reuse", reuse)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            got = c.map_neighbours(documents(rows, 7), "doc_id", "text", lambda a, b: (f"{a}|{b}",), T.StructType([
                T.StructField("pair", T.StringType())])).collect()
            assert len(got) == len(rows) == len({r.pair.split("|")[0] for r in got}) == len({r.pair.split("|")[1] for r in got})
            assert {r.doc_id for r in got if r.pair.startswith("none")} == {None}
            want = want or sorted(map(str, got))
            assert sorted(map(str, got)) == want
    spark.conf.unset("spark.sql.exchange.reuse")
    spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("n", [1, 2, 5, 32])
def test_parts_are_ranges(spark, n):
    from sirenlog.llm.common import ordered_parts
    rows = spark.range(500).selectExpr("CASE WHEN id % 50 <> 3 THEN (id * 37) % 211 END AS k", "id AS tie")
    parts = ordered_parts(rows, ["k", "tie"], n).selectExpr("spark_partition_id() AS p", "k", "tie").collect()
    assert [r.p for r in parts] == sorted(r.p for r in parts) and len(parts) == 500
    assert [(r.k is not None, r.k or 0, r.tie) for r in parts] == sorted((r.k is not None, r.k or 0, r.tie) for r in parts)
    assert len({r.p for r in parts}) == n
