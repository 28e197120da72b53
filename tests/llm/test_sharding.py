import random
import zlib
from bisect import bisect_right
from itertools import accumulate, combinations

import pytest
from pyspark.sql import functions as F

from sirenlog.llm import sharding as s


def plain_capacity(sizes, shards):
    """The least greatest sum of contiguous runs, over all ways to cut."""
    n = len(sizes)
    return min(max(sum(sizes[a:b]) for a, b in zip((0, *cuts), (*cuts, n)))
               for k in range(min(shards, n)) for cuts in combinations(range(1, n), k))


def plain_summary(ends):
    def summary(step, windows):
        found = {}
        for e in ends:
            if any(a <= e <= b for a, b in windows):
                low, high, n = found.get(e // step, (e, e, 0))
                found[e // step] = (min(low, e), max(high, e), n + 1)
        return list(found.values())
    return summary


@pytest.mark.parametrize("detail", [1, 4, 1 << 16])
@pytest.mark.parametrize("seed", range(25))
def test_search_is_optimal(monkeypatch, seed, detail):
    monkeypatch.setattr(s, "DETAIL", detail)
    rng = random.Random(seed)
    sizes = [rng.choice([rng.randrange(1, 9), rng.randrange(1, 90)]) for _ in range(rng.randrange(1, 12))]
    shards = rng.randrange(1, 6)
    ends = list(accumulate(sizes))
    cuts = s.search(ends[-1], max(sizes), shards, plain_summary(ends))
    assert cuts[-1] == ends[-1] and set(cuts) <= {0, *ends}
    assert max(b - a for a, b in zip([0, *cuts], cuts)) == plain_capacity(sizes, shards)


@pytest.mark.parametrize("detail", [3, 50])
def test_search_over_many_groups_asks_for_few_slices(monkeypatch, detail):
    monkeypatch.setattr(s, "DETAIL", detail)
    rng = random.Random(7)
    ends = list(accumulate(rng.choice([1, 5, 5, 40, 3000]) for _ in range(4000)))
    asked, summary = [], plain_summary(ends)

    def counted(step, windows):
        asked.append(summary(step, windows))
        return asked[-1]

    cuts = s.search(ends[-1], 3000, 9, counted)
    capacity, at = max(b - a for a, b in zip([0, *cuts], cuts)), 0
    for _ in range(9):  # one byte less does not fit
        i = bisect_right(ends, at + capacity - 1)
        at = ends[i - 1] if i else 0
    assert at < ends[-1] and max(map(len, asked)) <= 120  # of 4000 ends


def plain_shards(rows, shards):
    """Shard of every distinct group, by the rule in the module's text, with a linear search for the capacity."""
    size, first = {}, {}
    for doc_id, group, n in rows:
        size[group] = size.get(group, 0) + n
        key = (doc_id is not None, doc_id or 0)
        first[group] = min(first.get(group, key), key)
    own, rest = [], sum(size.values())
    for g in sorted(size, key=lambda g: (-size[g], g)):
        if len(own) == shards - 1 or size[g] * (shards - len(own)) < rest:
            break
        own.append(g)
        rest -= size[g]
    out = {g: i for i, g in enumerate(own)}
    others = sorted((g for g in size if g not in out), key=lambda g: (first[g], g))
    for capacity in range(max([size[g] for g in others], default=0), rest + 1):
        at, used, placed = 0, len(own), {}
        for g in others:
            if at + size[g] > capacity:
                at, used = 0, used + 1
            at += size[g]
            placed[g] = used
        if used < shards:
            return out | placed
    return out


def checked(rows, out, shards):
    want = plain_shards([(i, g, n) for i, g, n in rows], shards)
    assert sorted((repr(r.doc_id), bytes(r.text_group), r.shard) for r in out) == sorted(
        (repr(i), g, want[g]) for i, g, _ in rows)
    for k in {r.shard for r in out}:
        assert sorted(r.slot for r in out if r.shard == k) == list(range(sum(r.shard == k for r in out)))


def rows_of(sizes):
    return [(r.doc_id, bytes(r.text_group), r.size) for r in sizes.collect()]


@pytest.mark.parametrize("shards, hot", [(1, 64), (4, 2), (40, 64)])
def test_documents(spark, documents, odd_rows, monkeypatch, shards, hot):
    monkeypatch.setattr(s, "HOT_GROUPS", hot)
    rng = random.Random(shards)
    many = [(100 + i, "copy" if rng.random() < 0.3 else "t" * rng.randrange(300) + str(i % 150)) for i in range(300)]
    docs = documents(odd_rows + many, 5)
    sizes = s.document_sizes(docs.select("doc_id", "text"))
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in sizes.collect()) == sorted(
        (repr(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in odd_rows + many)
    out = s.shard_rows(sizes, "text_group", "size", "doc_id", shards)
    checked(rows_of(sizes), out.collect(), shards)
    assert not any(x in out._jdf.queryExecution().executedPlan().toString() for x in ("Python", "Pandas", "Arrow"))


def test_null_groups_sizes_and_clashing_names(spark):
    rows = spark.createDataFrame(
        [(None, None, None, "x"), (1, "a", 5, "y"), (2, None, -3, "z"), (3, "b", 7, "w"), (3, "b", 7, "w")],
        "at long, g string, n long, slot string").withColumn("shard", F.lit("old"))
    out = s.shard_rows(rows, "g", "n", "at", 2).collect()
    assert sorted((r.g or "", r.n, r.shard, r.slot) for r in out) == [
        ("", 0, 1, 0), ("", 0, 1, 1), ("a", 5, 1, 2), ("b", 7, 0, 0), ("b", 7, 0, 1)]
    assert s.shard_rows(rows.limit(0), "g", "n", "at", 3).count() == 0


def test_written_shards(spark, documents, tmp_path):
    docs = documents([(i, f"text {i % 20} " * 9) for i in range(60)])
    sized = s.document_sizes(docs.withColumn("kept", F.col("text"))).withColumnRenamed("kept", "text")
    out = s.shard_rows(sized, "text_group", "size", "doc_id", 5)
    s.write_shards(out, str(tmp_path / "shards"))
    read = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted((r.doc_id, r.text, r.shard, r.slot) for r in read.collect()) == sorted(
        (r.doc_id, r.text, r.shard, r.slot) for r in out.collect())
