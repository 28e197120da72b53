import numpy as np
import pytest
import xxhash

from sirenlog.llm import simhash as s
from sirenlog.llm.components import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    values = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def plain_components(prints, radius=3):
    """Index of the least member of each member's component, from all pairs."""
    group = list(range(len(prints)))
    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= radius and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return group


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
@pytest.mark.parametrize("split", [0, 70])
def test_links_equal_all_pairs(radius, split):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 90, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in rng.integers(0, 7, 90)], np.uint64)
    prints = np.concatenate([base, base ^ flips])
    found = {tuple(sorted(e)) for e in s.links(prints, radius, split).tolist()}
    near = {(i, j) for i in range(180) for j in range(i + 1, 180)
            if int(prints[i] ^ prints[j]).bit_count() <= radius and (not split or i < split <= j)}
    assert found <= near
    joined = lambda edges: {frozenset(g) for g in _groups(180, edges)}
    assert joined(found) == joined(near) and len(found) < 180


def _groups(n, edges):
    group = {i: {i} for i in range(n)}
    for a, b in edges:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for m in group[b]:
                group[m] = group[a]
    return group.values()


def test_odd_rows(spark, documents, odd_rows):
    prints = s.fingerprints(documents(odd_rows), keep=["doc_id"])
    prints.write.mode("overwrite").saveAsTable("simhash_odd")
    rows = s.near_copy_groups(spark.table("simhash_odd")).collect()
    assert len(rows) == len(odd_rows)
    expected = [(i, plain_fingerprint(t)) for i, t in odd_rows]
    group = plain_components([p for _, p in expected])
    least = {g: min([expected[k][0] for k in range(len(group)) if group[k] == g and expected[k][0] is not None], default=None)
             for g in group}
    key = lambda x: str(x)
    assert sorted([(r.doc_id, r.fingerprint & (1 << 64) - 1, r.component_id) for r in rows], key=key) == sorted(
        [(i, p, least[g]) for (i, p), g in zip(expected, group)], key=key)


def test_a_dense_group_in_parts(spark, monkeypatch):
    """Many fingerprints that share a band, cut into several parts."""
    monkeypatch.setattr(s, "PART", 64)
    rng = np.random.default_rng(3)
    values = {int(x) << 16 | 7 for x in rng.integers(0, 1 << 47, 400)}
    values |= {v ^ (1 << int(rng.integers(16, 64))) for v in list(values)[:200]}
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(signed)], "doc_id long, fingerprint long")
    units = s.candidate_units(frame.select("fingerprint"))
    assert units.filter("low <> high").count() > 0
    got = {r.doc_id: r.component_id for r in s.near_copy_groups(frame).collect()}
    assert [got[i] for i in range(len(signed))] == plain_components([v & (1 << 64) - 1 for v in signed])


def plain_kept(rows):
    """Index of the row that stays of each component."""
    group = plain_components([plain_fingerprint(t) for _, t in rows])
    least = {}
    for k, (i, _) in enumerate(rows):
        if group[k] not in least or (i is None, i or 0) < least[group[k]][0]:
            least[group[k]] = ((i is None, i or 0), k)
    return sorted(k for _, k in least.values())


def test_keep_one(spark, documents, odd_rows):
    docs = documents(odd_rows).selectExpr("*", "'x' AS fingerprint", "1 AS component_id", "2 AS row", "3 AS mark")
    kept = s.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    want = [odd_rows[k] for k in plain_kept(odd_rows)]
    assert sorted((str(r.doc_id) for r in rows)) == sorted(str(i) for i, _ in want) and {r.fingerprint for r in rows} == {"x"}
    assert len({plain_fingerprint(r.text) for r in rows}) == len(rows)


def test_keep_one_of_edited_copies(documents, monkeypatch):
    """Copies that differ in some words, on both sides of the radius; parts of groups too."""
    monkeypatch.setattr(s, "PART", 8)
    rng = np.random.default_rng(12)
    texts = _edited(rng, 40, 2, [0, 1, 2, 3, 6]) + _edited(rng, 3, 20, [0, 1, 2], 400)
    rows = list(enumerate(texts))
    prints = [plain_fingerprint(t) for t in texts]
    apart = [(prints[i] ^ prints[i + 1]).bit_count() for i in range(0, 80, 2)]
    assert sum(0 < x <= 3 for x in apart) > 3 and sum(x > 3 for x in apart) > 3
    assert sorted(r.doc_id for r in s.keep_one(documents(rows)).collect()) == plain_kept(rows)


@pytest.mark.parametrize("radius", [40, 51])
def test_wide_links_equal_all_pairs(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, (60, 4), dtype=np.uint64)
    near = base.copy()
    for row, n in zip(near, rng.integers(20, 70, 60)):
        for b in rng.choice(256, n, replace=False):
            row[b // 64] ^= np.uint64(1 << int(b % 64))
    prints = np.concatenate([base, near])
    found = {tuple(e) for e in s.links(prints, radius).tolist()}
    want = {(i, j) for i in range(120) for j in range(i + 1, 120)
            if int(np.bitwise_count(prints[i] ^ prints[j]).sum()) <= radius}
    joined = lambda edges: {frozenset(g) for g in _groups(120, edges)}
    assert found <= want and joined(found) == joined(want)


def test_empty(documents):
    assert s.near_copy_groups(s.fingerprints(documents([]), keep=["doc_id"])).count() == 0
    assert s.keep_one(documents([])).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    assert {(r.node, r.component) for r in components(edges).collect()} == {
        (i, 0) for i in range(61)} | {(100, 100), (101, 100)}


def _edited(rng, n_groups, copies, changes, n_words=160):
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    texts = []
    for _ in range(n_groups):
        base = [word() for _ in range(n_words)]
        for _ in range(copies):
            text = list(base)
            for at in rng.choice(n_words, int(rng.choice(changes)), replace=False):
                text[at] = word()
            texts.append(" ".join(text))
    return texts


def test_null_and_repeated_ids_join_nothing(documents):
    rows = [(None, "first text that has no id"), (None, "second text, also without one"), (None, "and a third of the kind"),
            (None, "and a third of the kind"), (5, "one text under the id five"), (5, "quite another with the same id"),
            (6, "one text under the id five")]
    kept = [(r.doc_id, r.text) for r in s.keep_one(documents(rows)).collect()]
    assert sorted(kept, key=str) == sorted([*rows[:3], *rows[4:6]], key=str)
