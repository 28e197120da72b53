import hashlib
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from sirenlog.llm import repeats as r
from sirenlog.llm.suffixes import Suffixes, nearest_smaller


@pytest.mark.parametrize("n", [0, 1, 2, 5, 64, 300])
def test_nearest_smaller(n):
    v = np.random.default_rng(n).permutation(n)
    want = [max([j for j in range(i) if v[j] < v[i]], default=-1) for i in range(n)]
    assert nearest_smaller(v).tolist() == want


@pytest.mark.parametrize("seed", range(20))
def test_factors(seed):
    rng = np.random.default_rng(seed)
    strings = [bytes(rng.integers(97, 99 + seed % 3, rng.integers(0, 40)).astype(np.uint8)) for _ in range(seed % 7)]
    places = [(k, i) for k, x in enumerate(strings) for i in range(len(x) + 1)]

    def common(a, b):
        x, y = strings[a[0]][a[1]:], strings[b[0]][b[1]:]
        return next((i for i in range(min(len(x), len(y))) if x[i] != y[i]), min(len(x), len(y)))

    s = Suffixes(strings, 16)
    for among in (np.ones(len(places), bool), rng.random(len(places)) < 0.4):
        for earlier in (True, False):
            got = s.factors(earlier, among)
            for p, a in enumerate(places):
                want = max([common(a, b) for q, b in enumerate(places)
                            if (q < p if earlier else q > p) and among[p] and among[q]], default=0)
                assert min(want, 16) == min(got[p], 16)
    assert s.factors().tolist() == s.factors(among=np.ones(len(places), bool)).tolist()


def plain_ranges(rows, keep):
    """Merged ranges of repeated windows, from all windows of all texts."""
    size = r.LENGTH
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, rows[k][1] or ""))
    data = [(rows[k][1] or "").encode() for k in range(len(rows))]
    count, first = Counter(), {}
    for k in order:
        for p in range(len(data[k]) - size + 1):
            window = data[k][p:p + size]
            count[window] += 1
            first.setdefault(window, (rows[k], p))
    return data, [r.merged([
        (p, p + size) for p in range(len(d) - size + 1)
        if count[d[p:p + size]] > 1 and (keep == "none" or first[d[p:p + size]] != (rows[k], p))])
        for k, d in enumerate(data)]


def _corpus():
    rng = np.random.default_rng(1)
    line = lambda n: " ".join("".join(rng.choice(list("abcdeé"), 4)) for _ in range(n))
    shared, common = line(60), line(30)
    rows = [(i, f"{line(15)} {shared[:150 + 20 * i]} {line(15)}") for i in range(8)]
    base = line(120)
    rows += [(20 + i, base[:100 * i] + "#" + base[100 * i:]) for i in range(6)]  # near copies
    rows += [(30 + i, base) for i in range(4)]                                      # copies
    rows += [(40 + i, f"{line(5)}\n{common}\n{line(5)}") for i in range(12)]        # one passage, many surroundings
    rows += [(60, shared + " " + line(3) + " " + shared), (61, "ab" * 400), (62, "x" * 199), (63, "x" * 200),
             (64, "x" * 201), (65, None), (66, ""), (67, "日本" * 200)]
    return rows


@pytest.mark.parametrize("hot, shard", [(2048, 1 << 20), (2, 1 << 20), (2048, 2000)])
def test_every_occurrence(documents, monkeypatch, hot, shard):
    monkeypatch.setattr(r, "HOT", hot)
    monkeypatch.setattr(r, "SHARD", shard)
    rows = _corpus()
    data, ranges = plain_ranges(rows, "none")
    got = {x.doc_id: tuple(x)[1:] for x in r.removal_digests(documents(rows)).collect()}
    for (i, _), d, spans in zip(rows, data, ranges):
        kept = r.without(d, spans)
        assert got[i] == (len(d), len(d) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()), i


def test_a_text_in_parts_has_the_same_anchors(monkeypatch):
    data = np.frombuffer("\n".join(t or "" for _, t in _corpus()).encode(), np.uint8)
    bounds = np.array([0, len(data)])

    def by_window():
        _, place, windows, anchor, _ = r.runs(data, bounds)
        assert sorted(np.concatenate([np.arange(p, p + n) for p, n in zip(place, windows)])) == list(range(len(data) - 199))
        return {p + i: h for p, n, h in zip(place.tolist(), windows.tolist(), anchor.tolist()) for i in range(n)}

    whole = by_window()
    for part in (450, 1000, len(data) - 1):
        monkeypatch.setattr(r, "PART", part)
        assert by_window() == whole


def _peak_mb(step):
    tracemalloc.start()
    try:
        step()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_worker_holds_little():
    """Two of these fit beside an executor's JVM, whatever the length of a text."""
    data = np.random.default_rng(1).integers(97, 123, 4 << 20).astype(np.uint8)
    assert _peak_mb(lambda: r.runs(data, np.array([0, len(data)]))) < 150
    text = data[:r.SHARD].tobytes()
    strings = [text[i:i + 300] for i in range(0, len(text), 300)]
    assert _peak_mb(lambda: Suffixes(strings, r.LENGTH).factors()) < 100


@pytest.mark.parametrize("hot", [2048, 2])
def test_later_copies(documents, monkeypatch, hot):
    monkeypatch.setattr(r, "HOT", hot)
    rows = _corpus()
    data, ranges = plain_ranges(rows, "first")
    docs = documents(rows).selectExpr("*", "1 AS ranges", "2 AS row", "3 AS _key")
    out = r.remove_later_copies(docs)
    assert out.columns == docs.columns
    got = {x.doc_id: x for x in out.collect()}
    for (i, text), d, spans in zip(rows, data, ranges):
        want = None if text is None else r.without(d, r.whole_characters(d, spans)).decode()
        assert got[i].text == want and got[i].ranges == 1, i


def test_odd_rows(documents, odd_rows):
    rows = [x for x in odd_rows if x[0] != 10]
    data, ranges = plain_ranges(rows, "none")
    want = sorted((str(i), len(d), len(r.without(d, s)), len(s)) for (i, _), d, s in zip(rows, data, ranges))
    got = sorted((str(x.doc_id), x.n_bytes, x.n_bytes - x.n_removed, x.n_spans)
                 for x in r.removal_digests(documents(rows)).collect())
    assert got == want


def test_a_very_long_text(documents, odd_rows):
    text = next(t for i, t in odd_rows if i == 10)
    [row] = r.removal_digests(documents([(1, text)])).collect()
    # It repeats itself more than three times over, so nothing of it is left.
    size = len(text.encode())
    assert (row.n_bytes, row.n_removed, row.n_spans) == (size, size, 1)


def test_empty(documents):
    assert r.removal_digests(documents([])).count() == 0
    assert r.remove_later_copies(documents([])).count() == 0
