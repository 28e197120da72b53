import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sirenlog.llm import ranked_search as s

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_search(rows, items, k):
    held = [(i, Counter(plain_terms(t))) for i, t in rows]
    n_docs, n_terms = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    holding = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms if n_terms else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(plain_terms(text)) if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r, None if null else i, -score) for r, (score, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def check(spark, documents, rows, items, k):
    asked = spark.createDataFrame(items, "item_id string, text string").withColumn("rank", F.lit("clash"))
    docs = documents(rows, 4).withColumn("terms", F.lit("clash")).withColumn("key", F.lit("clash"))
    out = s.search(docs, asked, k=k)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, out.collect()), key=repr) == plain_search(rows, items, k)


@pytest.mark.parametrize("tile, block, k", [(1024, 256, 50), (3, 2, 3), (1, 1, 1)])
def test_against_plain_search(spark, documents, odd_rows, monkeypatch, tile, block, k):
    monkeypatch.setattr(s, "TILE_TERMS", tile)
    monkeypatch.setattr(s, "TILE_DOCUMENTS", 7)
    monkeypatch.setattr(s, "BLOCK_ITEMS", block)
    rng = random.Random(tile)
    vocabulary = [f"w{i}" for i in range(25)] + ["Été", "42", "x-y", "日本"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows = odd_rows + [(100 + i % 40, text(rng.randrange(30))) for i in range(60)] + [(7, "w1 w2")] * 30
    items = [("a", "w1 W1 w3, w5 same text"), ("b", text(12)), ("a", "twice"), (None, "one two été"), ("e", None), ("f", "nowhere")]
    check(spark, documents, rows, items, k)


def test_empty_tables(spark, documents):
    check(spark, documents, [], [("a", "x")], 5)
    check(spark, documents, [(1, "x")], [], 5)
    check(spark, documents, [(1, None), (2, " .")], [("a", "x")], 5)


def test_ties_at_the_end_of_the_list_go_by_key(spark, documents):
    rows = [(i, "same words here") for i in range(300, 0, -1)] + [(i, "none") for i in range(400, 900)]
    check(spark, documents, rows, [("a", "words")], 50)


def test_tiles_stay_exact(monkeypatch):
    """Weights so large that only few terms fit into a tile."""
    import numpy as np

    rng = np.random.default_rng(3)
    weights = rng.integers(1 << 31, 1 << 32, 40)
    row, term = np.repeat(np.arange(5), 40), np.tile(np.arange(40), 5)
    impact = rng.integers(1, s.IMPACT, 200)
    scores = s.tile_scores(row, term, impact, 5, (np.arange(40), np.zeros(40, np.int64), weights), 1)
    assert scores[:, 0].tolist() == [sum(int(a) * int(b) for a, b in zip(impact[40 * i:], weights)) for i in range(5)]
