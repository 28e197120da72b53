import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sirenlog.llm import phrases as p

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_collocations(rows, least, keep):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    f[lang or "und"][tuple(words[i:i + m])] += 1
    out = []
    for lang, counts in f.items():
        kept = [q for q, a in counts.items() if len(q) > 1 and a >= least]
        scored = []
        for q in kept:
            a = counts[q]
            if any(len(x) > len(q) and counts[x] >= a and any(x[i:i + len(q)] == q for i in range(len(x))) for x in kept):
                continue
            score, k = min((1000 * a * n[lang] // (counts[q[:k]] * counts[q[k:]]), k) for k in range(1, len(q)))
            scored.append((-score, -a, " ".join(q).encode(), counts[q[:k]], counts[q[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:keep], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def some_rows(seed, n=160):
    rng = random.Random(seed)
    words = ["the", "of", "New", "York", "new", "été", "x", "y", "z", "日本", "a'b"] + [f"r{i}" for i in range(60)]
    glue = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", ";\x0b"]
    text = lambda: "".join(rng.choice(words[:rng.choice([4, 11, 71])]) + rng.choice(glue) for _ in range(rng.randrange(40)))
    rows = [(rng.choice(["en", "en", "fr", None]), text()) for _ in range(n)]
    return rows + [("en", None), (None, ""), ("de", "!?"), ("en", "One Common passage that Repeats of the new york")] + [
        ("fr", "one common passage of the same words.")] * 30


def frame(spark, rows, partitions=3):
    full = [(lang, text, "clash", 1) for lang, text in rows]
    return spark.createDataFrame(full, "lang string, text string, word string, n int").repartition(partitions)


@pytest.mark.parametrize("known, entries, burst, share", [(1 << 19, 300_000, 4096, 1024), (5, 40, 8, 3), (0, 1, 2, 1 << 30), (12, 60, 4, 40)])
def test_against_plain_counts(spark, monkeypatch, known, entries, burst, share):
    for name, value in (("KNOWN", known), ("ENTRIES", entries), ("BURST", burst), ("SHARE", share), ("SLICE", 2000)):
        monkeypatch.setattr(p, name, value)
    rows = some_rows(known)
    for least, keep in ((4, 2000), (9, 7)):
        out = p.collocations(frame(spark, rows), least=least, keep=keep)
        assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, out.collect())) == plain_collocations(rows, least, keep)


def test_empty_tables(spark):
    assert p.collocations(frame(spark, []).limit(0)).count() == 0
    assert p.collocations(frame(spark, [("en", None), ("en", "x y")])).count() == 0


def test_ids_that_meet_are_drawn_anew(spark, monkeypatch):
    rows = [("en", "a b c d e f g h. a b c") for _ in range(8)]
    checked, judge = [], p._distinct_codes
    monkeypatch.setattr(p, "KNOWN", 1)
    monkeypatch.setattr(p, "_distinct_codes", lambda counted, salt: checked.append(judge(counted, salt)) or salt == 2)
    assert sorted(map(tuple, p.collocations(frame(spark, rows), least=5).collect())) == plain_collocations(rows, 5, 2000)
    assert checked == [True] * 3
    monkeypatch.setattr(p, "_MASK", 3)  # eight words, four ids
    assert not judge(p.count_words(frame(spark, rows).select("text", "lang"), 0), 0)


def test_codes_agree_with_the_column(spark):
    pairs = [("en", "a"), ("fr", "été"), ("und", "日本 語")]
    rows = spark.createDataFrame([(x, bytearray(y.encode())) for x, y in pairs], "lang string, word binary")
    for salt in (0, 7):
        assert [r[0] for r in rows.select(p.code_column(salt)).collect()] == p.codes(
            [x for x, _ in pairs], [y.encode() for _, y in pairs], salt).tolist()


def test_distinct_windows_of_many_words():
    rng = np.random.default_rng(1)
    columns = [rng.integers(0, 3, 500) for _ in range(5)]
    for n_words in (3, 1 << 40):
        rows, n = p.distinct_windows(columns, n_words)
        assert Counter(map(tuple, np.stack(columns, axis=1).tolist())) == dict(zip(map(tuple, rows.tolist()), n.tolist()))


def test_pieces_end_at_texts():
    block = p.read_block(pa.array(["a b", "c", None, " d.e"]), pa.array(["x", "x", None, "x"]))
    assert block.joined.tolist() == [True, False, False, False, False]


@pytest.mark.parametrize("width", [3, 8])
def test_keys_hold_ids(width):
    rng = np.random.default_rng(width)
    rows = rng.integers(1, 1 << (8 * width - 1), (200, 5))
    rows[np.arange(5) >= rng.integers(2, 6, 200)[:, None]] = 0
    keys = p.as_keys(rows, width)
    assert (p.from_keys(keys, width) == rows).all() and (p.from_keys(keys[20:50], width) == rows[20:50]).all()
    order = sorted(range(200), key=lambda i: keys[i].as_py())
    assert rows[order].tolist() == sorted(rows.tolist())
