import zlib

import numpy as np
import pytest

from sirenlog.llm import token_shards as t
from sirenlog.llm.bpe import load
from sirenlog.llm.common import new_folder


@pytest.mark.parametrize("n", [0, 1, 2, 3, 40, 5000, 60_000])
def test_round_trip_and_random_access(n):
    rng = np.random.default_rng(n)
    for ids in ((rng.zipf(1.3, n) % 40_000), np.zeros(n), np.arange(n) % 2, np.arange(n) % 70_000):
        ids = ids.astype(np.uint32)
        g = t.Grammar(t.compress(ids, 70_001))
        assert np.array_equal(g.all(), ids) and g.ids == n
        assert len(g.lengths) == len(g.table)
        for start in (0, 1, n // 2, n - 1, n):
            for count in (0, 1, 7, n):
                assert np.array_equal(g.range(start, count), ids[max(start, 0):max(start, 0) + count])


def test_frequent_pairs_become_rules():
    ids = np.array([5, 6, 7, 8] * 500, np.uint32)
    g = t.Grammar(t.compress(ids, 10))
    assert g.lengths.max() >= 4 and len(g.sequence) < len(ids) / 3


@pytest.mark.parametrize("seed", range(6))
def test_no_frequent_pair_is_left(seed):
    rng = np.random.default_rng(seed)
    passage = rng.integers(0, 50, 700)
    ids = np.concatenate([np.concatenate([passage, rng.integers(0, 900, 300)]) for _ in range(30)]
                         + [np.full(5000, 3), rng.zipf(1.5, 20_000) % 900]).astype(np.uint32)
    g = t.Grammar(t.compress(ids, 1000))
    assert np.array_equal(g.all(), ids)
    pairs, n = np.unique(np.stack([g.sequence[:-1], g.sequence[1:]]), axis=1, return_counts=True)
    assert n.max() < t.LEAST_COUNT
    assert g.lengths.max() >= 300  # the passage, by and by


def test_equal_ids_shrink_to_few_symbols():
    g = t.Grammar(t.compress(np.full(100_000, 7, np.uint32), 10))
    assert len(g.sequence) <= 2 * t.LEAST_COUNT and len(g.table) <= 20 and g.all().tolist() == [7] * 100_000
    assert g.range(99_990, 50).tolist() == [7] * 10


def test_wide_symbols():
    ids = (np.arange(200_000) % 70_000).astype(np.uint32)
    g = t.Grammar(t.compress(ids, 70_001))
    assert np.array_equal(g.all(), ids) and g.range(69_990, 20).tolist() == ids[69_990:70_010].tolist()


def test_a_foreign_block_is_refused():
    with pytest.raises(ValueError):
        t.Grammar(b"XXXX" + bytes(20))


def _ids(texts):
    library = load().library
    return [[*library.encode(x, add_special_tokens=False).ids, t.END_ID] for x in texts]


def _split(ids, lengths):
    return [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]


def test_many_texts_at_once_as_the_library_encodes_them(monkeypatch):
    rng = np.random.default_rng(5)
    signs = list("aestmdrvlEÉßµªÿ÷×'''!.-<|12²¾ \t\n\r\xad")
    texts = ["".join(rng.choice(signs, rng.integers(0, 40))) for _ in range(3000)]
    texts += ["", "'", "'s", "''s", "it'sure", "we'll've 'L l'l 're've'd'", "x" * 200 + " " + "é" * 70, "abcdefgh abcdefghi",
              "a" * 16 + " " + "a" * 17 + " " + "a" * 15 + "é", "<|endoftext|> it's <|", "日本 it's", "\x00 a", "ĂĂ ăſ's", ""]
    encoder, want = t.Encoder(None), _ids(texts)
    assert _split(*encoder.encode_all(texts)) == want
    assert _split(*encoder.encode_all(texts[::-1])) == want[::-1]  # words that are known now
    assert _split(*encoder.encode_all(["日", "本"])) == _ids(["日", "本"])
    monkeypatch.setattr(t, "CACHED", 50)
    for a in range(0, 3000, 500):
        assert _split(*encoder.encode_all(texts[a:a + 500])) == want[a:a + 500]


@pytest.mark.parametrize("bits", [1, 4])
def test_words_that_share_a_slot(monkeypatch, bits):
    monkeypatch.setattr(t, "_SLOTS", bits)
    texts = ["one two three four five six " * 3, "a very-long-word-of-many-letters 12 one", "two two one"] * 4
    encoder = t.Encoder(None)
    for _ in range(2):
        assert _split(*encoder.encode_all(texts)) == _ids(texts)


def test_documents(spark, documents, odd_rows, monkeypatch):
    rows = [(i, x) for i, x in odd_rows if i is not None and i not in (9, 11)]
    folder = new_folder(spark, "shards")
    t.write_shards(documents(rows), folder)
    assert {"part", "block", "grammar"} <= set(spark.read.parquet(folder).columns)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in t.read_documents(spark, folder).collect()}
    library, start, every = load().library, 0, []
    for i, text in sorted(rows):
        ids = library.encode(text or "", add_special_tokens=False).ids + [t.END_ID]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), i
        start += len(ids)
        every += ids
    assert len(got) == len(rows)
    for a, n in ((0, 5), (start // 2, 300), (start - 2, 10)):
        assert t.decode_range(spark, folder, a, n).tolist() == every[a:a + n]


def test_repeated_and_null_keys(spark, documents, odd_rows):
    folder = new_folder(spark, "shards")
    t.write_shards(documents(odd_rows), folder)
    rows = sorted(t.read_documents(spark, folder).collect(), key=lambda r: r.start)
    assert len(rows) == len(odd_rows) and [r.doc_id for r in rows][:3] == [None] * 3
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:])) and rows[0].start == 0


def test_empty(spark, documents):
    folder = new_folder(spark, "shards")
    t.write_shards(documents([]), folder)
    assert t.read_documents(spark, folder).count() == 0
