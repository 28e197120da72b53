import hashlib
import random

import pytest

from sirenlog.llm import bpe


@pytest.fixture(scope="module")
def coder():
    return bpe.load()


TEXTS = [
    "", "Hello wörld's <|endoftext|> 12 x²!? İstanbul ΣΑΣ \u0085a", "a" * 3000, "!!!!!!" * 50,
    "don't we'll ÉÀ ſ ŉ µ ªº ¼½ ÷× \xad\xa0 \x1c\x00   日本語 नमस्ते é ﬁ K Å \U0001F389 <|startoftext|><|endoftext|>< |",
    "İİ I'LL 'S", "퟿\U0001F600‍", " \t\n", "'''s 's's", "<|ENDOFTEXT|> <|endoftext|",
]


@pytest.mark.parametrize("text", TEXTS)
def test_equals_the_library(coder, text):
    known = coder.library.encode(text, add_special_tokens=False)
    assert coder.encode(text) == known.ids
    assert coder.decode(known.ids) == coder.library.decode(known.ids, skip_special_tokens=False)


def test_random_words_equal_the_library(coder):
    rng = random.Random(5)
    parts = [t.removesuffix("</w>") for t in coder.token_text.values()]
    for n in range(3000):
        word = "".join(rng.choice("abcdefghinorst'1!é") for _ in range(rng.randint(1, 15)))
        if n % 2:
            word = "".join(rng.choice(parts) for _ in range(3))
        assert coder.encode(word) == coder.library.encode(word, add_special_tokens=False).ids, word


def test_exactly_one_token_may_end_each_prefix(coder):
    """The pair test leaves one last token for every prefix, whatever order candidates come in."""
    rng = random.Random(6)
    for _ in range(300):
        symbols = bpe._symbols("".join(rng.choice("abcdehinorst") for _ in range(12)).encode(), True)
        last = {}
        for end, (width, token) in coder.automaton.iter(symbols):
            before = last.get(end - width)
            if width > end or before is not None and coder.may_follow(before, token):
                assert end not in last
                last[end] = token
        assert set(last) == set(range(len(symbols)))


def test_documents(spark, documents, odd_rows, coder):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(TEXTS)]
    docs = documents(rows).selectExpr("*", "'x' AS n_tokens")
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_digests(docs).collect())
    want = []
    for i, text in rows:
        ids = coder.library.encode(text or "", add_special_tokens=False).ids
        decoded = coder.library.decode(ids, skip_special_tokens=False)
        want.append((str(i), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.encode_digests(documents([])).count() == 0


def test_generations_of_words(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    asked = []
    words = bpe.Words(lambda w: asked.append(w) or w.upper())
    assert [words[w] for w in "abcadeabf"] == list("ABCADEABF") and len(words) <= 3 and asked.count("a") == 1
