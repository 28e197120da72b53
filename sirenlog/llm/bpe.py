"""BPE encoding by dynamic programming over prefixes, and decoding.

A word is a string of symbols (bytes, the last one marked as the word's end).
An automaton of all tokens gives, for each prefix, the tokens that it ends
with.  Exactly one of them is the last token of the prefix's encoding: the one
that may follow the last token of what stands before it.  Whether token b may
follow token a is a property of the pair: no merge across their border may
come before both are complete.  The last tokens are stored per prefix; walking
back over them gives the ids.

Words come from texts as the tokenizer's own normaliser and splitter give them.
Texts of plain Latin letters, digits and signs take a short way with the same
result (one regular expression); all others go through the library's objects.

Defined results: a null text is empty; an empty text has no ids; a special
token's string in a text is that token.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

VOCABULARY = "word_bpe_49k.json"
NEVER = 1 << 40
CACHED_WORDS = 500_000   # in each of two generations
CACHED_LETTERS = 64      # longer words are computed anew, so that the caches have a bound in bytes
CACHED_PAIRS = 1_000_000
# Where lower-casing, white space and classes are the same in every Unicode library.
_PLAIN = re.compile("[\t\n\r -~\xa1-įı-ſ]*")
_LETTER, _NUMBER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-ſ", "0-9\xb2\xb3\xb9\xbc-\xbe"
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\\s{_LETTER}{_NUMBER}]+")
_LOADED: dict[str, "WordBpe"] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def load(path: str | None = None) -> "WordBpe":
    """The encoder of a vocabulary file, once per process; None is the installed public file."""
    key = path or ""
    if key not in _LOADED:
        _LOADED[key] = WordBpe(path or default_path())
    return _LOADED[key]


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte, and its byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Words(dict):
    """Word to value, computed when missing; the older of two generations is dropped when one is full."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.older = compute, {}

    def __missing__(self, word: str):
        value = self.older.get(word)
        if value is None:
            value = self.compute(word)
        if len(word) > CACHED_LETTERS:
            return value
        if len(self) >= CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = value
        return value


class WordBpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.token_text = {i: t for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.token_text |= {i: t for t, i in self.special.items()}
        self._special = re.compile("|".join(map(re.escape, self.special)) or "(?!)")
        letters = byte_letters()
        vocab = model["vocab"]
        self.pair_rank: dict[int, int] = {}
        parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            if whole in parts:
                raise ValueError("a token with two merges cannot be tested by pairs")
            parts[whole], self.rank[whole], self.pair_rank[a << 20 | b] = (a, b), rank, rank
        # The pieces that stand at a token's right and left end while it is built.
        self.right: dict[int, list[int]] = {}
        self.left: dict[int, list[int]] = {}
        self._pairs: dict[int, bool] = {}
        whole_tokens, self.width = [], {}
        for token, i in sorted(vocab.items(), key=lambda x: self.rank.get(x[1], -1)):
            a, b = parts.get(i, (None, None))
            if a is None:
                self.right[i] = self.left[i] = [i]
                own = True
            else:
                if max(self.rank.get(a, -1), self.rank.get(b, -1)) >= self.rank[i]:
                    raise ValueError("a merge comes before those of its parts")
                self.right[i], self.left[i] = [*self.right[b], i], [*self.left[a], i]
                own = a in self.width and b in self.width and self._free(a, b, joining=True)
            if own:  # else no text is ever encoded with this token
                closed = bool(self.suffix) and token.endswith(self.suffix)
                body = [letters[c] for c in (token[:-len(self.suffix)] if closed else token)]
                whole_tokens.append((_symbols(bytes(body), closed), i))
                self.width[i] = len(body)
        self.automaton = ahocorasick.Automaton()
        for symbols, i in whole_tokens:
            self.automaton.add_word(symbols, (len(symbols), i))
        self.automaton.make_automaton()

    def _free(self, a: int, b: int, joining: bool = False) -> bool:
        """Whether a and b, built side by side, are both completed before any merge across their border."""
        rights, lefts, rank = self.right[a], self.left[b], self.rank
        i = j = 0
        while True:
            grow_a = rank[rights[i + 1]] if i + 1 < len(rights) else NEVER
            grow_b = rank[lefts[j + 1]] if j + 1 < len(lefts) else NEVER
            if joining and grow_a == grow_b == NEVER:
                return True
            across = self.pair_rank.get(rights[i] << 20 | lefts[j], NEVER)
            # Of equal ranks the leftmost merge comes first.
            if across < grow_a and across <= grow_b:
                return False
            if grow_a == grow_b == NEVER:
                return True
            if grow_a <= grow_b:
                i += 1
            else:
                j += 1

    def may_follow(self, a: int, b: int) -> bool:
        key = a << 20 | b
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= CACHED_PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self._free(a, b)
        return known

    def encode_word(self, word: str) -> list[int]:
        """The ids of one word (of the splitter)."""
        symbols = _symbols(word.encode("utf-8"), bool(self.suffix))
        last: list[tuple[int, int] | None] = [None] * len(symbols)
        for end, match in self.automaton.iter(symbols):
            if last[end] is None:
                width, token = match
                if width > end:
                    last[end] = match
                else:
                    before = last[end - width]
                    if before is not None and self.may_follow(before[1], token):
                        last[end] = match
        ids, at = [], len(symbols) - 1
        while at >= 0:
            width, token = last[at]
            ids.append(token)
            at -= width
        return ids[::-1]

    def pieces(self, text: str) -> Iterator[tuple[bool, list[str]]]:
        """Runs of words, and special tokens as (True, [token])."""
        at = 0
        if "<" in text:
            for found in self._special.finditer(text):
                yield False, self.words(text[at:found.start()])
                yield True, [found.group()]
                at = found.end()
        yield False, self.words(text[at:] if at else text)

    def words(self, text: str) -> list[str]:
        """What the tokenizer's normaliser and splitter make of a text without special tokens."""
        plain = self.plain_words(text)
        if plain is not None:
            return plain
        clean = self.library.normalizer.normalize_str(text)
        letters = byte_letters()
        return [bytes(letters[c] for c in piece).decode("utf-8", "surrogateescape")
                for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(clean)]

    def plain_words(self, text: str) -> list[str] | None:
        """The words of a text that takes the short way, else None."""
        if not _PLAIN.fullmatch(text) or "<|" in text and self._special.search(text):
            return None
        return _WORDS.findall(text.lower())

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for special, words in self.pieces(text):
            for word in words:
                ids.extend([self.special[word]] if special else self.encode_word(word))
        return ids

    def decode(self, ids: list[int]) -> str:
        """As a tokenizer without a decoder does: the tokens' strings, joined by spaces."""
        return " ".join([self.token_text[i] for i in ids if i in self.token_text])


def _symbols(data: bytes, closed: bool) -> str:
    """Letters U+0100.. stand for bytes, U+0200.. for the last byte of a word."""
    text = data.decode("latin-1")
    text = text.translate(_SHIFT)
    return text[:-1] + chr(ord(text[-1]) + 0x100) if closed and text else text


_SHIFT = {b: b + 0x100 for b in range(256)}


def encode_digests(documents: DataFrame, text: str = "text", keep: list[str] | None = None,
                   path: str | None = None) -> DataFrame:
    """Per row: ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of the ids and of what they decode to."""
    import hashlib

    added = ["n_tokens", "ids_sha256", "decoded_sha256"]
    names = [c for c in (documents.columns if keep is None else keep) if c not in added]
    source = documents.select(*names, documents[text].alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)

        def told(ids: list[int]) -> tuple[int, bytes, bytes]:
            return len(ids), " ".join(map(str, ids)).encode(), bpe.decode(ids).encode("utf-8")

        known = _CACHES.setdefault((path, "digests"), Words(lambda word: told(bpe.encode_word(word))))
        for batch in batches:
            rows: list[tuple[int, str, str]] = []
            for value in batch.column("__text"):
                parts: list[tuple[int, bytes, bytes]] = []
                for special, words in bpe.pieces(value.as_py() or ""):
                    parts.extend([told([bpe.special[words[0]]])] if special else map(known.__getitem__, words))
                n, ids, decoded = zip(*parts) if parts else ((), (), ())
                rows.append((sum(n), hashlib.sha256(b" ".join(ids)).hexdigest(),
                             hashlib.sha256(b" ".join(decoded)).hexdigest()))
            columns = list(zip(*rows)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names]
                + [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())],
                [*names, *added])

    return source.mapInArrow(run, T.StructType([source.schema[n] for n in names] + [
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType())]))


_CACHES: dict[tuple, Words] = {}
