"""Token ids in grammar-compressed shards (Re-Pair), with random access.

Texts are encoded with the tokenizers library, an end id closes each document,
and the ids are written in ascending order of a key.  Every block of about
BLOCK ids is compressed by itself: frequent pairs of neighbouring ids are
replaced by new symbols, again and again, and each new symbol's expansion
length is stored, so that any id can be found and decoded without the rest.

Stored form: a Parquet folder with one row per block, in order of (part,
block): the keys and lengths of its documents, ids before it in its part, and
``grammar``, little-endian bytes:

    b"RPG1", width of a symbol (2 or 4), base, rules, symbols, ids  (4s, 5 x u32)
    rules x 2 symbols (u32)         left and right of rule base + i
    rules x u32                     expansion lengths
    symbols x 2                     the compressed sequence, low halves
    symbols x 2                     high halves, if the width is 4

Defined results: a null text is empty and holds only the end id; an empty table
gives no rows; rows that tie on the key are ordered by a hash of their text;
null keys come first; a text longer than a block is one block, as large as its
ids; only the named columns of the input are read, whatever the others are called.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sirenlog.llm.bpe import _LETTER, _NUMBER, CACHED_LETTERS, Words, byte_letters, load
from sirenlog.llm.common import slices

END_ID = 1
BLOCK = 1 << 20          # ids of a block; a longer document is a block of its own
SLICE = 1 << 20          # bytes of texts that are encoded together
LEAST_COUNT = 16         # places of a pair that becomes a rule; with fewer, a rule is hardly shorter than its places
_HEAD = np.dtype([("magic", "S4"), ("width", "<u4"), ("base", "<u4"), ("rules", "<u4"), ("symbols", "<u4"), ("ids", "<u4")])


# --- Re-Pair ----------------------------------------------------------------


def _slots(pairs: np.ndarray) -> np.ndarray:
    """A 20-bit hash of each pair."""
    if pairs.dtype == np.uint32:
        return ((pairs * np.uint32(0x9E3779B1)) >> np.uint32(12)).view(np.int32)
    return ((pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int32)


def _frequent_pairs(pairs: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """The pairs (left symbol in the high half) that stand at LEAST_COUNT places or more, in order."""
    # Only pairs whose hash is frequent can be: sorting the others is saved.
    often = np.bincount(slot, minlength=1 << 20) >= LEAST_COUNT
    pairs = np.sort(pairs[often[slot]])
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
    return pairs[first[np.diff(np.append(first, len(pairs))) >= LEAST_COUNT]]


def compress(ids: np.ndarray, base: int) -> bytes:
    """The grammar of a sequence of ids below ``base``.

    A pass replaces all frequent pairs at once.  Where their places overlap the
    first one counts, and the others are gone with their shared symbol: after a
    pass only pairs with a new symbol can be frequent, so the next one counts
    the places beside new symbols and nothing else.  Passes end when no pair is
    frequent; a run of equal ids halves in each.
    """
    seq = np.asarray(ids, np.uint32)
    rules: list[np.ndarray] = []
    n_rules, new = 0, 0   # symbols from ``new`` on came with the last pass
    while len(seq) > 1:
        fresh = seq >= new
        where = np.flatnonzero(fresh[:-1] | fresh[1:])
        # Symbols of 16 bits make pairs of 32.
        kind, half = (np.uint32, 16) if base + n_rules <= 1 << 16 else (np.uint64, 32)
        pairs = seq[where].astype(kind) << kind(half) | seq[where + 1]
        slot = _slots(pairs)
        chosen = _frequent_pairs(pairs, slot)
        if not len(chosen):
            break
        # A table of the hashes first: most pairs are in none of the rules, and most others are the one of their hash.
        entry = np.full(1 << 20, -1, np.int32)
        entry[_slots(chosen)] = np.arange(len(chosen))
        rule = entry[slot]
        near = np.flatnonzero(rule >= 0)
        rule, near_pairs = rule[near], pairs[near]
        other = np.flatnonzero(chosen[rule] != near_pairs)
        rule[other] = np.minimum(np.searchsorted(chosen, near_pairs[other]), len(chosen) - 1)
        fits = chosen[rule] == near_pairs
        at, rule = where[near[fits]], rule[fits]
        # Of overlapping places in a row, every second one is replaced.
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1] + 1]))
        even = (np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))) & 1 == 0
        at, rule = at[even], rule[even]
        used = np.bincount(rule, minlength=len(chosen)) > 0  # a pair may have lost all its places
        new = base + n_rules
        seq = seq.copy()
        seq[at] = (new - 1 + np.cumsum(used))[rule]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, chosen = seq[keep], chosen[used]
        rules.append(np.stack([chosen >> kind(half), chosen & kind((1 << half) - 1)], 1).astype("<u4"))
        n_rules += len(chosen)
    table = np.concatenate(rules) if rules else np.zeros((0, 2), "<u4")
    width = 2 if base + n_rules <= 1 << 16 else 4
    head = np.array([(b"RPG1", width, base, n_rules, len(seq), len(ids))], _HEAD)
    halves = seq.astype("<u4").view("<u2").reshape(-1, 2).T[:width // 2]
    return b"".join([head.tobytes(), table.tobytes(), _lengths(table, base).astype("<u4").tobytes(), halves.tobytes()])


def _lengths(table: np.ndarray, base: int) -> np.ndarray:
    """Expansion lengths; a rule's parts are ids or earlier rules."""
    length = np.zeros(len(table), np.int64)
    todo = np.arange(len(table))
    while len(todo):
        part = table[todo].astype(np.int64) - base
        of = np.where(part < 0, 1, length[np.maximum(part, 0)])
        done = (of > 0).all(1)
        length[todo[done]] = of[done].sum(1)
        todo = todo[~done]
    return length


class Grammar:
    """A stored block, decoded wholly or in part."""

    def __init__(self, stored: bytes):
        head = np.frombuffer(stored, _HEAD, 1)[0]
        if head["magic"] != b"RPG1":
            raise ValueError("not a grammar block")
        at, n = _HEAD.itemsize, int(head["rules"])
        self.base, self.ids = int(head["base"]), int(head["ids"])
        self.table = np.frombuffer(stored, "<u4", 2 * n, at).reshape(n, 2)
        self.lengths = np.frombuffer(stored, "<u4", n, at + 8 * n).astype(np.int64)
        halves = int(head["width"]) // 2
        halves = np.frombuffer(stored, "<u2", int(head["symbols"]) * halves, at + 12 * n).reshape(halves, -1)
        self.sequence = halves[0].astype(np.uint32)
        if len(halves) > 1:
            self.sequence |= halves[1].astype(np.uint32) << np.uint32(16)
        self._starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self._pool = self._expand_rules()
        self._ends: np.ndarray | None = None

    def _expand_rules(self) -> np.ndarray:
        """The expansions of all rules, one after the other."""
        pool = np.zeros(int(self._starts[-1]), np.uint32)
        todo = np.arange(len(self.table))
        done_before = np.zeros(len(self.table), bool)
        while len(todo):
            part = self.table[todo].astype(np.int64) - self.base
            ready = ((part < 0) | done_before[np.maximum(part, 0)]).all(1)
            now = todo[ready]
            for side in (0, 1):
                symbols = self.table[now, side]
                offset = self._starts[now] if side == 0 else self._starts[now] + self._width(self.table[now, 0])
                self._scatter(pool, symbols, offset, pool)
            done_before[now] = True
            todo = todo[~ready]
        return pool

    def _width(self, symbols: np.ndarray) -> np.ndarray:
        rule = symbols.astype(np.int64) - self.base
        return np.where(rule < 0, 1, self.lengths[np.maximum(rule, 0)]) if len(self.lengths) else np.ones(len(symbols), np.int64)

    def _scatter(self, target: np.ndarray, symbols: np.ndarray, offset: np.ndarray, pool: np.ndarray) -> None:
        """Write the expansion of each symbol at its offset."""
        rule = symbols.astype(np.int64) - self.base
        plain = rule < 0
        target[offset[plain]] = symbols[plain]
        rule, offset = rule[~plain], offset[~plain]
        if len(rule):
            width = self.lengths[rule]
            within = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
            target[np.repeat(offset, width) + within] = pool[np.repeat(self._starts[rule], width) + within]

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        width = self._width(symbols)
        out = np.zeros(int(width.sum()), np.uint32)
        self._scatter(out, symbols, np.cumsum(width) - width, self._pool)
        return out

    def all(self) -> np.ndarray:
        return self._expand(self.sequence)

    def range(self, start: int, count: int) -> np.ndarray:
        """The ids start .. start + count, from the symbols that cover them only."""
        if self._ends is None:
            self._ends = np.cumsum(self._width(self.sequence))
        start = min(max(start, 0), self.ids)
        stop = min(start + max(count, 0), self.ids)
        if stop == start:
            return np.zeros(0, np.uint32)
        first = int(np.searchsorted(self._ends, start, "right"))
        last = int(np.searchsorted(self._ends, stop, "left"))
        before = int(self._ends[first - 1]) if first else 0
        return self._expand(self.sequence[first:last + 1])[start - before:stop - before]


# --- encoding, writing, reading ----------------------------------------------


CACHED = 1 << 20         # words that an encoder knows before it starts anew
_SLOTS = 20              # bits of a slot of the table of words
_LATIN = re.compile("[\t\n\r -~\xa1-\xff]*")
# Of each byte of a lower-case Latin-1 text: 0 blank, 1 letter, 2 number, 3 other, 4 the end of a document.
_CLASS = np.array([next(k for k, kind in enumerate((r"\s", f"[{_LETTER}]", f"[{_NUMBER}]", "(?s:.)"))
                        if re.fullmatch(kind, chr(i))) for i in range(256)], np.uint8)
_CLASS[0] = 4


def _word_limits(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word (as the splitter gives them) and of every closing zero byte.

    A word is a run of one class, a number a single character, and an
    apostrophe that starts a word takes one of the endings s t m d re ve ll.
    """
    kind = _CLASS[data]
    begin = np.ones(len(kind), bool)
    np.not_equal(kind[1:], kind[:-1], out=begin[1:])
    begin |= (kind == 2) | (kind == 4)
    begin &= kind != 0
    mark = np.flatnonzero(data == ord("'"))
    mark = mark[begin[mark]]
    mark = mark[kind[mark + 1] == 1]   # the last byte is a zero
    one, two = data[mark + 1], data[np.minimum(mark + 2, len(data) - 1)]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = (np.isin(one, np.frombuffer(b"rv", np.uint8)) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    begin[mark[short | long] + 1] = False
    rest = np.concatenate([mark[short] + 2, mark[long] + 3])
    begin[rest] |= kind[rest] == 1
    last = kind != 0
    last[:-1] &= begin[1:] | (kind[1:] == 0)
    return np.flatnonzero(begin), np.flatnonzero(last) + 1


class Encoder:
    """Ids as the library gives them; words of plain texts are encoded once each.

    Words of Latin-1 texts are found for many texts at once.  A table with a
    slot for each hash has the first 16 bytes of a known word, so that words of
    up to 16 letters are compared whole; all others are looked up one by one.
    """

    def __init__(self, path: str | None):
        self.bpe = load(path)
        self.known = Words(self._word)
        # A word is split and normalised already, so it goes to the library's model as its byte letters.
        self.model = self.bpe.library.model
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.id_bytes = [i.to_bytes(4, "little") for i in range(max(self.bpe.token_text, default=0) + 1)]
        self._start_anew()

    def _start_anew(self) -> None:
        self.number: dict[bytes, int] = {}              # of each known word
        self.table = np.zeros((1 << _SLOTS, 2), np.uint64)
        self.at = np.full(1 << _SLOTS, -1, np.int32)    # number of the word in a slot
        self.first = np.zeros(1, np.int64)              # where a word's ids start; one more at the end
        self.ids = np.zeros(0, "<u4")
        self._add([np.array([END_ID], "<u4").tobytes()])
        self.number[b"\0"] = 0

    def _add(self, words: list[bytes]) -> None:
        ends = self.first[-1] + np.cumsum([len(x) // 4 for x in words])
        self.first = np.concatenate([self.first, ends])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(words), "<u4")])

    def _word(self, word: str) -> bytes:
        if not word.isascii():  # signs of ASCII are their own letters
            word = word.encode("utf-8").decode("latin-1").translate(self.letters)
        ids = self.id_bytes
        return b"".join([ids[token.id] for token in self.model.tokenize(word)])

    def encode(self, text: str) -> bytes:
        words = self.bpe.plain_words(text)
        if words is None:
            return np.array(self.bpe.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.known.__getitem__, words))

    def _numbers(self, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word."""
        size = ends - starts
        eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
        whole = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
        low = eight[starts] & whole[np.minimum(size, 8)]
        high = np.zeros(len(low), np.uint64)
        more = np.flatnonzero(size > 8)
        high[more] = eight[starts[more] + 8] & whole[np.minimum(size[more] - 8, 8)]
        slot = low * np.uint64(0x9E3779B97F4A7C15) + high * np.uint64(0xBF58476D1CE4E5B9)
        slot ^= slot >> np.uint64(32)
        slot *= np.uint64(0x94D049BB133111EB)
        slot = (slot >> np.uint64(64 - _SLOTS)).astype(np.int64)
        number = self.at[slot]
        met = self.table[slot]
        number[(met[:, 0] != low) | (met[:, 1] != high) | (size > 16)] = -1
        unmet = np.flatnonzero(number < 0)
        found, added, known = [], [], self.number
        last = len(self.first) - 1
        for a, b in zip(starts[unmet].tolist(), ends[unmet].tolist()):
            word = raw[a:b]
            n = known.get(word)
            if n is None:
                n = last + len(added)
                added.append(self._word(word.decode("latin-1")))
                if b - a <= CACHED_LETTERS:
                    known[word] = n
            found.append(n)
        if added:
            self._add(added)
        number[unmet] = found
        unmet = unmet[size[unmet] <= 16]
        slot = slot[unmet]
        self.at[slot] = number[unmet]
        # Of several words of a slot the last one is written; all columns take the same one.
        self.table[slot] = np.stack([low[unmet], high[unmet]], 1)
        return number

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, an end id after each, and how many each text has."""
        if len(self.first) > CACHED or len(self.ids) > 8 * CACHED:
            self._start_anew()
        plain = [bool(_LATIN.fullmatch(x)) and not ("<|" in x and self.bpe.plain_words(x) is None) for x in texts]
        raw = b"\0".join([x.lower().encode("latin-1") for x, p in zip(texts, plain) if p]) + bytes(1)
        data = np.frombuffer(raw, np.uint8)
        starts, ends = _word_limits(data if any(plain) else data[:0])
        number = self._numbers(raw + bytes(16), starts, ends)
        count = np.diff(self.first)[number]
        total = np.cumsum(count)
        ids = self.ids[np.repeat(self.first[number] - total + count, count) + np.arange(total[-1] if len(total) else 0)]
        lengths = np.diff(total[data[starts] == 0], prepend=0)
        if all(plain):
            return ids, lengths
        parts, sizes, at = [], [], iter(np.split(ids, np.cumsum(lengths)[:-1]))
        for text, p in zip(texts, plain):
            parts.append(next(at) if p else np.frombuffer(self.encode(text) + np.array([END_ID], "<u4").tobytes(), "<u4"))
            sizes.append(len(parts[-1]))
        return np.concatenate(parts), np.array(sizes, np.int64)


_ENCODERS: dict[str | None, Encoder] = {}


def write_shards(documents: DataFrame, folder: str, text: str = "text", key: str = "doc_id",
                 path: str | None = None) -> None:
    """Encode, order by the key, compress and write."""
    spark = documents.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = documents.select(F.col(key).alias("_key"), F.coalesce(text, F.lit("")).alias("__text")).withColumn(
        "_tie", F.xxhash64("__text"))
    ordered = source.repartitionByRange(n, "_key", "_tie").sortWithinPartitions("_key", "_tie")
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()),
        T.StructField("before", T.LongType()), T.StructField("n_ids", T.LongType()),
        T.StructField("keys", T.ArrayType(source.schema["_key"].dataType)),
        T.StructField("lengths", T.ArrayType(T.IntegerType())), T.StructField("grammar", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        encode, base = _ENCODERS[path].encode_all, max(_ENCODERS[path].bpe.token_text, default=END_ID) + 1
        part = TaskContext.get().partitionId()
        block = before = held = 0
        keys: list[pa.Array] = []
        ids: list[np.ndarray] = []

        def closed() -> pa.RecordBatch:
            every = np.concatenate(ids)
            row = [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()),
                   pa.array([len(every)], pa.int64()),
                   pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays(keys)),
                   pa.array([[len(x) for x in ids]], pa.list_(pa.int32())),
                   pa.array([compress(every, base)], pa.binary())]
            return pa.RecordBatch.from_arrays(row, schema.names)

        for batch in slices(batches, "__text", SLICE):
            every, lengths = encode(batch.column("__text").to_pylist())
            for i, coded in enumerate(np.split(every, np.cumsum(lengths)[:-1])):
                if held and held + len(coded) > BLOCK:
                    yield closed()
                    block, before, held, keys, ids = block + 1, before + held, 0, [], []
                keys.append(batch.column("_key").slice(i, 1))
                ids.append(coded)
                held += len(coded)
        if held:
            yield closed()

    ordered.mapInArrow(run, schema).write.parquet(folder)


def _bases(stored: DataFrame) -> DataFrame:
    """(``part``, ``base``), how many ids all earlier parts hold; one row a part."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return stored.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))


def read_documents(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """``key``, ``start``, ``n_tokens`` and ``ids_crc32`` of each document, from the stored blocks."""
    stored = spark.read.parquet(folder)
    bases = _bases(stored).withColumnRenamed("part", "_part")
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField(key, stored.schema["keys"].dataType.elementType),
        T.StructField("offset", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = Grammar(batch.column("grammar")[i].as_py()).all().astype("<u4")
                lengths = batch.column("lengths")[i].values.to_numpy()
                ends = np.cumsum(lengths)
                sums = [zlib.crc32(ids[b - n:b]) for b, n in zip(ends.tolist(), lengths.tolist())]
                before = batch.column("before")[i].as_py()
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(ends), batch.column("part")[i].as_py()), pa.int32()),
                    batch.column("keys")[i].values, pa.array(before + ends - lengths, pa.int64()),
                    pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())], schema.names)

    found = stored.select("part", "before", "keys", "lengths", "grammar").mapInArrow(run, schema)
    return found.join(bases, found["part"] == bases["_part"]).select(
        key, (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def decode_range(spark: SparkSession, folder: str, start: int, count: int) -> np.ndarray:
    """Ids start .. start + count of the whole store, from the blocks that hold them only."""
    stored = spark.read.parquet(folder)
    at = stored.join(_bases(stored), "part").select(
        "part", "block", (F.col("base") + F.col("before")).alias("first"), "n_ids").filter(
        (F.col("first") < start + count) & (F.col("first") + F.col("n_ids") > start))
    rows = stored.select("part", "block", "grammar").join(at, ["part", "block"]).orderBy("first").collect()
    parts = [Grammar(bytes(r["grammar"])).range(max(0, start - r["first"]), start + count - max(start, r["first"]))
             for r in rows]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
