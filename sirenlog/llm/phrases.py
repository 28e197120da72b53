"""Phrase collocations: counted windows of words, kept by task in a burst trie and merged by prefix.

First pass: every word of every language is counted, and so are hashed prefixes
of the windows (up to five words from each position of a piece).  Words below
the least count cannot stand in a counted phrase, so windows end before them.

Second pass: each task counts its windows in a trie.  Its upper levels branch by
word id; below hang hash containers of window remainders, which burst into a
level more when they grow past ``BURST``.  When the trie is full, whole subtrees,
largest first, leave it as sorted runs.  A run's rows go to the partition of
their prefix: the first word, or two to five words where the shorter prefix
holds more than 1/``SHARE`` of all windows.  Each partition is one sorted stream,
from which the counts of all prefixes are read off as they end.  Prefixes
shorter than their partition's are partial sums and are added up afterwards.

Ids: the ``KNOWN`` most frequent words travel as small numbers in a table sent
to all tasks; any others as 63-bit hashes of language and word, which are
checked to be distinct over all words and drawn anew if they are not.  Counts
are exact in both forms.

Memory is bounded by ``KNOWN``, the trie's ``ENTRIES`` and the longest text;
shuffled rows are at most one a word.

Defined results: null languages are ``und``; null and empty texts have no
words; repeated rows count each; ties rank by count and then by the phrase's
bytes; empty tables give no rows; only the named columns of the input are read,
whatever the others are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sirenlog.llm import words as w
from sirenlog.llm.common import materialize, slices, text_bytes

LONGEST = 5                # words of a phrase
KNOWN = 1 << 19            # words that travel as small numbers
ENTRIES, BURST = 300_000, 4_096
LEVELS, LOADS = LONGEST - 1, 1 << 14   # hashed loads of prefixes, per prefix length
SHARE = 1024
SLICE = 1 << 22
_MASK = (1 << 63) - 1
_WORD, _BLANK, _CUT = 0, 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = _BLANK
_CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = _CUT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


@dataclass
class Block:
    """The words of a block of texts: which distinct word stands at each position, and where pieces end."""

    langs: list[str]         # of each distinct word
    words: pa.Array          # of each distinct word
    at: np.ndarray           # distinct word of each position
    joined: np.ndarray       # whether a position and the next lie in one piece


def read_block(texts: pa.Array, langs: pa.Array) -> Block:
    data, bounds = text_bytes(texts)
    kind = _CLASS[data]
    inside = kind == _WORD
    start, end, before = w.runs(inside, bounds)
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    spelled = pa.Array.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[data[inside]])])
    coded, names = spelled.dictionary_encode(), langs.fill_null("und").dictionary_encode()
    text_of = np.repeat(np.arange(len(texts)), np.diff(before))
    n = max(1, len(coded.dictionary))
    both = names.indices.to_numpy()[text_of].astype(np.int64) * n + coded.indices.to_numpy()
    pairs, at = np.unique(both, return_inverse=True)
    cuts = np.cumsum(kind == _CUT, dtype=np.int32)[start] if len(start) else np.zeros(0, np.int32)
    joined = np.zeros(len(start), bool)
    joined[:-1] = (cuts[1:] == cuts[:-1]) & (text_of[1:] == text_of[:-1])
    known = names.dictionary.to_pylist()
    return Block([known[i] for i in (pairs // n).tolist()], coded.dictionary.take(pa.array(pairs % n)), at, joined)


def codes(langs: list[str], spelled: list[bytes], salt: int) -> np.ndarray:
    """63-bit hashes of (language, word)."""
    heads = {lang: lang.encode() + b"\0%d\0" % salt for lang in set(langs)}
    return np.array([xxhash.xxh64_intdigest(heads[x] + y, 42) & _MASK for x, y in zip(langs, spelled)], np.int64)


def code_column(salt: int) -> Column:
    """The same over the columns ``lang`` and ``word``."""
    head = F.concat(F.encode("lang", "UTF-8"), F.lit(b"\0%d\0" % salt))
    return F.xxhash64(F.concat(head, "word")).bitwiseAND(F.lit(_MASK))


def prefix_hashes(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Hashes of the first one, two and so on of the given columns of codes."""
    found, h = [], np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        h = w.mix(h * w.BASE + column.astype(np.uint64) + np.uint64(1))
        found.append(h)
    return found


def _load_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(LOADS)).astype(np.int64)


def windows(at: np.ndarray, joined: np.ndarray, length: int) -> list[np.ndarray]:
    """Columns of ``at`` + 1 from every position that a joined one follows, 0 past the end of its piece."""
    start = np.flatnonzero(joined)
    padded, more = np.concatenate([at + 1, np.zeros(length, np.int64)]), np.concatenate([joined, np.zeros(length, bool)])
    columns, open_ = [padded[start], padded[start + 1]], np.ones(len(start), bool)
    for k in range(2, length):
        open_ = open_ & more[start + k - 1]
        columns.append(np.where(open_, padded[start + k], 0))
    return columns


_COUNTED = "lang string, word binary, level int, load int, n bigint"


def count_words(documents: DataFrame, salt: int) -> DataFrame:
    """Occurrences of every (``lang``, ``word``), and of the hashed prefixes of each ``level``; stored.

    ``documents`` has the columns ``text`` and ``lang``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads = np.zeros((LEVELS, LOADS), np.int64)
        for part in slices(batches, "text", SLICE):
            block = read_block(part.column("text"), part.column("lang"))
            n = np.bincount(block.at, minlength=len(block.words))
            none = pa.array([0] * len(n), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.langs, pa.string()), block.words.cast(pa.binary()), none, none, pa.array(n)],
                ["lang", "word", "level", "load", "n"])
            code = np.concatenate([[0], codes(block.langs, block.words.to_pylist(), salt)])
            for level, h in enumerate(prefix_hashes([code[c] for c in windows(block.at, block.joined, LEVELS)])):
                loads[level] += np.bincount(_load_of(h), minlength=LOADS)
        level, load = np.nonzero(loads)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(level), pa.string()), pa.nulls(len(level), pa.binary()), pa.array((level + 1).astype(np.int32)),
             pa.array(load.astype(np.int32)), pa.array(loads[level, load])], ["lang", "word", "level", "load", "n"])

    counted = documents.mapInArrow(run, _COUNTED).groupBy("lang", "word", "level", "load").agg(F.sum("n").alias("n"))
    return materialize(counted, "word-counts")


class Trie:
    """Counts of windows: inner nodes by word id, hash containers of the remaining ids below.

    The root branches by the first id; a subtree is one container of the other
    four ids (as bytes, eight to an id) or, burst, an inner node of containers.
    """

    def __init__(self, burst: int):
        self.burst, self.entries = burst, 0
        self.root: dict[int, dict[bytes, int]] = {}                  # one container
        self.inner: dict[int, dict[bytes, dict[bytes, int]]] = {}    # by the second id

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        """Windows whose equal first ids stand together."""
        first = np.flatnonzero(np.diff(ids[:, 0], prepend=ids[0, 0] - 1))
        rests = np.ascontiguousarray(ids[:, 1:]).view("V32").ravel().tolist()
        counts = counts.tolist()
        for head, a, b in zip(ids[first, 0].tolist(), first.tolist(), [*first[1:].tolist(), len(ids)]):
            if head in self.inner:
                node = self.inner[head]
                for key, n in zip(rests[a:b], counts[a:b]):
                    child = node.setdefault(key[:8], {})
                    self.entries -= len(child)
                    child[key[8:]] = child.get(key[8:], 0) + n
                    self.entries += len(child)
                continue
            node = self.root.setdefault(head, {})
            before = len(node)
            if before:
                for key, n in zip(rests[a:b], counts[a:b]):
                    node[key] = node.get(key, 0) + n
            else:
                node.update(zip(rests[a:b], counts[a:b]))
            self.entries += len(node) - before
            if len(node) > self.burst:
                inner = self.inner[head] = {}
                for key, n in self.root.pop(head).items():
                    inner.setdefault(key[:8], {})[key[8:]] = n

    def spill(self, left: int) -> tuple[np.ndarray, np.ndarray]:
        """Takes out the largest subtrees, each as one sorted run, until at most ``left`` entries stay: ids and counts."""
        sizes = {head: len(node) for head, node in self.root.items()}
        sizes |= {head: sum(map(len, node.values())) for head, node in self.inner.items()}
        heads, keys, counts = [], [], []
        for head in sorted(sizes, key=sizes.get, reverse=True):
            if self.entries <= left:
                break
            self.entries -= sizes[head]
            heads.append(head)
            if head in self.root:
                run = sorted(self.root.pop(head).items())
            else:
                run = sorted((a + b, n) for a, child in self.inner.pop(head).items() for b, n in child.items())
            keys += [key for key, _ in run]
            counts += [n for _, n in run]
        first = np.repeat(np.array(heads, np.int64), [sizes[head] for head in heads])
        rests = np.frombuffer(b"".join(keys), np.int64).reshape(-1, LONGEST - 1)
        return np.concatenate([first[:, None], rests], axis=1), np.array(counts, np.int64)


@dataclass
class Vocabulary:
    """The frequent words that tasks know by number, and which prefixes hold too many windows."""

    words: dict[str, tuple[pa.Array, np.ndarray]]   # per language: words and their ids
    code_of: np.ndarray                             # per id
    complete: bool                                  # no other word is frequent
    crowded: np.ndarray                             # per level and load
    salt: int

    def ids(self, block: Block) -> np.ndarray:
        """Id of each distinct word of a block; 0 for one that is known to be rare."""
        ids, lang_of = np.zeros(len(block.words), np.int64), np.array(block.langs)
        for lang in set(block.langs):
            mine = np.flatnonzero(lang_of == lang)
            if lang in self.words:
                spelled, numbers = self.words[lang]
                place = pc.index_in(block.words.take(pa.array(mine)), spelled).fill_null(-1).to_numpy()
                ids[mine] = np.where(place >= 0, numbers[place], 0)
        if not self.complete:
            other = np.flatnonzero(ids == 0)
            ids[other] = -1 - codes(
                [block.langs[i] for i in other.tolist()], block.words.take(pa.array(other)).to_pylist(), self.salt)
        return ids

    @property
    def width(self) -> int:
        """Bytes of an id in a run's keys."""
        return 3 if self.complete else 8

    def depths(self, rows: np.ndarray) -> np.ndarray:
        """The length of the prefix that decides the partition of each row of ids."""
        code = np.where(rows >= 0, self.code_of[np.maximum(rows, 0)], -1 - rows)
        depth, crowded = np.ones(len(rows), np.int64), np.ones(len(rows), bool)
        for level, hashes in enumerate(prefix_hashes(list(code.T[:LEVELS]))):
            crowded = crowded & self.crowded[level][_load_of(hashes)]
            depth = depth + crowded
        return depth


def as_keys(rows: np.ndarray, width: int) -> pa.Array:
    """Rows of ids (0 past the end) as bytes, ``width`` to an id, which sort by prefixes."""
    parts = np.ascontiguousarray(rows).astype(">i8").view(np.uint8).reshape(len(rows), LONGEST, 8)[:, :, 8 - width:]
    used = rows != 0
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum(used.sum(1) * width, out=offsets[1:])
    return pa.Array.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(parts[used]))])


def from_keys(keys: pa.Array, width: int) -> np.ndarray:
    """The rows of ids again."""
    data, bounds = text_bytes(keys)
    parts = np.zeros((len(data) // width, 8), np.uint8)
    parts[:, 8 - width:] = data.reshape(-1, width)
    rows = np.zeros((len(keys), LONGEST), np.int64)
    rows[np.arange(LONGEST) < (np.diff(bounds) // width)[:, None]] = parts.view(">i8").ravel()
    return rows


def distinct_windows(columns: list[np.ndarray], n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Different rows of the columns (numbers up to ``n_words``), and how often each stands there."""
    bits = n_words.bit_length()
    if 3 * bits <= 63:
        keys = [(columns[0] << 2 * bits) | (columns[1] << bits) | columns[2], (columns[3] << bits) | columns[4]]
    else:
        keys = columns
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
    first = np.flatnonzero(new)
    return np.stack([c[order[first]] for c in columns], axis=1), np.diff(np.append(first, len(order)))


_RUNS = "key binary, n bigint"   # n is 8 times the count and the depth
_IDS = [f"w{i + 1}" for i in range(LONGEST)]


def window_runs(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Sorted runs of counted windows of at least two frequent words, as the tasks' tries spill them."""
    def spilled(trie: Trie, left: int) -> Iterator[pa.RecordBatch]:
        ids, n = trie.spill(left)
        yield pa.RecordBatch.from_arrays(
            [as_keys(ids, vocabulary.width), pa.array(8 * n + vocabulary.depths(ids))], ["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(BURST)
        for part in slices(batches, "text", SLICE):
            block = read_block(part.column("text"), part.column("lang"))
            ids = vocabulary.ids(block)
            good = ids[block.at] != 0
            joined = block.joined & good
            joined[:-1] &= good[1:]
            found, n = distinct_windows(windows(block.at, joined, LONGEST), len(ids))
            found = np.concatenate([[0], ids])[found]
            for a in range(0, len(found), ENTRIES):
                trie.add(found[a:a + ENTRIES], n[a:a + ENTRIES])
                if trie.entries > ENTRIES:
                    yield from spilled(trie, ENTRIES // 2)
        yield from spilled(trie, 0)

    return documents.mapInArrow(run, _RUNS)


def prefix_counts(runs: DataFrame, least: int, width: int) -> DataFrame:
    """(``w1`` to ``w5``, 0 past the end; ``n``) of all phrases of two words and more with at least ``least`` occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, depth = np.zeros(LONGEST, np.int64), 0
        sums = [0] * (LONGEST + 1)   # of the open prefix of each length
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.concatenate([last[None], from_keys(batch.column("key"), width)])
            depths = np.concatenate([[depth], batch.column("n").to_numpy() % 8])
            n = batch.column("n").to_numpy() // 8
            changed, out = np.zeros(len(ids) - 1, bool), []
            for m in range(1, LONGEST + 1):
                changed = changed | (ids[1:, m - 1] != ids[:-1, m - 1])
                if m == 1:
                    continue
                # Row 0 is the open prefix; a prefix ends where the next row differs.
                starts = np.concatenate([[0], np.flatnonzero(changed) + 1])
                totals = np.add.reduceat(np.concatenate([[sums[m]], n]), starts)
                out.append(_phrases(ids[starts[:-1]], depths[starts[:-1]], totals[:-1], m, least))
                sums[m] = int(totals[-1])
            last, depth = ids[-1], int(depths[-1])
            yield from filter(None, out)
        for m in range(2, LONGEST + 1):
            yield from filter(None, [_phrases(last[None], np.array([depth]), np.array([sums[m]]), m, least)])

    prefix = F.expr(f"substring(key, 1, CAST(n % 8 AS INT) * {width})")
    merged = runs.repartition(prefix).sortWithinPartitions("key").mapInArrow(
        run, ", ".join(f"{c} bigint" for c in [*_IDS, "n"]))
    return merged.groupBy(*_IDS).agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _phrases(ids: np.ndarray, depths: np.ndarray, totals: np.ndarray, m: int, least: int) -> pa.RecordBatch | None:
    """The ended prefixes of ``m`` words that are frequent here, or whose other windows lie in other partitions."""
    kept = (ids[:, m - 1] != 0) & ((totals >= least) | (m < depths))
    if not kept.any():
        return None
    ids = np.where(np.arange(LONGEST) < m, ids[kept], 0)
    return pa.RecordBatch.from_arrays([*(pa.array(c) for c in ids.T), pa.array(totals[kept])], [*_IDS, "n"])


def frequent_words(counted: DataFrame, least: int, salt: int) -> tuple[Vocabulary, DataFrame]:
    """What the tasks know, and (``id``, ``lang``, ``word``, ``n``) of every frequent word; stored."""
    frequent = counted.filter((F.col("level") == 0) & (F.col("n") >= least)).select("lang", "word", "n")
    top = frequent.orderBy(F.desc("n"), "lang", "word").limit(KNOWN).select("lang", "word").toArrow()
    langs, spelled = top.column("lang").to_pylist(), top.column("word").to_pylist()
    loads = counted.filter("level > 0").select("level", "load", "n").collect()  # <= LEVELS * LOADS rows
    crowded, total = np.zeros((LEVELS, LOADS), bool), sum(r.n for r in loads if r.level == 1)
    for r in loads:
        crowded[r.level - 1, r.load] = r.n * SHARE > total
    by_lang: dict[str, tuple[list, list]] = {}
    for i, (lang, word) in enumerate(zip(langs, spelled), 1):
        by_lang.setdefault(lang, ([], []))[0].append(word)
        by_lang[lang][1].append(i)
    vocabulary = Vocabulary(
        {x: (pa.array(a, pa.large_binary()), np.array(b, np.int64)) for x, (a, b) in by_lang.items()},
        np.concatenate([[0], codes(langs, spelled, salt)]).astype(np.int64), frequent.count() == len(langs), crowded, salt)
    numbers = counted.sparkSession.createDataFrame(
        top.append_column("id", pa.array(range(1, len(langs) + 1), pa.int64())))
    table = frequent.join(F.broadcast(numbers), ["lang", "word"], "left")  # <= KNOWN rows
    return vocabulary, materialize(
        table.select(F.coalesce("id", -1 - code_column(salt)).alias("id"), "lang", "word", "n"), "frequent-words")


def _distinct_codes(counted: DataFrame, salt: int) -> bool:
    shared = counted.filter("level = 0").groupBy(code_column(salt)).count().filter("count > 1")
    return shared.isEmpty()


def phrase_counts(documents: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counted words of all languages, the frequent words with ids, and (``ids``, ``n``) of the frequent phrases; stored."""
    for salt in count():
        counted = count_words(documents, salt)
        vocabulary, table = frequent_words(counted, least, salt)
        if vocabulary.complete or _distinct_codes(counted, salt):
            break
    found = prefix_counts(window_runs(documents, vocabulary), least, vocabulary.width)
    ids = F.filter(F.array(*_IDS), lambda x: x != 0)
    return counted.filter("level = 0"), table, materialize(found.select(ids.alias("ids"), "n"), "frequent-phrases")


def _scored(candidates: DataFrame, phrases: DataFrame, table: DataFrame) -> DataFrame:
    """``ids``, ``lang`` and the lowest-scoring cut of each candidate: ``a``, ``l``, ``r``, ``n`` and ``score``."""
    counts = phrases.select("ids", "n").unionByName(table.select(F.array("id").alias("ids"), "n"))
    cuts = candidates.select(
        "ids", "lang", F.col("n").alias("a"), F.col("total").alias("n"),
        F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"),
    ).withColumns({"first": F.expr("slice(ids, 1, k)"), "rest": F.expr("slice(ids, k + 1, size(ids) - k)")})
    left = counts.select(F.col("ids").alias("first"), F.col("n").alias("l"))
    right = counts.select(F.col("ids").alias("rest"), F.col("n").alias("r"))
    exact = lambda c: f"CAST({c} AS DECIMAL(18,0))"
    scored = cuts.join(left, "first").join(right, "rest").withColumn(
        "score", F.expr(f"({exact('a')} * {exact('n')} * CAST(1000 AS DECIMAL(4,0))) div ({exact('l')} * {exact('r')})"))
    best = scored.groupBy("ids", "lang", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("ids", "lang", "a", "best.l", "best.r", "n", "best.score")


def collocations(documents: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, keep: int = 2000) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of each language's best phrases."""
    narrow = documents.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    counted, table, phrases = phrase_counts(narrow, least)
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    # A phrase that a longer one covers is covered by one a word longer, which is then as frequent.
    longer = phrases.filter("size(ids) > 2")
    covers = longer.select(F.expr("slice(ids, 1, size(ids) - 1)").alias("ids"), F.col("n").alias("cover")).unionByName(
        longer.select(F.expr("slice(ids, 2, size(ids) - 1)").alias("ids"), F.col("n").alias("cover")))
    lone = phrases.join(covers.groupBy("ids").agg(F.max("cover").alias("cover")), "ids", "left").filter(
        "cover IS NULL OR cover < n").drop("cover")
    spelled = lone.select("ids", F.posexplode("ids").alias("at", "id")).join(table.select("id", "lang", "word"), "id").groupBy(
        "ids").agg(F.array_sort(F.collect_list(F.struct("at", F.col("word").cast("string").alias("word")))).alias("all"),
                   F.min("lang").alias("lang"))
    named = spelled.select("ids", "lang", F.array_join(F.transform("all", lambda x: x["word"]), " ").alias("phrase"))
    scored = _scored(lone.join(named.select("ids", "lang"), "ids").join(totals, "lang"), phrases, table)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = scored.join(named.drop("lang"), "ids").withColumn("rank", rank).filter(F.col("rank") <= keep)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
