"""Phrases whose words belong together, by exact counts of all runs of words.

Counting runs in passes over the whole texts: words, then runs of two words, then of
three. Only runs whose parts occur often enough can do so themselves, so a pass counts
the runs whose parts passed the one before. What passed is known to the tasks as a bit
table of fixed size: a run that it lets through by mistake is counted for nothing and
goes by its count; one that it holds back cannot be frequent, however large the corpus.

A task counts in a HAT-trie: a shallow trie of word ids over hash containers, each
holding the runs of a range of prefixes. A container that grows too large is burst at a
word, first at the first word, below a single first word at the second. When the trie
outgrows its task, whole subtrees are spilled as sorted runs. The runs of all tasks meet
by prefix: the words before the last, and a sixteenth of the last ones, so that a prefix
of any weight is merged by several tasks.

A word's id in the corpus is a 64-bit hash of its language and itself; that no two words
share one is checked on the words themselves, and another seed is taken if they do.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanecost.llm.common import written

LEAST = 10
LONGEST = 3
TOP = 2_000
COVERED = 50
"""Percent of a phrase's occurrences inside a longer one from which it is dropped."""
NO_LANGUAGE = "und"

BREAKS = ".,;:!?\n\x0b\x0c\r"
_BREAK = b"."
_FOLDED = bytes(
    ord(_BREAK) if chr(b) in BREAKS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)  # all breaks as one, a tab as a space, A-Z as a-z

BITS = 27
"""Size of the bit table, as a power of two: 16 MB whatever the corpus."""
_SLOT = 15
_SUBRUNS = 16

WORD_BITS = 21
"""Ids inside a task are numbered, so that three of them fit a long."""
SLICE_BYTES = 2 << 20
"""Texts are taken in slices, so that few new words come at a time."""
TRIE_ENTRIES = 3_000_000
BURST = 1 << 16
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_FREE = np.int64(-1)


class Container:
    """A hash table of runs and their counts, with keys from ``low`` on."""

    def __init__(self, low: int, room: int = 1 << 10):
        self.low, self.used = low, 0
        self._room(room)

    def _room(self, room: int) -> None:
        self.keys, self.counts = np.full(room, _FREE), np.zeros(room, np.int64)
        self.shift = np.uint64(64 - (room.bit_length() - 1))

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys in order, and their counts."""
        held = np.flatnonzero(self.keys != _FREE)
        held = held[np.argsort(self.keys[held])]
        return self.keys[held], self.counts[held]

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add distinct keys with their counts."""
        if 2 * (self.used + len(keys)) > len(self.keys):
            old = self.entries()
            self.used = 0
            self._room(1 << int(2 * (len(old[0]) + len(keys))).bit_length())
            self._put(*old)
        self._put(keys, counts)

    def _put(self, keys: np.ndarray, counts: np.ndarray) -> None:
        last = len(self.keys) - 1
        slot = ((keys.view(np.uint64) * _FACTOR) >> self.shift).astype(np.int64)
        while len(keys):
            held = self.keys[slot]
            free = held == _FREE
            self.keys[slot[free]] = keys[free]  # of several for one slot the last stays
            mine = self.keys[slot] == keys
            self.counts[slot[mine]] += counts[mine]
            self.used += int((mine & free).sum())
            left = ~mine
            keys, counts, slot = keys[left], counts[left], (slot[left] + 1) & last


class Trie:
    """Counts runs of ``words`` task-local ids, packed into longs, in burstable containers.

    ``lows`` are the first keys of the containers, which are the trie's branches: each
    covers the prefixes up to the next."""

    def __init__(self, words: int):
        self.words = words
        self.containers = [Container(0)]
        self.lows = np.zeros(1, np.int64)

    def __len__(self) -> int:
        return sum(c.used for c in self.containers)

    def add(self, keys: np.ndarray) -> None:
        keys, counts = np.unique(keys, return_counts=True)
        edges = np.append(np.searchsorted(keys, self.lows), len(keys))
        for c, i, j in list(zip(self.containers, edges, edges[1:], strict=False)):
            if i < j:
                c.add(keys[i:j], counts[i:j])
                if c.used > BURST:
                    self._burst(c)

    def _burst(self, container: Container) -> None:
        """Replace a container by two, parted at a word: the shortest prefix that leaves
        something on both sides."""
        keys, counts = container.entries()
        middle = int(keys[len(keys) // 2])
        for depth in range(1, self.words + 1):
            cut = middle >> WORD_BITS * (self.words - depth) << WORD_BITS * (self.words - depth)
            at = int(np.searchsorted(keys, cut))
            if 0 < at:
                break
        parts = []
        for low, part in ((container.low, slice(0, at)), (cut, slice(at, len(keys)))):
            parts.append(Container(low))
            parts[-1].add(keys[part], counts[part])
        nth = self.containers.index(container)
        self.containers[nth : nth + 1] = parts
        self.lows = np.array([c.low for c in self.containers])
        for part in parts:
            if part.used > BURST:
                self._burst(part)

    def spill(self, most: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take out whole subtrees, the largest first, until ``most`` entries are left;
        each as a sorted run."""
        left = len(self)
        for c in sorted(self.containers, key=lambda c: -c.used):
            if left <= most:
                return
            if c.used:
                yield c.entries()
                left -= c.used
                c.used = 0
                c._room(1 << 10)


class _Words(dict):
    """Numbers the words of a language inside a task; 0 for words that are held back."""

    def __init__(self, language: bytes, owner: Dictionary):
        self.language, self.owner = language, owner
        self[_BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = self.owner.number(self.language, word)
        return number


class Dictionary:
    """The words that a task has met, by language, and the hash of each."""

    def __init__(self, seed: int, passed: bytes | None):
        self.seed, self.passed = seed, passed
        self.clear()

    def clear(self) -> None:
        self.languages: dict[str, _Words] = {}
        self.numbers = count(1)
        self.hashes = [0]

    def of(self, language: str) -> _Words:
        if language not in self.languages:
            self.languages[language] = _Words(language.encode(), self)
        return self.languages[language]

    def number(self, language: bytes, word: bytes) -> int:
        name = xxhash.xxh64_intdigest(language + b"\0" + word, self.seed)
        if self.passed is not None:
            at = name >> (64 - BITS)
            if not self.passed[at >> 3] >> (at & 7) & 1:
                return 0
        self.hashes.append(name)
        return next(self.numbers)

    def full(self) -> bool:
        return sum(map(len, self.languages.values())) >= 1 << (WORD_BITS - 2)


def _holds(table: np.ndarray, names: np.ndarray) -> np.ndarray:
    at = names >> np.uint64(64 - BITS)
    return (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _named(parts: list[np.ndarray]) -> np.ndarray:
    """A hash of a run from those of its words."""
    name = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        name = (name ^ part) * np.uint64(0xD6E8FEB86659FD93)
        name ^= name >> np.uint64(32)
    return name * _FACTOR


def _slices(text: bytes) -> Iterator[bytes]:
    """A text in slices that end with a word."""
    at = 0
    while at < len(text):
        stop = at + SLICE_BYTES
        if stop < len(text):
            ends = [e for e in (text.find(b" ", stop), text.find(_BREAK, stop)) if e >= 0]
            stop = min(ends, default=len(text))
        yield text[at:stop]
        at = stop


def _streams(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes, bool]]:
    """language, folded text, whether it continues the one before. Short texts of a
    language come together, parted by breaks."""
    waiting: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for language, text in zip(batch.column(0), batch.column(1), strict=True):
        language, text = language.as_py() or "", text.as_py()
        data = text.encode().translate(_FOLDED) if text else b""
        if len(data) > SLICE_BYTES:
            for nth, part in enumerate(_slices(data)):
                yield language, part, nth > 0
        elif data:
            waiting.setdefault(language, []).append(data)
            sizes[language] = sizes.get(language, 0) + len(data)
            if sizes[language] > SLICE_BYTES:
                yield language, _BREAK.join(waiting.pop(language)), False
                sizes[language] = 0
    for language, texts in waiting.items():
        yield language, _BREAK.join(texts), False


def _words(data: bytes) -> list[bytes]:
    """The words of a folded text, and its breaks."""
    return data.replace(_BREAK, b" . ").split()


def _numbers(found: list[bytes], words: _Words) -> np.ndarray:
    return np.fromiter(map(words.__getitem__, found), np.int64, len(found))


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text).alias("text"))


def _word_counts(texts: DataFrame, seed: int) -> DataFrame:
    """word_id, lang, word, n: every word of every task, with its count in it."""
    schema = T.StructType.fromDDL("word_id long, lang string, word string, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Dictionary(seed, None)
        counts = np.zeros(1 << 16, np.int64)

        def told() -> Iterator[pa.RecordBatch]:
            for language, words in known.languages.items():
                names = [w for w in words if w != _BREAK]
                at = np.fromiter((words[w] for w in names), np.int64, len(names))
                hashes = np.array(known.hashes, np.uint64).view(np.int64)[at]
                columns = [pa.array(hashes), pa.array([language] * len(names), pa.string())]
                columns += [pa.array([w.decode() for w in names], pa.string()), pa.array(counts[at])]
                yield pa.RecordBatch.from_arrays(columns, schema.names)
            known.clear()
            counts[:] = 0

        for batch in batches:
            for language, data, _ in _streams(batch):
                found = np.bincount(_numbers(_words(data), known.of(language)))
                if len(found) > len(counts):
                    counts = np.append(counts, np.zeros(2 * len(found) - len(counts), np.int64))
                counts[: len(found)] += found
                if known.full():
                    yield from told()
        yield from told()

    return texts.mapInArrow(run, schema)


def _run_counts(texts: DataFrame, words: int, seed: int, passed: bytes, before: bytes | None) -> DataFrame:
    """w1, .., n: runs of ``words`` words that the bit tables let through, and counts,
    from the tries of all tasks. ``passed`` is the table of words, ``before`` that of the
    runs of one word less."""
    names = [f"w{i}" for i in range(1, words + 1)]
    schema = T.StructType.fromDDL(", ".join(f"{c} long" for c in [*names, "n"]))
    share = texts.sparkSession.sparkContext.broadcast
    tables = share(passed), share(before) if before else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Dictionary(seed, tables[0].value)
        shorter = np.frombuffer(tables[1].value, np.uint8) if tables[1] else None
        trie = Trie(words)
        mask = np.int64((1 << WORD_BITS) - 1)

        def told(most: int = 0) -> Iterator[pa.RecordBatch]:
            hashes = np.array(known.hashes, np.uint64).view(np.int64)
            for keys, counts in trie.spill(most):
                ids = [hashes[(keys >> np.int64(WORD_BITS * (words - 1 - i))) & mask] for i in range(words)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*ids, counts)], schema.names)

        found: list[bytes] = []
        for batch in batches:
            for language, data, goes_on in _streams(batch):
                found = found[len(found) - words + 1 :] + _words(data) if goes_on else _words(data)
                ids = _numbers(found, known.of(language))
                if len(ids) >= words:
                    parts = [ids[i : len(ids) - words + 1 + i] for i in range(words)]
                    met = np.logical_and.reduce([p > 0 for p in parts])
                    if shorter is not None and met.any():
                        hashes = np.array(known.hashes, np.uint64)[ids]
                        pairs = _holds(shorter, _named([hashes[i : len(ids) - words + 2 + i] for i in range(words - 1)]))
                        met &= pairs[:-1] & pairs[1:]
                    key = parts[0][met]
                    for part in parts[1:]:
                        key = key << np.int64(WORD_BITS) | part[met]
                    trie.add(key)
                if len(trie) > TRIE_ENTRIES:
                    yield from told(TRIE_ENTRIES // 2)
                if known.full():
                    yield from told()
                    known.clear()
        yield from told()

    return texts.mapInArrow(run, schema)


def _bit_table(slots: DataFrame) -> bytes:
    """The table with the bits ``slot``: at most 4,096 parts of 4 KB come to the driver."""
    at = F.col("slot") + 1
    parts = slots.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    table = bytearray(1 << (BITS - 3))
    size = 1 << (_SLOT - 3)
    for row in parts.toLocalIterator():
        table[(row.part - 1) * size : row.part * size] = row.bits
    return bytes(table)


def _slots(runs: DataFrame, words: int) -> DataFrame:
    """The bit of each run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.asarray(c).view(np.uint64) for c in batch.columns]
            named = _named(parts) if words > 1 else parts[0]
            yield pa.RecordBatch.from_arrays([pa.array((named >> np.uint64(64 - BITS)).view(np.int64))], ["slot"])

    return runs.mapInArrow(run, "slot long")


def _merged(parts: DataFrame, words: int, least: int) -> DataFrame:
    """The runs that occur often enough, their counts added up prefix by prefix."""
    names = [f"w{i}" for i in range(1, words + 1)]
    parts = parts.withColumn("part", F.pmod(names[-1], F.lit(_SUBRUNS)))
    met = parts.repartition(*names[:-1], "part").groupBy(*names, "part").agg(F.sum("n").alias("n"))
    return met.where(F.col("n") >= least).drop("part")


def word_table(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[DataFrame, int]:
    """word_id, lang, word, n of every word, and the seed of its ids: the first with which
    no two words share one."""
    texts = _texts(docs, text, lang)
    for seed in count():
        one, other = (f(F.struct("lang", "word")).alias(c) for f, c in ((F.min, "one"), (F.max, "other")))
        words = written(_word_counts(texts, seed).groupBy("word_id").agg(one, other, F.sum("n").alias("n")), "words")
        if words.where("one <> other").isEmpty():
            return words.select("word_id", "one.lang", "one.word", "n"), seed


def run_tables(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST):
    """The words (:func:`word_table`) and, by number of words, the tables w1, w2, .., n of
    all runs with ``least`` occurrences or more."""
    words, seed = word_table(docs, text, lang)
    passed = _bit_table(_slots(words.where(F.col("n") >= least).select("word_id"), 1))
    texts, runs, before = _texts(docs, text, lang), {}, None
    for length in range(2, longest + 1):
        counts = _run_counts(texts, length, seed, passed, before)
        runs[length] = written(_merged(counts, length, least), f"runs-{length}")
        if length < longest:
            before = _bit_table(_slots(runs[length].drop("n"), length))
    return words, runs


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (l * r)), exact below 10^14 occurrences."""
    a, left, right = (c.cast("decimal(14,0)") for c in (a, left, right))
    return F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), left * right)


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    covered: int = COVERED,
    top: int = TOP,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to
    ``longest`` (2 or 3) words.

    A phrase is a run of words between breaks (``.,;:!?`` and line ends), A-Z as a-z, that
    occurs ``a >= least`` times, overlapping ones included. Cut after its first words it
    gives ``l`` and ``r``, the occurrences of both parts, and floor(10^6 * a * a / (l * r));
    the cut with the lowest score counts, of equal ones the first. A phrase that occurs to
    ``covered`` percent or more inside a longer one is dropped. ``n`` counts the words of
    the language. The first ``top`` by score, then a, descending, then the phrase by its
    bytes stay; there are no ties.

    A null language counts as ``und``, a null text as empty. Repeated rows count as often as
    they are there, whatever their keys. Texts of any length are read whole. A language
    without phrases has no rows, an empty table gives none. Other columns are not read.
    """
    if longest not in (2, 3):
        raise ValueError("phrases have 2 or 3 words")
    words, runs = run_tables(docs, text, lang, least, longest)
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    often = words.where(F.col("n") >= least)

    def word(nth: int) -> DataFrame:
        return often.select(F.col("word_id").alias(f"w{nth}"), F.col("word").alias(f"word{nth}"), F.col("n").alias(f"n{nth}"))

    def pair(first: int) -> DataFrame:
        return runs[2].select(F.col("w1").alias(f"w{first}"), F.col("w2").alias(f"w{first + 1}"), F.col("n").alias(f"n{first}{first + 1}"))

    spoken = often.select(F.col("word_id").alias("w1"), "lang")
    pairs = runs[2].withColumnRenamed("n", "a")
    if longest == 3:
        inside = [runs[3].select(F.col(f"w{i}").alias("w1"), F.col(f"w{i + 1}").alias("w2"), "n") for i in (1, 2)]
        most = inside[0].unionByName(inside[1]).groupBy("w1", "w2").agg(F.max("n").alias("most"))
        pairs = pairs.join(most, ["w1", "w2"], "left").where(100 * F.coalesce("most", F.lit(0)) < covered * F.col("a"))
    pairs = pairs.join(word(1), "w1").join(word(2), "w2").join(spoken, "w1")
    found = pairs.select(
        "lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("n1").alias("l"), F.col("n2").alias("r")
    ).withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    if longest == 3:
        triples = runs[3].withColumnRenamed("n", "a").join(pair(1), ["w1", "w2"]).join(pair(2), ["w2", "w3"])
        triples = triples.join(word(1), "w1").join(word(2), "w2").join(word(3), "w3").join(spoken, "w1")
        triples = triples.withColumn("one", _score(F.col("a"), F.col("n1"), F.col("n23")))
        triples = triples.withColumn("two", _score(F.col("a"), F.col("n12"), F.col("n3")))
        first = F.col("one") <= F.col("two")
        found = found.unionByName(
            triples.select(
                "lang",
                F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"),
                "a",
                F.when(first, F.col("n1")).otherwise(F.col("n12")).alias("l"),
                F.when(first, F.col("n23")).otherwise(F.col("n3")).alias("r"),
                F.least("one", "two").alias("score"),
            )
        )
    # The best of every sixty-fourth of a language first, so that no task sorts all of it.
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*best)
    every = Window.partitionBy("lang").orderBy(*best)
    found = written(found, "phrases").withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(every).cast("long")).where(F.col("rank") <= top)
    return found.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
