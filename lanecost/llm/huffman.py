"""Token ids in Huffman-coded files.

Texts become ids, dealt by ranges of their key and sorted in them. The ids of all
documents are counted; from the counts come code lengths of bounded size (package-merge)
and canonical codes, of which the lengths alone need storing. Documents are coded into
blocks that know nothing of each other. Inside a block the bit offset of every
``LANE``th id is kept, so that a reader may start there, and this one does: it decodes
all lanes of a block side by side, an id of each at a time, with one table look-up.

A coded folder has three Parquet tables: ``blocks`` (part, first, keys, lengths, payload,
offsets), ``codes`` (the lengths of the codes by id) and ``parts`` (part, before: the ids
of all parts in front of it).
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanecost.llm.chunks import ArrowTable
from lanecost.llm.common import few, written
from lanecost.sources.folders import shared_folder

LONGEST = 18
"""Bits of the longest code; at least log2 of the number of ids."""
LANE = 256
BLOCK_IDS = 1 << 18
"""A block ends with the document that reaches so many ids; documents are not split."""
ROWS = 3_000
SLICE_BYTES = 12 << 20
"""Rows and bytes of texts that a task segments together."""
PART_IDS = 4 << 20
"""Ids of a part on average."""
FIRST = "\ue000"
"""A private-use character: texts may hold it like any other, as chunks need no mark."""
JOINED = 1 << 18
"""Bytes of chunks that the model gets at a time; a longer chunk comes alone."""


def _bytes(*spans: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for low, high in spans:
        out[low : high + 1] = True
    return out


_DARK = _bytes((0x21, 0x7E), (0xC3, 0xE0), (0xE4, 0xF4))
"""Bytes that only begin characters other than white space."""
_SIGN = _bytes((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_ALNUM = _bytes((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))


@lru_cache(maxsize=2)
def tokenizer(path: str):  # noqa: ANN201
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _added(path: str) -> str:
    """A pattern of the tokens that the model looks for before its first split; it finds
    every text if that split is another than :func:`_cut` expects."""
    from tokenizers import pre_tokenizers

    model = tokenizer(path)
    split = model.pre_tokenizer
    usual = isinstance(split, pre_tokenizers.ByteLevel) and split.use_regex and not split.add_prefix_space
    if not usual or model.normalizer is not None:
        return ""
    return "|".join(re.escape(t.content) for t in model.get_added_tokens_decoder().values()) or "$^."


@lru_cache(maxsize=2)
def _table(path: str) -> ArrowTable:
    """The table of chunks of a byte-level model."""
    model = tokenizer(path)
    width = np.zeros(model.get_vocab_size(), np.int64)
    for token, i in model.get_vocab().items():
        width[i] = len(token)  # one character for each byte

    def joined(text: bytes, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids, and how many each has, of chunks that the model cuts apart wherever
        they stand in a row."""
        (found,) = model.encode_batch_fast([text.decode()], add_special_tokens=False)  # without places in the text
        ids = np.array(found.ids, np.int32)
        ends = np.cumsum(width[ids])
        cuts = np.searchsorted(ends, stops) + 1
        if len(ids) != cuts[-1] or not np.array_equal(ends[cuts - 1], stops):
            return None
        return ids, np.diff(cuts, prepend=0)

    def alone(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in model.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(found), np.int32)
        return flat, np.fromiter(map(len, found), np.int64, len(found))

    def segment(chunks: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        data, stops = _content(chunks)
        data = np.append(data, np.zeros(1, np.uint8))
        apart = (data[stops[:-1]] == 0x20) & _DARK[data[stops[:-1] + 1]] & (np.diff(stops) > 1)
        apart &= ~_matched(chunks, _added(path))
        single, regular = chunks.filter(pa.array(~apart)), chunks.filter(pa.array(apart))
        parts = [alone(single.slice(a, b - a).to_pylist()) for a, b in _runs(_content(single)[1])]
        data, stops = _content(regular)
        for a, b in _runs(stops):
            found = joined(data[stops[a] : stops[b]].tobytes(), stops[a + 1 : b + 1] - stops[a])
            parts.append(found or alone(regular.slice(a, b - a).to_pylist()))
        order = np.concatenate([np.flatnonzero(~apart), np.flatnonzero(apart)])
        lengths = np.concatenate([n for _, n in parts])
        shift = np.cumsum(lengths) - lengths  # where each begins in the order of parts
        back = np.argsort(order)
        lengths, shift = lengths[back], shift[back]
        shift -= np.cumsum(lengths) - lengths
        where = np.repeat(shift, lengths)
        return np.concatenate([ids for ids, _ in parts])[where + np.arange(len(where))], lengths

    return ArrowTable(segment)


def _content(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts in a row, and where each begins and the last ends."""
    _, offsets, data = texts.buffers()
    stops = np.frombuffer(offsets, np.int32, len(texts) + 1, 4 * texts.offset) if len(texts) else np.zeros(1, np.int32)
    data = np.frombuffer(data, np.uint8)[stops[0] : stops[-1]] if data else np.zeros(0, np.uint8)
    return data, stops.astype(np.int64) - stops[0]


def _runs(stops: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where runs of at most ``JOINED`` bytes begin and end, by the chunks' own stops."""
    at = 0
    while at < len(stops) - 1:
        end = max(at + 1, int(np.searchsorted(stops, stops[at] + JOINED, "right")) - 1)
        yield at, end
        at = end


def _matched(texts: pa.StringArray, pattern: str) -> np.ndarray:
    return pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).astype(bool)


def _cut(texts: pa.StringArray, whole: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """The chunks of texts, and where each text's end. Cut is where the model's own first
    split always does, so that a chunk gives the same ids alone: before a space and on
    both sides of a line end, if a character follows that is no white space, and between
    a letter or digit and an ASCII sign. Texts marked as ``whole`` are one chunk."""
    data, stops = _content(texts)
    begins = stops[:-1][np.diff(stops) > 0]
    cut = np.zeros(len(data) + 1, bool)
    dark = np.append(_DARK[data[1:]], False)[: len(data)]  # of the next byte
    dark[begins - 1] = False  # the next byte is another text's, or there is none
    cut[:-1] = dark & (data == 0x20)
    lines = np.flatnonzero(dark & (data == 0x0A))
    cut[lines] = cut[lines + 1] = True
    signs = np.flatnonzero(_SIGN[data])
    last, lead = data[signs - 1], data[signs - 2]  # in front of a text's first byte all may be cut
    latin = (last >= 0x80) & ((lead == 0xC3) & (last != 0x97) & (last != 0xB7) | (lead >= 0xC4) & (lead <= 0xC8))
    cut[signs[_ALNUM[last] | latin]] = True
    for i in np.flatnonzero(whole):
        cut[stops[i] : stops[i + 1]] = False
    cut[begins] = True
    starts = np.append(np.flatnonzero(cut[:-1]), len(data))
    buffers = [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.string(), len(starts) - 1, buffers), np.searchsorted(starts, stops[1:])


def tokenize(texts: list[str] | pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts and where each text's end, as the library's encode gives
    them without special tokens. Distinct chunks of the texts are segmented once."""
    texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string())
    return _table(path).ids(*_cut(texts, _matched(texts, _added(path))))


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """The lengths of the best prefix code with no code above ``longest`` bits, 0 for
    ids that do not occur; by package-merge. An id alone has length 1."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        out[used] = 1
        return out
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} ids need codes of more than {longest} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.int64)
    n = len(order)
    levels: list[np.ndarray] = []  # of each level: whether the items in order are leaves
    merged, leaf = weight, np.ones(n, dtype=bool)
    levels.append(leaf)
    for _ in range(longest - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weight, pairs])
        by = np.argsort(both, kind="stable")
        merged, leaf = both[by], by < n
        levels.append(leaf)
    take = 2 * n - 2
    for leaf in reversed(levels):
        chosen = leaf[:take]
        own = int(chosen.sum())
        out[order[:own]] += 1
        take = 2 * (len(chosen) - own)
    return out


class Code:
    """Canonical codes from their lengths: shorter ones first, then by id."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(lengths)
        order = used[np.argsort(self.lengths[used], kind="stable")]
        self.longest = int(self.lengths.max(initial=1))
        step = 1 << (self.longest - self.lengths[order])
        left = np.cumsum(step) - step
        self.codes = np.zeros(len(lengths), np.int64)
        self.codes[order] = left >> (self.longest - self.lengths[order])
        self._order, self._step = order, step

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """For every value of the next ``longest`` bits: the id, and its length."""
        size = 1 << self.longest
        ids = np.repeat(self._order, self._step)
        ids = np.concatenate([ids, np.zeros(size - len(ids), ids.dtype)])
        return ids.astype(np.int64), np.maximum(self.lengths[ids], 1)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits, highest first, and the bit offset of every ``LANE``th id."""
        size = self.lengths[ids]
        ends = np.cumsum(size)
        starts = ends - size
        if not len(ids):
            return b"", starts.astype(np.uint64)
        word = starts >> 5  # a code begins in every word of 32 bits, as none is longer, and may end in the next
        spread = self.codes[ids] << (64 - size - (starts & 31))
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out = np.zeros(len(first) + 1, np.int64)
        out[:-1] = np.add.reduceat(spread >> 32 & 0xFFFFFFFF, first)
        out[1:] += np.add.reduceat(spread & 0xFFFFFFFF, first)
        return out.astype(">u4").tobytes()[: int(ends[-1]) + 7 >> 3], starts[::LANE].astype(np.uint64)


class Decoder:
    def __init__(self, code: Code) -> None:
        self.longest = code.longest
        ids, sizes = code.table()
        self.both = ids << 8 | sizes

    def decode(self, payload: bytes, offsets: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` ids of a block, all lanes side by side."""
        data = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
        window = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
        lanes = len(offsets)
        out = np.zeros((LANE, lanes), np.int64)
        at = offsets.astype(np.int64)
        last = len(payload) * 8
        mask = (1 << self.longest) - 1
        for row in out:
            both = self.both[window[at >> 3] >> (32 - self.longest - (at & 7)) & mask]
            row[:] = both >> 8
            at = np.minimum(at + (both & 255), last)
        return out.T.reshape(-1)[:n]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a bounded number and size, so that the words of many texts meet; a longer
    text comes alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, min(at + ROWS, int(np.searchsorted(ends, before + SLICE_BYTES, "right"))))
        yield batch.slice(at, stop - at)
        at = stop


def token_rows(docs: DataFrame, path: str, end: int, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, np.ndarray]:
    """key, ids of every text and how often each id occurs in all of them. ids ends with
    the end id and holds little-endian integers of :func:`width` bytes.

    Texts become ids where they are read, and are counted in the same pass: written are a
    row for each text and one for each id of a task. One row per task and id is shuffled,
    one per id comes to the driver."""
    narrow = docs.select(key, text)
    kind = _kind(path, end)
    schema = T.StructType([
        T.StructField("key", docs.schema[key].dataType),
        T.StructField("ids", T.BinaryType()),
        T.StructField("id", T.LongType()),
        T.StructField("n", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, keys = np.zeros(0, np.int64), None
        for batch in batches:
            keys = batch.schema.field(0).type
            for rows in _slices(batch):
                ids, stops = tokenize(pc.fill_null(rows.column(1), ""), path)
                found = np.bincount(ids, minlength=max(len(total), end + 1))
                found[end] += len(stops)
                found[: len(total)] += total
                total = found
                out = [np.append(ids[a:b], end).astype(kind).tobytes() for a, b in pairwise([0, *stops])]
                none = pa.nulls(len(out), pa.int64())
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(out, pa.binary()), none, none], schema.names)
        at = np.flatnonzero(total)
        if len(at):
            none = [pa.nulls(len(at), keys), pa.nulls(len(at), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], schema.names)

    rows = written(narrow.mapInArrow(run, schema), "token-ids")
    got = rows.where("id IS NOT NULL").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in got), default=-1) + 1, np.int64)
    for r in got:
        counts[r["id"]] = r["n"]
    return rows.where("id IS NULL").select("key", "ids"), counts


def _kind(path: str, end: int) -> str:
    """The type of stored ids: 16 bits where all of them fit."""
    return "<u2" if max(tokenizer(path).get_vocab_size(), end + 1) <= 1 << 16 else "<u4"


def write_ids(rows: DataFrame, counts: np.ndarray, kind: str, folder: str, longest: int = LONGEST, block_ids: int = BLOCK_IDS) -> None:
    """Codes the rows of :func:`token_rows` into a folder, in ascending order of key, null
    keys first, rows of one key by a hash of their ids. ``kind`` is the type of their ids.
    Rows are dealt by ranges, so that many of one key are several parts."""
    spark = rows.sparkSession
    lengths = code_lengths(counts, longest)
    code = spark.sparkContext.broadcast(lengths)
    key = rows.schema["key"].dataType
    schema = T.StructType([
        T.StructField("part", T.IntegerType()),
        T.StructField("first", T.LongType()),
        T.StructField("keys", T.ArrayType(key)),
        T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("payload", T.BinaryType()),
        T.StructField("offsets", T.BinaryType()),
    ])
    size = np.dtype(kind).itemsize
    parts = max(1, -(-int(counts.sum()) // PART_IDS))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("ids").asc(), F.col("ids").asc()]
    dealt = rows.repartitionByRange(parts, *order[:2]).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Code(code.value)
        part, first, held = TaskContext.get().partitionId(), 0, 0
        keys: list[pa.Array] = []
        ids: list[bytes] = []

        def block() -> pa.RecordBatch:
            of_key = pa.concat_arrays(keys)
            sizes = np.array([len(x) // size for x in ids])
            payload, offsets = coder.encode(np.frombuffer(b"".join(ids), kind).astype(np.int64))
            columns = [pa.array([part], pa.int32()), pa.array([first], pa.int64())]
            columns += [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (of_key, pa.array(sizes, pa.int64()))]
            columns += [pa.array([payload], pa.binary()), pa.array([offsets.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, schema.names)

        for batch in batches:
            texts = batch.column("ids").to_pylist()
            ends = held + np.cumsum([len(x) // size for x in texts])
            at = 0
            while at < len(texts):
                stop = min(int(np.searchsorted(ends, block_ids)) + 1, len(texts))
                keys.append(batch.column("key").slice(at, stop - at))
                ids += texts[at:stop]
                held = int(ends[stop - 1])
                if held >= block_ids:
                    yield block()
                    first += held
                    ends = ends - held
                    keys, ids, held = [], [], 0
                at = stop
        if ids:
            yield block()

    dealt.mapInArrow(run, schema).write.option("compression", "none").parquet(f"{folder}/blocks")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = spark.read.schema(schema).parquet(f"{folder}/blocks")
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda n, x: n + x)
    sums = blocks.groupBy("part").agg(F.sum(total).alias("n"))
    before = sums.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    before.write.parquet(f"{folder}/parts")
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").write.parquet(f"{folder}/codes")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """key, start, ids: the documents of a coded folder; start counts the ids of all
    documents before it, ids are little-endian 32-bit integers. Blocks are decoded
    independently, from the files alone."""
    lengths = np.frombuffer(spark.read.parquet(f"{folder}/codes").head()["lengths"], np.uint8)
    code = spark.sparkContext.broadcast(lengths)
    blocks = spark.read.parquet(f"{folder}/blocks")
    schema = T.StructType([
        T.StructField("part", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("key", blocks.schema["keys"].dataType.elementType),
        T.StructField("ids", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Code(code.value))
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1)
                sizes = np.asarray(block.column("lengths").flatten())
                payload, offsets = block.column("payload")[0].as_py(), block.column("offsets")[0].as_py()
                ids = decoder.decode(payload, np.frombuffer(offsets, np.uint64), int(sizes.sum())).astype("<u4")
                stops = np.cumsum(sizes)
                part, first = block.column("part")[0].as_py(), block.column("first")[0].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(sizes), pa.int32()),
                        pa.array(first + stops - sizes, pa.int64()),
                        block.column("keys").flatten(),
                        pa.array([ids[b - n : b].tobytes() for b, n in zip(stops, sizes, strict=True)], pa.binary()),
                    ],
                    schema.names,
                )

    rows = blocks.mapInArrow(run, schema)
    parts = few(spark.read.parquet(f"{folder}/parts"), 1_000_000)
    return rows.join(parts, "part").select("key", (F.col("start") + F.col("before")).alias("start"), "ids")


def round_trip(docs: DataFrame, path: str, end: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, start, n_tokens, ids_crc32 of every document, as read back from the files
    its ids were written to.

    Ids are those of the tokenizer file ``path``, readable on every executor, and the
    end id. Null and empty texts have the end id alone. Rows come in ascending order of
    key in the files, null keys first, rows of one key by a hash of their ids. An empty
    table gives an empty table. Other columns are not read.
    """
    folder = shared_folder(docs.sparkSession, "huffman")
    rows, counts = token_rows(docs, path, end, key, text)
    write_ids(rows, counts, _kind(path, end), folder)
    return read_ids(docs.sparkSession, folder).select(
        F.col("key").alias(key),
        "start",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
