"""SentencePiece encoding through a table of distinct marked words, and decoding.

In a model whose pieces never go on past a whitespace marker, merges stay inside a run
of markers and the word behind it. So a text is cut there, every distinct marked word is
segmented once, and its ids are put back at all its positions. The table of distinct
words belongs to a worker process: it grows with the words met, is trimmed to the frequent
ones beyond a bound, and nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lanecost.llm.chunks import ChunkTable

MARK = "▁"
ROWS = 500
"""Texts taken at a time."""


@lru_cache(maxsize=2)
def processor(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def keeps_to_words(model: sentencepiece.SentencePieceProcessor) -> bool:
    """Whether a text may be cut before its runs of whitespace: no piece has a marker
    after another character, texts begin with a marker of their own, and whitespace and
    other characters are left as they are."""
    crossing = re.compile(f"[^{MARK}]{MARK}")
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    plain = "".join(model.id_to_piece(i) for i in model.encode(" a   ﬁ\n b")).replace("<0x0A>", "\n")
    return not any(map(crossing.search, pieces)) and plain == f"{MARK}{MARK}a{MARK}{MARK} ﬁ\n{MARK}b"


def marked_words(text: str) -> list[str]:
    """The chunks of a text, each without its first marker, markers written as spaces."""
    if not text:
        return []
    words = text.replace(MARK, " ").split(" ")
    if "" not in words:
        return words
    out, gap = [], 0
    for word in words[:-1]:
        if word:
            out.append(" " * gap + word)
            gap = 0
        else:
            gap += 1
    out.append(" " * gap + words[-1])
    return out


@lru_cache(maxsize=2)
def _table(path: str) -> ChunkTable | None:
    model = processor(path)
    if not keeps_to_words(model):
        return None
    alone = model.piece_to_id(MARK)

    def segment(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = [ids if word else [alone] for word, ids in zip(words, model.encode(words, num_threads=1), strict=True)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32), np.cumsum(lengths) - lengths, lengths

    return ChunkTable(segment)


def encode_texts(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts and where each text's end, as the library gives them."""
    table = _table(path)
    if table:
        return table.ids([marked_words(t) for t in texts])
    found = processor(path).encode(texts, num_threads=1)
    ids = np.concatenate([np.array(x, np.int32) for x in found]) if found else np.zeros(0, np.int32)
    return ids, np.cumsum([len(x) for x in found])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            yield batch.slice(i, ROWS)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", drop: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``docs`` with the ids of their whole texts, an array of int, without
    begin or end ids. ``path`` is the model's, readable on every executor. Null and empty
    texts have no ids; repeated rows stay. Other columns pass through unless dropped; a
    column named as ``ids`` is replaced."""
    stay = [f for f in docs.schema.fields if f.name not in (*drop, ids)]
    schema = T.StructType([*stay, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            found, stops = encode_texts([t or "" for t in part.column(text).to_pylist()], path)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], stops]), pa.int32()), pa.array(found, pa.int32())
            )
            yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in stay), lists], schema.names)

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded", drop: tuple[str, ...] = ()) -> DataFrame:
    """The rows with the text that the library's decode gives for their ids; '' for null
    or no ids. Other columns pass through unless dropped."""
    stay = [f for f in rows.schema.fields if f.name not in (*drop, text)]
    schema = T.StructType([*stay, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = processor(path)
        for part in _slices(batches):
            texts = model.decode([x or [] for x in part.column(ids).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*(part.column(f.name) for f in stay), pa.array(texts, pa.string())], schema.names
            )

    return rows.mapInArrow(run, schema)
