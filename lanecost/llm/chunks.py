"""A table of distinct chunks, for tasks: each is segmented once, and ids are put back
by position."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

Segment = Callable[[list[str]], tuple[np.ndarray, np.ndarray, np.ndarray]]
"""Of distinct chunks: ids, where each chunk's start, how many."""

MOST_CHUNKS = 1_000_000
"""A table of more distinct chunks is trimmed before the next texts; bounds a worker's memory."""
MOST_BYTES = 64 << 20
"""So is a table of Arrow chunks of more bytes."""


class _Numbers(dict):
    """Numbers strings as they are asked for first; lists the ones not seen before."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.new.append(key)
        return number


class ChunkTable:
    """``segment`` gives the ids of distinct chunks."""

    def __init__(self, segment: Segment, most: int = MOST_CHUNKS) -> None:
        self._segment, self._most = segment, most
        self._numbers = _Numbers()
        self._starts = np.zeros(0, np.int64)
        self._lengths = np.zeros(0, np.int64)
        self._seen = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.int32)

    def _trim(self) -> None:
        """Keep the chunks seen most often, at most half as many as there may be, of
        those seen twice."""
        often = np.flatnonzero(self._seen > 1)
        if len(often) > self._most // 2:
            often = np.sort(often[np.argsort(-self._seen[often], kind="stable")[: self._most // 2]])
        chunks = list(self._numbers)
        self._numbers = _Numbers()
        for i in often:
            self._numbers[chunks[i]] = len(self._numbers)
        self._ids, stops = self._gathered(often, np.ones(len(often), np.int64))
        self._lengths = self._lengths[often]
        self._starts = stops - self._lengths
        self._seen = self._seen[often] // 2

    def _numbered(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all chunks, and how many each text has."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        at = np.fromiter(map(self._numbers.__getitem__, chain.from_iterable(texts)), np.int64, int(sizes.sum()))
        self._learn()
        return at, sizes

    def _learn(self) -> None:
        """Segment the chunks that were asked for first since the last time."""
        new, self._numbers.new = self._numbers.new, []
        if new:
            ids, starts, lengths = self._segment(new)
            self._starts = np.concatenate([self._starts, len(self._ids) + starts])
            self._lengths = np.concatenate([self._lengths, lengths])
            self._ids = np.concatenate([self._ids, ids])
            self._seen = np.concatenate([self._seen, np.zeros(len(new), np.int64)])

    def _gathered(self, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self._lengths[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        shift = np.repeat(self._starts[at] - (ends - lengths), lengths)
        stops = np.concatenate([[0], ends])[np.cumsum(sizes)]
        return self._ids[np.arange(total) + shift], stops

    def ids(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, given as their chunks, and where each text's end."""
        if len(self._numbers) > self._most:
            self._trim()
        at, sizes = self._numbered(texts)
        self._seen += np.bincount(at, minlength=len(self._seen))
        return self._gathered(at, sizes)


class ArrowTable:
    """The same for chunks that Arrow holds, which never become Python's strings.
    ``segment`` gives the ids of distinct chunks, one chunk after another, and how many
    each has."""

    def __init__(self, segment: Callable[[pa.StringArray], tuple[np.ndarray, np.ndarray]], most: int = MOST_CHUNKS) -> None:
        self._segment, self._most = segment, most
        self._chunks = pa.array([], pa.string())
        self._stops = np.zeros(1, np.int64)
        self._seen = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.int32)

    def _trim(self) -> None:
        """Keep the chunks seen most often, at most half of the bounds, of those seen twice."""
        often = np.flatnonzero(self._seen > 1)
        often = often[np.argsort(-self._seen[often], kind="stable")[: self._most // 2]]
        sizes = pc.binary_length(self._chunks.take(pa.array(often))).to_numpy(zero_copy_only=False)
        often = np.sort(often[np.cumsum(sizes, dtype=np.int64) <= MOST_BYTES // 2])
        self._ids, stops = self._gathered(often)
        self._stops = np.concatenate([[0], stops])
        self._chunks, self._seen = self._chunks.take(pa.array(often)), self._seen[often] // 2

    def _numbered(self, distinct: pa.StringArray) -> np.ndarray:
        """The numbers of distinct chunks; those not seen before are segmented."""
        known = pc.index_in(distinct, value_set=self._chunks)
        numbers = pc.fill_null(known, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        if known.null_count:
            new = distinct.filter(known.is_null())
            numbers[numbers < 0] = len(self._chunks) + np.arange(len(new))
            ids, lengths = self._segment(new)
            self._stops = np.concatenate([self._stops, self._stops[-1] + np.cumsum(lengths)])
            self._ids = np.concatenate([self._ids, ids])
            self._seen = np.concatenate([self._seen, np.zeros(len(new), np.int64)])
            self._chunks = pa.concat_arrays([self._chunks, new])
        return numbers

    def _gathered(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks by number, and where each chunk's end."""
        starts = self._stops[at]
        lengths = self._stops[at + 1] - starts
        ends = np.cumsum(lengths)
        where = np.repeat(starts - ends + lengths, lengths)
        where += np.arange(len(where))
        return self._ids[where], ends

    def ids(self, chunks: pa.StringArray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, given as the chunks of all of them and where each text's
        end, and where each text's ids end."""
        if len(self._chunks) > self._most or self._chunks.nbytes > MOST_BYTES:
            self._trim()
        coded = chunks.dictionary_encode()
        numbers, at = self._numbered(coded.dictionary), np.asarray(coded.indices)
        self._seen[numbers] += np.bincount(at, minlength=len(numbers))
        ids, ends = self._gathered(numbers[at])
        return ids, np.concatenate([[0], ends])[stops]
