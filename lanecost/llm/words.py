"""Words of UTF-8 texts, for tasks: runs of bytes other than the six ASCII spaces."""

from __future__ import annotations

from collections import defaultdict

import numpy as np

SPACES = " \t\n\x0b\x0c\r"
PIECE = 4 << 20


def word_ids(data: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The number of each word, in order, and the distinct words by number. A long text
    is split a piece at a time, so only its distinct words are held as objects."""
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    parts = []
    at = 0
    while at < len(data):
        stop = at + PIECE
        if stop < len(data):
            ends = [data.find(s.encode(), stop) for s in SPACES]
            stop = min((e for e in ends if e >= 0), default=len(data))
        words = data[at:stop].split()
        parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        at = stop
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), list(known)


def in_repeats(ids: np.ndarray, distinct: int) -> int:
    """Words in windows of three words that occur twice or more."""
    if len(ids) < 4:
        return 0
    pair = ids[:-2] * distinct + ids[1:-1]
    if distinct**3 >= 1 << 62:
        pair = np.unique(pair, return_inverse=True)[1]
    _, window, n = np.unique(pair * distinct + ids[2:], return_inverse=True, return_counts=True)
    often = n[window] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(often)] |= often
    return int(covered.sum())
