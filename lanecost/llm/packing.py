"""Length buckets with the least padding, and batches of a token budget inside them.

Lengths are counted into one histogram; dynamic programming over it chooses where the
buckets end so that the padding of all rows to their bucket's end is smallest. Rows of
a bucket then form batches of as many rows as the token budget holds at that length.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanecost.llm.common import numbered, utf8, written

FINE = 9
"""Lengths below 2^FINE are bins of their own; above, every octave has 2^(FINE-1) bins."""


def length_bin(length: Column) -> Column:
    """The bin of a length from 1 on. There are at most 2^(FINE-1) * 55 bins, whatever
    the lengths are, and inside one lengths differ by less than 1 part in 2^(FINE-1)."""
    octave = F.greatest(F.length(F.bin(length)) - FINE, F.lit(0))
    return octave.cast("long") * (1 << 40) + F.call_function("shiftright", length, octave)


def bucket_ends(ends: np.ndarray, rows: np.ndarray, tokens: np.ndarray, buckets: int) -> list[int]:
    """Where at most ``buckets`` buckets end, smallest padding first, then fewest buckets.

    ``ends`` ascending: the longest length of each bin; ``rows`` and ``tokens``: rows
    and sum of lengths in it. Cost of bins i..j in one bucket: ends[j] times their rows,
    less their tokens. The cost obeys the quadrangle inequality, so the best cut moves
    one way only and each layer is solved by divide and conquer, O(n log n).
    """
    n = len(ends)
    if n == 0:
        return []
    r = np.concatenate([[0], np.cumsum(rows)]).astype(object if rows.sum() * int(ends[-1]) > 1 << 62 else np.int64)
    t = np.concatenate([[0], np.cumsum(tokens)]).astype(r.dtype)
    e = ends.astype(r.dtype)
    best = e * r[1:] - t[1:]
    layers: list[np.ndarray] = []
    for _ in range(min(buckets, n) - 1):
        if best[-1] == 0:
            break
        nxt, cut = best.copy(), np.zeros(n, dtype=np.int64)
        todo = [(1, n - 1, 1, n - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            mid = (low + high) // 2
            starts = np.arange(first, min(mid, last) + 1)
            cost = best[starts - 1] + e[mid] * (r[mid + 1] - r[starts]) - (t[mid + 1] - t[starts])
            at = int(np.argmin(cost))
            if cost[at] < nxt[mid]:
                nxt[mid], cut[mid] = cost[at], starts[at]
            todo += [(low, mid - 1, first, int(starts[at])), (mid + 1, high, int(starts[at]), last)]
        if nxt[-1] >= best[-1]:
            break
        best = nxt
        layers.append(cut)
    out, at = [], n - 1
    for cut in reversed(layers):
        out.append(int(ends[at]))
        if cut[at] == 0:
            return out[::-1]
        at = int(cut[at]) - 1
    out.append(int(ends[at]))
    return out[::-1]


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    length: Column | None = None,
    text: str = "text",
    buckets: int = 16,
    budget: int = 65_536,
    rows_per_chunk: int = 5_000,
) -> DataFrame:
    """One row per input row: key, n_tokens, bucket, bucket_length, batch, slot, padding.

    ``length`` counts a row's tokens, at least 1; by default bytes of the text in UTF-8
    plus an end token, so null and empty texts have 1. A bucket's batches hold
    ``budget // bucket_length`` rows each and their slots run from 0; a row longer than
    the budget is a batch of its own. Nothing is cut or left out: the last bucket ends
    at the longest row. An empty table gives an empty table. Only key and length are
    read, once: what follows works on a narrow written table. The histogram has a bounded number of
    bins (see ``length_bin``), which is what the driver reads.
    """
    if length is None:
        length = F.octet_length(utf8(F.col(text))) + 1
    rows = written(
        docs.select(key, F.greatest(length.cast("long"), F.lit(1).cast("long")).alias("n_tokens")), "lengths"
    )
    histogram = (
        rows.groupBy(length_bin(F.col("n_tokens")).alias("bin"))
        .agg(F.max("n_tokens").alias("end"), F.count("*").alias("rows"), F.sum("n_tokens").alias("tokens"))
        .collect()
    )
    histogram.sort(key=lambda x: x["end"])
    ends = bucket_ends(*(np.array([x[c] for x in histogram], dtype=np.int64) for c in ("end", "rows", "tokens")), buckets)
    bounds = F.array(*(F.lit(x).cast("long") for x in ends or [1]))
    bucket = F.size(F.filter(bounds, lambda b: b < F.col("n_tokens"))).cast("int")
    rows = rows.withColumn("bucket", F.least(bucket, F.lit(max(0, len(ends) - 1))))
    rows = rows.withColumn("bucket_length", F.element_at(bounds, F.col("bucket") + 1))
    rows = numbered(rows, "bucket", [key, "n_tokens"], "_place", rows_per_chunk)
    fit = F.greatest(F.floor(F.lit(budget) / F.col("bucket_length")), F.lit(1)).cast("long")
    return rows.select(
        key,
        "n_tokens",
        "bucket",
        "bucket_length",
        F.floor(F.col("_place") / fit).cast("long").alias("batch"),
        F.pmod(F.col("_place"), fit).cast("int").alias("slot"),
        (F.col("bucket_length") - F.col("n_tokens")).alias("padding"),
    )
