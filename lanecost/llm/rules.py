"""Quality rules: base measures of words and lines, and perplexity bands.

The grams of all documents are counted by Spark into a modified Kneser-Ney model, stored
as sorted hash arrays in a written table. A document whose perplexity lies outside its
language's band, above or below, is rejected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanecost.llm import ngrams
from lanecost.llm.common import few, fresh, written
from lanecost.llm.quality import smoothed
from lanecost.llm.words import SPACES, in_repeats, word_ids

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

BELOW, ABOVE = 4.0, 5.0
"""The band reaches this many times the distance from the median to the lower and to the
upper quartile. On the labels of sf0.1 these are the last whole widths at which a step
inwards still rejected more bad texts than good ones."""
ARRAY_GRAMS = 50_000
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measures(texts: list[str]) -> list[pa.Array]:
    """The base measures of whole texts, as columns in the order of ``MEASURES``."""
    out = np.zeros((len(MEASURES), len(texts)), dtype=np.int64)
    for i, text in enumerate(texts):
        data = text.encode()
        ids, distinct = word_ids(data)
        lines = [line for line in data.split(b"\n") if line.strip()]
        out[:, i] = (
            len(ids),
            len(text) - sum(map(text.count, SPACES)),
            sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)),
            in_repeats(ids, len(distinct)),
        )
    return [pa.array(x, pa.int64()) for x in out]


def hash_arrays(scores: DataFrame) -> DataFrame:
    """The model as stored: language, shard, grams and scores, one row per shard of a
    language with its grams in ascending order beside their scores. A gram packs its
    four symbols in 64 bits, a hash without collisions; shards are dealt by a second
    hash and bounded in size."""
    shards = max(1, -(-scores.count() // ARRAY_GRAMS))
    dealt = scores.withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards)))

    def sort(part: pa.Table) -> pa.Table:
        keys, values = np.asarray(part.column("gram")), np.asarray(part.column("score"), dtype=np.float32)
        by = np.argsort(keys)
        return pa.table({
            "language": part.column("language").slice(0, 1),
            "shard": part.column("shard").slice(0, 1),
            "grams": pa.array([keys[by].tobytes()], pa.binary()),
            "scores": pa.array([values[by].astype(np.float32).tobytes()], pa.binary()),
        })

    kinds = "language string, shard long, grams binary, scores binary"
    return written(dealt.groupBy("language", "shard").applyInArrow(sort, kinds), "hash-arrays")


def loaded(arrays: DataFrame) -> ngrams.Arrays:
    """A stored model of bounded size, one sorted array for each language."""
    parts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for row in arrays.collect():
        pair = (np.frombuffer(row["grams"], np.int64), np.frombuffer(row["scores"], np.float32))
        parts.setdefault(row["language"], []).append(pair)
    out = {}
    for name, found in parts.items():
        keys, values = (np.concatenate(x) for x in zip(*found, strict=True))
        by = np.argsort(keys)
        out[name] = (keys[by], values[by])
    return out


def judged(
    docs: DataFrame,
    text: str = "text",
    language: str = "lang",
    drop: tuple[str, ...] = (),
    prefix: str = "",
    broadcast_grams: int = ngrams.BROADCAST_GRAMS,
) -> DataFrame:
    """The rows of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, log_perplexity (per symbol, smoothed), low, high, kept.

    Base rules fail a text of fewer than 50 words, or with more than half of its words
    in repeated windows of three. Of the others, those outside low..high are rejected:
    the language's median minus ``BELOW`` times the distance to the lower quartile, and
    plus ``ABOVE`` times that to the upper one, over all documents that pass the base
    rules. The model learns every distinct text once. Null and empty texts
    have no words and fail. A null language is one named ''. Repeated rows are judged
    alike; an empty table gives an empty table; other columns pass through, but for those
    named like the new ones. ``prefix`` goes before the names of the new columns.
    """
    own = {n: f"{prefix}{n}" for n in (*MEASURES, "base_failed", "log_perplexity", "low", "high", "kept")}
    docs = docs.drop(*own.values())
    # Copies teach the model once, or a text that is repeated often would look usual.
    texts = docs.select(text, language).distinct()
    counts = written(ngrams.gram_counts(texts, text, language, F.lit(True)), "grams")
    scores = written(ngrams.gram_scores(counts), "scores")
    raw, symbols = fresh(docs, "raw_score"), fresh(docs, "symbols")
    data = docs.withColumn(symbols, F.length(text) + 1)
    found = ngrams.scored(
        data, scores, text, language, raw,
        extra=measures, extra_fields=[T.StructField(own[n], T.LongType()) for n in MEASURES],
        drop=drop, broadcast_grams=broadcast_grams, load=lambda s: loaded(hash_arrays(s)),
    )
    failed = (F.col(own["n_words"]) < LEAST_WORDS) | (
        100 * F.col(own["n_repeat_words"]) > MOST_REPEATED_PERCENT * F.col(own["n_words"])
    )
    found = written(found.withColumn(own["base_failed"], failed), "measured")

    named = fresh(found, "spoken")
    rows = found.withColumn(named, F.coalesce(F.col(language).cast("string"), F.lit("")))
    passed = ~F.col(own["base_failed"])
    half = fresh(found, "middle")
    middle = ngrams.quantiles(rows.where(passed), named, raw, {half: 0.5}).select(named, half)
    rows = rows.join(few(written(middle, "medians")), named, "left")
    value = smoothed(F.col(raw), F.col(symbols), F.coalesce(F.col(half), F.col(raw)))
    rows = rows.withColumn(own["log_perplexity"], value)
    cuts = {"_q1": 0.25, "_q2": 0.5, "_q3": 0.75}
    bands = ngrams.quantiles(rows.where(passed), named, own["log_perplexity"], cuts).select(
        named,
        (F.col("_q2") - BELOW * F.greatest(F.col("_q2") - F.col("_q1"), F.lit(0.01))).alias(own["low"]),
        (F.col("_q2") + ABOVE * F.greatest(F.col("_q3") - F.col("_q2"), F.lit(0.01))).alias(own["high"]),
    )
    rows = rows.join(few(written(bands, "bands")), named, "left")
    inside = F.col(own["log_perplexity"]).between(F.col(own["low"]), F.col(own["high"]))
    rows = rows.withColumn(own["kept"], passed & F.coalesce(inside, F.lit(True)))
    return rows.select(*(c for c in docs.columns if c not in drop), *own.values())


def keep(docs: DataFrame, **options: object) -> DataFrame:
    """The documents that are kept, with their own columns."""
    prefix = "r_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    return judged(docs, prefix=prefix, **options).where(F.col(f"{prefix}kept")).select(*docs.columns)
