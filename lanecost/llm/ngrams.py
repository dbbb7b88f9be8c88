"""Modified Kneser-Ney models of code points, counted and joined by Spark.

A gram is four code points packed in a long, 16 bits each, the last one lowest; code
points beyond the 16-bit plane share one symbol. Texts are padded in front, so every
code point and the end are predicted once. Only grams are gathered from the corpus, at
most one row per task, language and distinct gram; lower orders and discounts follow
from these. Counts cover whole texts of all rows given.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanecost.llm.common import few, written

ORDER = 4
PAD, END, OTHER = 2, 3, 0xFFFF
CHARS = 2_000_000
"""Code points taken at a time; bounds a worker's memory."""
HELD = 3_000_000
"""Distinct grams a task holds before it passes on what it has."""
BROADCAST_GRAMS = 4_000_000
"""Scores are broadcast up to so many grams (12 bytes each) and joined by blocks beyond."""
BLOCK_BYTES = 32 << 20
_CONTROLS = {PAD: 1, END: 1}


def pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams of the texts and the index of the text each is from, a piece at a time;
    every gram once. An empty text has none."""
    chars: list[np.ndarray] = []
    owner: list[int] = []
    held = 0
    for i, text in enumerate(texts):
        for at in range(0, len(text), CHARS):
            front = text[max(0, at - 3) : at]
            last = at + CHARS >= len(text)
            part = (front + text[at : at + CHARS]).translate(_CONTROLS)
            codes = np.frombuffer(part.encode("utf-32-le", "replace"), dtype=np.uint32)
            pads = [PAD] * (3 - len(front))
            chars.append(np.concatenate([np.array(pads, np.uint32), codes, np.array([END] * last, np.uint32)]))
            owner.append(i)
            held += len(codes)
            if held >= CHARS:
                yield _packed(chars, owner)
                chars, owner, held = [], [], 0
    if chars:
        yield _packed(chars, owner)


def _packed(chars: list[np.ndarray], owner: list[int]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(c) for c in chars])
    symbols = np.minimum(np.concatenate(chars), OTHER).astype(np.int64)
    of = np.repeat(np.array(owner), np.maximum(lengths - 3, 0))
    gram = symbols[:-3] << 48 | symbols[1:-2] << 32 | symbols[2:-1] << 16 | symbols[3:]
    inner = np.ones(len(gram), dtype=bool)  # not across two texts
    for stop in np.cumsum(lengths)[:-1]:
        inner[max(0, stop - 3) : stop] = False
    return gram[inner], of


def _strings(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def _by_language(languages: list[str]) -> Iterator[tuple[str, np.ndarray]]:
    names, codes = np.unique(np.array(languages, dtype=object).astype(str), return_inverse=True)
    for k, name in enumerate(names):
        yield str(name), np.flatnonzero(codes == k)


def gram_counts(docs: DataFrame, text: str, language: str, learn: Column) -> DataFrame:
    """language, gram, n: every gram of the texts with its number in the rows where
    ``learn`` holds, 0 if it is only elsewhere. A null language counts as ''."""
    rows = docs.select(
        F.col(text).alias("text"),
        F.coalesce(F.col(language).cast("string"), F.lit("")).alias("language"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            sums = np.bincount(at, weights=np.concatenate([n for _, n in parts]), minlength=len(keys))
            return keys, sums.astype(np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                keys, sums = merged(parts)
                for i in range(0, len(keys), 100_000):
                    k, n = keys[i : i + 100_000], sums[i : i + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(k), pa.string()), pa.array(k, pa.int64()), pa.array(n, pa.int64())],
                        ["language", "gram", "n"],
                    )
            held.clear()

        for batch in batches:
            texts = _strings(batch.column(0))
            learned = np.array(batch.column(2).to_pylist(), dtype=bool)
            for name, rows_of in _by_language(_strings(batch.column(1))):
                for use in (True, False):
                    chosen = [texts[i] for i in rows_of if learned[i] == use]
                    for gram, _ in pieces(chosen):
                        keys, n = np.unique(gram, return_counts=True)
                        parts = held.setdefault(name, [])
                        parts.append((keys, n * use))
                        if len(parts) >= 8:
                            held[name] = [merged(parts)]
            if sum(len(k) for parts in held.values() for k, _ in parts) > HELD:
                yield from out()
        yield from out()

    found = rows.mapInArrow(count, "language string, gram long, n long")
    return found.groupBy("language", "gram").agg(F.sum("n").alias("n"))


def _suffix(gram: Column, symbols: int) -> Column:
    return gram.bitwiseAND((1 << 16 * symbols) - 1)


def _discounts(learned: list[DataFrame]) -> DataFrame:
    """language, order, symbols and the discounts d1, d2, d3 of counts 1, 2 and more,
    by the counts of counts. Where one of these is missing, a usual value stands in."""
    n = [F.sum(F.when(F.col("n") == i, 1).otherwise(0)).alias(f"n{i}") for i in (1, 2, 3, 4)]
    parts = [
        x.groupBy("language").agg(*n, F.count("*").alias("symbols")).withColumn("order", F.lit(ORDER - i))
        for i, x in enumerate(learned)
    ]
    share = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1))

    def discount(i: int) -> Column:
        here, more = F.col(f"n{i}"), F.col(f"n{i + 1}")
        found = i - (i + 1) * share * more / F.when(here > 0, here)
        bounded = F.least(F.greatest(found, F.lit(0.05)), F.lit(float(i)))
        return F.when((F.col("n1") > 0) & (here > 0), bounded).otherwise(F.lit(0.25 + 0.25 * i))

    found = reduce(DataFrame.unionByName, parts)
    return found.select("language", "order", "symbols", *(discount(i).alias(f"d{i}") for i in (1, 2, 3)))


def gram_scores(counts: DataFrame) -> DataFrame:
    """language, gram, score: the natural logarithm of the interpolated probability of
    the last symbol of every gram in ``counts`` after the three before it.

    Learned are the grams with n > 0. Lower orders count distinct left neighbours. Each
    order is a table of its own, written, so that no plan spans them all.
    """
    tables = [counts.select("language", "gram", "n")]
    for order in range(ORDER - 1, 0, -1):
        shorter = tables[-1].groupBy("language", _suffix(F.col("gram"), order).alias("gram"))
        tables.append(written(shorter.agg(F.count_if(F.col("n") > 0).alias("n")), "shorter-grams"))
    facts = few(written(_discounts([t.where(F.col("n") > 0) for t in tables]), "discounts"))
    symbols = facts.where(F.col("order") == 1).select("language", (F.col("symbols") + 1).alias("symbols"))
    lower = (
        tables[-1]
        .join(symbols, "language", "left")
        .select("language", "gram", (F.lit(1.0) / F.coalesce("symbols", F.lit(65_536))).alias("p"))
    )
    for order in range(1, ORDER + 1):
        of = facts.where(F.col("order") == order).drop("order", "symbols")
        d = F.when(F.col("n") == 0, 0.0).when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2"))
        shorter = _suffix(F.col("gram"), order - 1) if order > 1 else F.col("gram")
        context = F.shiftrightunsigned(F.col("gram"), 16)
        rows = (
            tables[ORDER - order]
            .join(of, "language", "left")
            .select("language", "gram", "n", d.otherwise(F.col("d3")).alias("d"), context.alias("context"), shorter.alias("shorter"))
        )
        contexts = (
            rows.where(F.col("n") > 0)
            .groupBy("language", "context")
            .agg(F.sum("n").cast("double").alias("total"), F.sum("d").alias("spare"))
        )
        below = lower.select("language", F.col("gram").alias("shorter"), F.col("p").alias("below"))
        p = F.when(
            F.col("total").isNotNull(), (F.col("n") - F.col("d") + F.col("spare") * F.col("below")) / F.col("total")
        ).otherwise(F.col("below"))
        lower = (
            rows.join(below, ["language", "shorter"])
            .join(contexts, ["language", "context"], "left")
            .select("language", "gram", p.alias("p"))
        )
        if order < ORDER:
            lower = written(lower, "probabilities")
    return lower.select("language", "gram", F.log(F.greatest("p", F.lit(1e-300))).alias("score"))


Arrays = dict[str, tuple[np.ndarray, np.ndarray]]
"""By language: grams in ascending order, and the score of each."""


class Scores:
    def __init__(self, arrays: Arrays) -> None:
        self.arrays = arrays

    def sums(self, texts: list[str], languages: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sum of scores and number of predicted symbols of each text."""
        total, number = np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64)
        for name, rows in _by_language(languages):
            keys, scores = self.arrays.get(name, (np.zeros(0, np.int64), np.zeros(0)))
            for gram, of in pieces([texts[i] for i in rows]):
                if len(keys) == 0:
                    continue
                found, at = np.unique(gram, return_inverse=True)
                value = scores[np.minimum(np.searchsorted(keys, found), len(keys) - 1)]
                total[rows] += np.bincount(of, weights=value[at], minlength=len(rows))
                number[rows] += np.bincount(of, minlength=len(rows))
        return total, number


def sorted_arrays(scores: DataFrame) -> Arrays:
    """A bounded score table as sorted arrays by language."""
    got = scores.toArrow()
    names = got.column("language").combine_chunks().dictionary_encode()
    codes, keys, values = (
        np.asarray(names.indices),
        np.asarray(got.column("gram").combine_chunks()),
        np.asarray(got.column("score").combine_chunks(), dtype=np.float32),
    )
    out = {}
    for k, name in enumerate(names.dictionary.to_pylist()):
        own = codes == k
        by = np.argsort(keys[own])
        out[name] = (keys[own][by], values[own][by].astype(np.float32))
    return out


Extra = Callable[[list[str]], list[pa.Array]]


def scored(
    docs: DataFrame,
    scores: DataFrame,
    text: str,
    language: str,
    log_perplexity: str,
    extra: Extra | None = None,
    extra_fields: list[T.StructField] | None = None,
    drop: tuple[str, ...] = (),
    broadcast_grams: int = BROADCAST_GRAMS,
    load: Callable[[DataFrame], Arrays] | None = None,
) -> DataFrame:
    """The rows of ``docs`` and the mean negative score of each text's symbols, null
    for a text without symbols or in a language of which no gram is known.

    Up to ``broadcast_grams`` grams the sorted arrays go to every executor. Beyond, rows
    are dealt into blocks, each block asks the score table for its own grams only, and
    the answer meets the block's rows in one task. Both give the same values. ``extra``
    adds columns made from the texts in the same pass; ``drop`` leaves columns out.
    """
    kept = [f for f in docs.schema.fields if f.name not in drop]
    fields = [*kept, T.StructField(log_perplexity, T.DoubleType()), *(extra_fields or [])]
    schema = T.StructType(fields)
    stay = [f.name for f in kept]

    def with_scores(batch: pa.Table | pa.RecordBatch, model: Scores) -> list[pa.Array]:
        texts, languages = _strings(batch.column(text)), _strings(batch.column(language).cast(pa.string()))
        total, number = model.sums(texts, languages)
        mean = np.divide(-total, number, out=np.zeros(len(texts)), where=number > 0)
        values = pa.array(mean, pa.float64(), mask=number == 0)
        return [*(batch.column(c) for c in stay), values, *(extra(texts) if extra else [])]

    if scores.count() <= broadcast_grams:
        model = docs.sparkSession.sparkContext.broadcast((load or sorted_arrays)(scores))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = Scores(model.value)
            for batch in batches:
                for i in range(0, batch.num_rows, 2_000):
                    part = batch.slice(i, 2_000)
                    yield pa.RecordBatch.from_arrays(with_scores(part, found), schema.names)

        return docs.mapInArrow(score, schema)

    size = docs.agg(F.sum(F.octet_length(text))).head()[0] or 0
    blocks = max(1, size // BLOCK_BYTES)
    whole = F.struct(*(F.col(c) for c in docs.columns)).alias("row")
    dealt = docs.select(F.pmod(F.xxhash64(text, F.rand(7)), F.lit(blocks)).alias("block"), whole)
    dealt = written(dealt, "blocks")

    def ask(part: pa.Table) -> pa.Table:
        rows = pa.Table.from_batches([pa.RecordBatch.from_struct_array(c) for c in part.column("row").chunks])
        texts, languages = _strings(rows.column(text)), _strings(rows.column(language).cast(pa.string()))
        block = part.column("block")[0].as_py()
        out: list[tuple[str, np.ndarray]] = []
        for name, of in _by_language(languages):
            found = [np.unique(g) for g, _ in pieces([texts[i] for i in of])]
            out.append((name, reduce(np.union1d, found, np.zeros(0, np.int64))))
        names = [name for name, k in out for _ in range(len(k))]
        keys = np.concatenate([k for _, k in out]) if out else np.zeros(0, np.int64)
        return pa.table({
            "block": pa.array(np.full(len(keys), block), pa.int64()),
            "language": pa.array(names, pa.string()),
            "gram": pa.array(keys, pa.int64()),
        })

    asked = dealt.groupBy("block").applyInArrow(ask, "block long, language string, gram long")
    answers = asked.join(scores, ["language", "gram"]).select("block", "language", "gram", "score")

    def answer(part: pa.Table, known: pa.Table) -> pa.Table:
        rows = pa.Table.from_batches([pa.RecordBatch.from_struct_array(c) for c in part.column("row").chunks])
        arrays = {}
        names = np.array(known.column("language").to_pylist(), dtype=object)
        keys, values = np.asarray(known.column("gram")), np.asarray(known.column("score"))
        for name in set(names):
            own = names == name
            by = np.argsort(keys[own])
            arrays[name] = (keys[own][by], values[own][by].astype(np.float32))
        columns = with_scores(rows.combine_chunks(), Scores(arrays))
        return pa.Table.from_arrays(columns, names=schema.names)

    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(answer, schema)


def quantiles(rows: DataFrame, group: str, value: str, shares: dict[str, float], step: float = 0.001) -> DataFrame:
    """group, n and, for each name, the smallest multiple of ``step`` that at least
    that share of the group's values do not exceed. Values are counted in steps first,
    so a group of any size is a bounded number of rows. Nulls are left out."""
    bins = (
        rows.where(F.col(value).isNotNull())
        .groupBy(group, F.ceil(F.col(value) / step).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    upto = Window.partitionBy(group).orderBy("bin")
    all_of = Window.partitionBy(group)
    summed = bins.select(group, "bin", "n", F.sum("n").over(upto).alias("upto"), F.sum("n").over(all_of).alias("all"))
    at = [
        (F.min(F.when(F.col("upto") >= F.col("all") * share, F.col("bin"))) * step).alias(name)
        for name, share in shares.items()
    ]
    return summed.groupBy(group).agg(F.max("all").alias("n"), *at)
