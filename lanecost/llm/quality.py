"""Quality classifier: perplexity under a model of trusted text.

An interpolated modified Kneser-Ney model of code points is trained, per language, on
all documents whose label is good. Grams of all documents are joined with its counts,
and a document is rejected when its perplexity is far above what the trusted documents
of its language have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanecost.llm import ngrams
from lanecost.llm.common import few, fresh, written

PRIOR = 400
"""Symbols at the language's median that are added to every text before judging: a
text of a few words is judged by few observations and drawn to the middle."""
SHARE = 0.75
SLACK = 12.0
LEAST_SPREAD = 0.015
"""A threshold is no nearer to the median than ``SLACK`` times this, however alike the
few held-out texts of a language are."""
FOLDS = 5
"""One in so many trusted texts of a language, at least one, is not learned from:
thresholds come from these, as the texts that are to be judged were not learned from
either."""
_BINS = 100_000
TRUSTED_IDS = 2_000_000
"""Trusted ids are broadcast up to so many (8 bytes each) and joined beyond."""


def smoothed(log_perplexity: Column, symbols: Column, middle: Column) -> Column:
    return (log_perplexity * symbols + middle * PRIOR) / (symbols + PRIOR)


def trusted_ids(labels: DataFrame, key: str, label: str) -> DataFrame:
    """Keys of which every label is 1. Null keys and labels count for nothing."""
    rows = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    return rows.groupBy(F.col(key).alias("_trusted")).agg(F.min(label).alias("_least")).where("_least = 1").select("_trusted")


def _folds(trusted: DataFrame, language: str, number: str) -> DataFrame:
    """By language: the last of the numbers that are held out, so that one in ``FOLDS``
    distinct ones is, and the first that is learned from: the next, or the same if there
    is no other. At most ``_BINS`` numbers of a language are looked at."""
    numbers = trusted.select(language, number).distinct()
    cut = ngrams.quantiles(numbers, language, number, {"_last_held": 1 / FOLDS}, step=1).select(language, "_last_held")
    later = numbers.join(cut, language).groupBy(language, "_last_held")
    after = F.min(F.when(F.col(number) > F.col("_last_held"), F.col(number)))
    return later.agg(F.coalesce(after, F.max(number)).alias("_first_learned"))


def judged(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    label: str = "quality",
    drop: tuple[str, ...] = (),
    names: tuple[str, str, str] = ("log_perplexity", "threshold", "kept"),
    broadcast_grams: int = ngrams.BROADCAST_GRAMS,
) -> DataFrame:
    """The rows of ``docs`` with log_perplexity (per symbol, smoothed), threshold and kept.

    A language's threshold is the median log perplexity of its trusted documents that
    were held out, plus ``SLACK`` times the distance to their ``SHARE`` quantile. Copies of
    a text are held out together, and the distance is at least ``LEAST_SPREAD``. Where all
    trusted documents of a language are copies of one text, this is learned from and held
    against as well. A document is kept if it does not exceed the threshold. Null and empty texts have no perplexity and are not kept. A null language
    is one named ''; documents of a language without trusted text are not judged: kept,
    threshold null. So are all, without labels. Repeated rows are judged alike; a
    repeated key is trusted if none of its labels is bad. Other columns pass through,
    but for those named like the new ones.
    """
    docs = docs.drop(*names)
    marked, named_id = fresh(docs, "trusted"), fresh(docs, "trusted_id")
    ids = few(trusted_ids(labels, key, label).select(F.col("_trusted").alias(named_id)), TRUSTED_IDS)
    data = docs.join(ids, docs[key] == ids[named_id], "left").withColumn(marked, F.col(named_id).isNotNull())
    held, learned, own, bin_of = (fresh(docs, c) for c in ("held_out", "learned", "own_language", "bin"))
    data = data.drop(named_id).withColumn(own, F.coalesce(F.col(language).cast("string"), F.lit("")))
    data = data.withColumn(bin_of, F.pmod(F.xxhash64(text, F.lit(11)), F.lit(_BINS)))
    fold = _folds(data.where(F.col(marked) & F.col(text).isNotNull()), own, bin_of)
    data = data.join(few(written(fold, "folds")), own, "left").withColumns(
        {
            held: F.col(marked) & F.coalesce(F.col(bin_of) <= F.col("_last_held"), F.lit(False)),
            learned: F.col(marked) & F.coalesce(F.col(bin_of) >= F.col("_first_learned"), F.lit(False)),
        }
    )
    data = data.drop(own, bin_of, "_last_held", "_first_learned", marked)
    counts = written(ngrams.gram_counts(data, text, language, F.col(learned)), "grams")
    scores = written(ngrams.gram_scores(counts), "scores")
    known = written(counts.where(F.col("n") > 0).select(F.col("language").alias("_known")).distinct(), "languages")
    raw = fresh(data, "raw_score")
    symbols = fresh(data, "symbols")
    data = data.withColumn(symbols, F.length(text) + 1)
    found = ngrams.scored(data, scores, text, language, raw, drop=drop, broadcast_grams=broadcast_grams)
    found = written(found, "judged")

    spoken = F.coalesce(F.col(language).cast("string"), F.lit(""))
    named = fresh(found, "spoken")
    rows = found.withColumn(named, spoken)
    half = fresh(found, "middle")
    middle = ngrams.quantiles(rows.where(F.col(held)), named, raw, {half: 0.5}).select(named, half)
    rows = rows.join(few(written(middle, "medians")), named, "left")
    value = smoothed(F.col(raw), F.col(symbols), F.coalesce(F.col(half), F.col(raw)))
    log_perplexity, threshold, kept = names
    rows = rows.withColumn(log_perplexity, value)
    limits = ngrams.quantiles(rows.where(F.col(held)), named, log_perplexity, {"_half": 0.5, "_most": SHARE})
    limits = limits.join(known, limits[named] == known["_known"]).select(
        named, (F.col("_half") + SLACK * F.greatest(F.col("_most") - F.col("_half"), F.lit(LEAST_SPREAD))).alias(threshold)
    )
    rows = rows.join(few(written(limits, "thresholds")), named, "left")
    keep = F.col(raw).isNotNull() & (F.col(threshold).isNull() | (F.col(log_perplexity) <= F.col(threshold)))
    rows = rows.withColumn(kept, keep)
    return rows.select(*(c for c in docs.columns if c not in drop), log_perplexity, threshold, kept)


def keep(docs: DataFrame, labels: DataFrame, **options: object) -> DataFrame:
    """The documents that are kept, with their own columns."""
    names = (fresh(docs, "log_perplexity"), fresh(docs, "threshold"), fresh(docs, "kept"))
    return judged(docs, labels, names=names, **options).where(F.col(names[2])).select(*docs.columns)
