"""Personal data by weak supervision, in column expressions only.

Base patterns find emails, addresses, cards and phones; these spans always stand. Looser
candidates (secrets, national phone numbers, titled names) get votes from pattern,
gazetteer and context labelers. Expectation-maximisation over the counted vote patterns
estimates how reliable each labeler is, its posteriors weigh the training of a naive
Bayes classifier on span features, and the classifier accepts or drops the candidates.
What is counted per pattern is bounded by the number of patterns, not of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanecost.llm.common import fresh, written

KINDS = ("email", "ip", "card", "phone", "secret", "name")
"""In the order of spans that start together."""

# The base patterns. Possessive repeats keep the same matches without
# recursion or backtracking on long runs; the look-behinds skip starts inside a run that
# failed already, where the pattern would fail again.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

SECRET = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{16,}+"
NATIONAL = r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9])"
TITLED = r"(?<!\p{L})(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Sr|Sra|Señor|Señora|Monsieur|Madame)\.? \p{Lu}\p{L}++(?: \p{Lu}\p{L}++)?+"

# Gazetteers, fixed values.
SECRET_WORDS = ("token", "secret", "password", "passwd", "api key", "apikey", "api_key", "access key", "bearer", "kennwort", "clave", "jeton")
PHONE_WORDS = ("phone", "call", "tel", "mobile", "fax", "telefon", "handy", "teléfono", "téléphone", "portable", "móvil")
GIVEN_NAMES = ("Anna", "Carlos", "Claire", "David", "Elena", "Emma", "Hans", "James", "Jean", "John", "José", "Juan", "Julia", "Karl", "Lucía", "Maria", "Marie", "Mary", "Michael", "Paul", "Peter", "Pierre", "Robert", "Sarah", "Sophie", "Thomas")

CONTEXT = 40
LABELERS = 5
ROUNDS = 25
CERTAIN = 0.9
PIECE = 64
"""Items that a walk gathers before it sets them aside, see ``_gathered``."""


def _span(kind: str, base: bool, start: Column, end: Column, votes: list[Column], features: list[Column]) -> Column:
    return F.struct(
        start.cast("int").alias("start"),
        F.lit(KINDS.index(kind)).alias("rank"),
        end.cast("int").alias("end"),
        F.lit(base).alias("base"),
        F.array(*(v.cast("int") for v in votes)).alias("votes"),
        F.array(*(f.cast("int") for f in features)).alias("features"),
    )


Judge = Callable[[Column, Column, Column], tuple[list[Column], list[Column]]]


def _gathered(items: Column, start: Column, sample: Column, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """The values that a walk over ``items`` gives, in order. ``step`` takes the state, at
    first ``start``, and an item; it gives the next state and an array like ``[sample]``,
    often empty. Full pieces are set aside, so that a longer walk copies little more."""
    empty = F.slice(F.array(sample), 1, 0)
    first = F.struct(start.alias("own"), empty.alias("last"), F.slice(F.array(empty), 1, 0).alias("aside"))

    def turn(state: Column, x: Column) -> Column:
        own, new = step(state["own"], x)
        full = F.size(state["last"]) >= PIECE
        return F.struct(
            own.alias("own"),
            F.concat(F.when(full, empty).otherwise(state["last"]), new).alias("last"),
            F.when(full, F.concat(state["aside"], F.array(state["last"]))).otherwise(state["aside"]).alias("aside"),
        )

    return F.aggregate(items, first, turn, lambda end: F.flatten(F.concat(end["aside"], F.array(end["last"]))))


def _found(text: Column, pattern: str, kind: str, base: bool, passes: Callable[[Column], Column], judge: Judge | None) -> Column:
    """The spans of the pattern's leftmost matches that pass. Their places follow from
    the lengths of the matches and of what lies between them, in one walk."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    n = F.size(matches)
    walk = F.arrays_zip(
        F.slice(between, 1, n).alias("before"), matches.alias("match"), F.slice(between, 2, n).alias("after")
    )
    zero = F.lit(0).cast("long")
    none = F.lit(0)
    sample = _span(kind, base, zero, zero, [none] * LABELERS, [none] * 4)

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + F.length(x["before"])
        end = start + F.length(x["match"])
        votes, features = judge(x["before"], x["match"], x["after"]) if judge else ([none] * LABELERS, [none] * 4)
        span = _span(kind, base, start, end, votes, features)
        return end.cast("long"), F.when(passes(x["match"]), F.array(span)).otherwise(F.slice(F.array(sample), 1, 0))

    return _gathered(walk, zero, sample, step)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    """Every second digit from the right is doubled; nines are cast out of it."""
    digits = F.transform(F.split(F.reverse(_digits(match)), ""), lambda d: d.cast("int"))
    doubled = F.transform(
        digits, lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _card(match: Column) -> Column:
    return F.when(F.length(_digits(match)).between(14, 19), _luhn(match)).otherwise(F.lit(False))


def _vote(yes: Column) -> Column:
    return F.when(yes, 1).otherwise(-1)


def _last(before: Column) -> Column:
    return F.substring(before, -1, 1)


def _mentions(before: Column, words: tuple[str, ...]) -> Column:
    tail = F.lower(F.substring(before, -CONTEXT, CONTEXT))
    return tail.rlike("(?:^|[^\\p{L}])(?:" + "|".join(words) + ")(?![\\p{L}])")


def _edge(char: Column) -> Column:
    """Class of a neighbouring character."""
    return (
        F.when(char == "", 0)
        .when(char.isin('"', "'", "=", ":", "(", ")"), 1)
        .when(char.rlike(r"\s"), 2)
        .when(char.rlike(r"[.,;!?]"), 3)
        .otherwise(4)
    )


def _secret(before: Column, match: Column, after: Column) -> tuple[list[Column], list[Column]]:
    hexadecimal = match.rlike(r"\A(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)\z")
    mixed = match.rlike("[a-z]") & match.rlike("[A-Z]") & (F.length(match) >= 20)
    named = _mentions(before, SECRET_WORDS)
    ahead, behind = _edge(_last(before)), _edge(F.substring(after, 1, 1))
    variety = F.size(F.array_distinct(F.split(match, ""))) >= 10
    share = F.length(_digits(match)) / F.length(match)
    even = variety & share.between(0.15, 0.9)
    votes = [_vote(hexadecimal | mixed), _vote(named), _vote(ahead == 1), _vote(even), _vote(behind == 1)]
    features = [F.when(hexadecimal, 2).when(mixed, 1).otherwise(0), named.cast("int"), ahead, behind]
    return votes, features


def _phone(strict: bool) -> Judge:
    def judge(before: Column, match: Column, after: Column) -> tuple[list[Column], list[Column]]:
        named = _mentions(before, PHONE_WORDS)
        ahead, behind = _edge(_last(before)), _edge(F.substring(after, 1, 1))
        bracket = match.contains("(")
        grouped = match.rlike(r"[0-9]{3}[.-][0-9]{4}\z")
        votes = [_vote(F.lit(strict)), _vote(named), _vote(ahead < 4), _vote(bracket | grouped), _vote(behind < 4)]
        return votes, [bracket.cast("int"), named.cast("int"), ahead, behind]

    return judge


def _name(before: Column, match: Column, after: Column) -> tuple[list[Column], list[Column]]:
    listed = match.rlike("(?:" + "|".join(GIVEN_NAMES) + r")(?!\p{L})")
    two = match.rlike(r"\p{Lu}\p{L}++ \p{Lu}\p{L}++\z") & match.rlike(r" .* ")
    dotted = match.rlike(r"\A\p{L}+\.")
    ahead, behind = _edge(_last(before)), _edge(F.substring(after, 1, 1))
    votes = [_vote(two), _vote(listed), _vote(ahead < 4), _vote(dotted), _vote(behind < 4)]
    return votes, [two.cast("int"), listed.cast("int"), dotted.cast("int"), behind]


def candidates(text: Column) -> Column:
    """All spans of a text, base and other, by start and kind. A null text has none."""
    text = F.coalesce(text, F.lit(""))
    empty = F.slice(F.array(_span("email", True, F.lit(0), F.lit(0), [F.lit(0)] * LABELERS, [F.lit(0)] * 4)), 1, 0)

    def where(guard: Column, *spans: Column) -> Column:
        return F.when(guard, F.concat(*spans)).otherwise(empty)

    parts = [r"\A", IP_PART, *[r"\." + IP_PART] * 3, r"\z"]
    digits = text.rlike("[0-9]")
    return F.array_sort(
        F.concat(
            where(text.contains("@"), _found(text, EMAIL, "email", True, lambda m: F.lit(True), None)),
            where(
                digits,
                _found(text, IP, "ip", True, lambda m: m.rlike("".join(parts)), None),
                _found(text, CARD, "card", True, _card, None),
                _found(text, SECRET, "secret", False, lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]"), _secret),
                _found(text, NATIONAL, "phone", False, lambda m: F.lit(True), _phone(False)),
            ),
            where(
                digits & text.contains("+"),
                _found(text, PHONE, "phone", True, lambda m: F.length(_digits(m)).between(10, 15), _phone(True)),
            ),
            where(text.rlike(TITLED), _found(text, TITLED, "name", False, lambda m: F.lit(True), _name)),
        )
    )


def _likelihood(votes: Column, rates: Column) -> Column:
    """Of the votes, where each labeler says yes at its rate; 0 is no vote."""
    each = F.zip_with(votes, rates, lambda v, r: F.when(v == 1, r).when(v == -1, 1 - r).otherwise(F.lit(1.0)))
    return F.aggregate(each, F.lit(1.0), lambda a, x: a * x)


def reliabilities(patterns: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """kind and share, hits, alarms: how many candidates are true, and how often each
    labeler says yes to true and to false ones, by expectation-maximisation.

    ``patterns`` has kind, votes, n; a kind has at most 3^5 vote patterns, so its
    patterns are one small array and all rounds are one expression over it.
    """
    start = F.struct(
        F.lit(0.5).alias("share"),
        F.array(*[F.lit(0.8)] * LABELERS).alias("hits"),
        F.array(*[F.lit(0.2)] * LABELERS).alias("alarms"),
    )

    def posterior(state: Column, votes: Column) -> Column:
        yes = state["share"] * _likelihood(votes, state["hits"])
        no = (1 - state["share"]) * _likelihood(votes, state["alarms"])
        return yes / (yes + no)

    def step(state: Column, _: Column, seen: Column) -> Column:
        weighed = F.transform(
            seen,
            lambda p: F.struct(
                p["votes"].alias("votes"),
                (p["n"] * posterior(state, p["votes"])).alias("yes"),
                (p["n"] * (1 - posterior(state, p["votes"]))).alias("no"),
            ),
        )

        def total(side: str) -> Column:
            return F.aggregate(weighed, F.lit(0.0), lambda a, p: a + p[side])

        def rates(side: str) -> Column:
            return F.transform(
                F.sequence(F.lit(1), F.lit(LABELERS)),
                lambda j: (
                    F.aggregate(
                        weighed,
                        F.lit(0.5),
                        lambda a, p: a + F.when(F.element_at(p["votes"], j) == 1, p[side]).otherwise(0.0),
                    )
                    / (total(side) + 1.0)
                ),
            )

        share = (total("yes") + 1.0) / (total("yes") + total("no") + 2.0)
        return F.struct(share.alias("share"), rates("yes").alias("hits"), rates("no").alias("alarms"))

    seen = patterns.groupBy("kind").agg(
        F.array_sort(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("seen")
    )
    turns = F.sequence(F.lit(1), F.lit(rounds))
    found = F.aggregate(turns, start, lambda state, i: step(state, i, F.col("seen")))
    return seen.select("kind", found.alias("of")).select("kind", "of.share", "of.hits", "of.alarms")


def decisions(counts: DataFrame) -> DataFrame:
    """kind and features of the candidates that the classifier accepts.

    ``counts`` has kind, votes, features, n. The posterior of each vote pattern is the
    soft label of its candidates; naive Bayes over the features learns from all of them.
    """
    learned = reliabilities(counts.groupBy("kind", "votes").agg(F.sum("n").alias("n")))
    yes = F.col("share") * _likelihood(F.col("votes"), F.col("hits"))
    no = (1 - F.col("share")) * _likelihood(F.col("votes"), F.col("alarms"))
    weighed = counts.join(learned, "kind").select("kind", "features", (F.col("n") * yes / (yes + no)).alias("yes"), "n")
    weighed = weighed.groupBy("kind", "features").agg(F.sum("yes").alias("yes"), F.sum("n").alias("n"))
    prior = weighed.groupBy("kind").agg(F.sum("yes").alias("all_yes"), F.sum("n").alias("all_n"))
    each = weighed.select("kind", "yes", "n", F.posexplode("features").alias("place", "value"))
    odds = (
        each.groupBy("kind", "place", "value")
        .agg(F.sum("yes").alias("yes"), F.sum("n").alias("n"))
        .join(prior, "kind")
        .select(
            "kind",
            "place",
            "value",
            (
                F.log((F.col("yes") + 0.5) / (F.col("all_yes") + 1.0))
                - F.log((F.col("n") - F.col("yes") + 0.5) / (F.col("all_n") - F.col("all_yes") + 1.0))
            ).alias("odds"),
        )
    )
    first = prior.select(
        "kind", F.log((F.col("all_yes") + 0.5) / (F.col("all_n") - F.col("all_yes") + 0.5)).alias("prior")
    )
    return (
        weighed.select("kind", "features", F.posexplode("features").alias("place", "value"))
        .join(odds, ["kind", "place", "value"])
        .groupBy("kind", "features")
        .agg(F.sum("odds").alias("odds"))
        .join(first, "kind")
        .where(F.col("odds") + F.col("prior") > F.log(F.lit(CERTAIN / (1 - CERTAIN))))
        .select("kind", "features")
    )


def _standing(spans: Column, accepted: list[tuple[int, tuple[int, ...]]]) -> Column:
    """Base spans, and the accepted others that overlap neither these nor each other."""
    codes = F.array(F.lit(""), *(F.lit(f"{rank}:{','.join(map(str, f))}") for rank, f in accepted))

    def code(s: Column) -> Column:
        return F.concat_ws(":", s["rank"].cast("string"), F.array_join(F.transform(s["features"], lambda f: f.cast("string")), ","))

    none = F.lit(0)
    sample = _span("email", True, none, none, [none] * LABELERS, [none] * 4)
    nothing = F.slice(F.array(sample), 1, 0)

    # backwards: accepted ones that end before the next base span begins
    def ends(following: Column, s: Column) -> tuple[Column, Column]:
        stays = s["base"] | (F.array_contains(codes, code(s)) & (s["end"] <= following))
        return F.when(s["base"], s["start"]).otherwise(following), F.when(stays, F.array(s)).otherwise(nothing)

    # forwards: of these, the ones that begin after all base spans and others before them
    def begins(upto: Column, s: Column) -> tuple[Column, Column]:
        stays = s["base"] | (s["start"] >= upto)
        return F.when(stays, F.greatest(upto, s["end"])).otherwise(upto), F.when(stays, F.array(s)).otherwise(nothing)

    ending = _gathered(F.reverse(spans), F.lit(2**31 - 1), sample, ends)
    standing = _gathered(F.reverse(ending), none, sample, begins)
    return F.when(F.exists(spans, lambda s: ~s["base"]), standing).otherwise(spans)


def detect(docs: DataFrame, text: str = "text", drop: tuple[str, ...] = (), name: str = "spans") -> DataFrame:
    """The rows of ``docs`` and their spans: an array of start, rank (in ``KINDS``), end,
    base, votes and features, by start and rank. Code points, end exclusive.

    Null and empty texts have no spans, and repeated rows have the same. An empty table
    gives an empty table. Other columns pass through, but for one named like the new
    one; ``drop`` leaves some out. Texts
    are read once; the classifier's decisions, at most one per kind and feature pattern,
    are read by the driver.
    """
    rows = docs.withColumn(name, candidates(F.col(text))).select(
        *(c for c in docs.columns if c not in (*drop, name)), name
    )
    rows = written(rows, "candidates")
    each = rows.where(F.exists(name, lambda s: F.size(s["votes"]) > 0)).select(F.explode(name).alias("s"))
    counts = (
        each.where((F.col("s.rank") >= KINDS.index("phone")))
        .groupBy(F.col("s.rank").alias("kind"), F.col("s.votes").alias("votes"), F.col("s.features").alias("features"))
        .agg(F.count("*").alias("n"))
    )
    chosen = decisions(written(counts, "votes")).collect()
    accepted = sorted((r["kind"], tuple(r["features"])) for r in chosen)
    return rows.withColumn(name, _standing(F.col(name), accepted))


def written_spans(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    one = F.transform(
        spans,
        lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(one, ",")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all)."""
    found = detect(docs.select(key, text), text, drop=(text,), name="_spans")
    base = F.filter("_spans", lambda s: s["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["rank"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        key,
        *(number(k) for k in ("email", "ip", "card", "phone")),
        F.sha2(written_spans(base), 256).alias("base_sha256"),
        written_spans(F.col("_spans")).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The documents with every span replaced by its kind in brackets, as ``[EMAIL]``;
    of overlapping spans the first names the place. ``length``, if there is such a
    column, becomes the new number of code points where the text changed."""
    name = fresh(docs, "pii_spans")
    rows = detect(docs, text, name=name)
    kinds = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    whole = F.col(text)
    last = F.struct(F.length(whole).alias("start"), F.length(whole).alias("end"), F.lit("").alias("put"))
    places = F.transform(name, lambda s: F.struct(s["start"], s["end"], F.element_at(kinds, s["rank"] + 1).alias("put")))

    def step(at: Column, s: Column) -> tuple[Column, Column]:
        gap = F.substring(whole, at + 1, F.greatest(s["start"] - at, F.lit(0)))
        new = F.when(s["start"] >= at, F.array(gap, s["put"])).otherwise(F.slice(F.array(F.lit("")), 1, 0))
        return F.greatest(at, s["end"]), new

    cleaned = fresh(rows, "pii_cleaned")
    changed = F.size(name) > 0
    pieces = _gathered(F.concat(places, F.array(last)), F.lit(0), F.lit(""), step)
    rows = rows.withColumn(cleaned, F.when(changed, F.array_join(pieces, "")).otherwise(whole))
    out = {c: F.col(c) for c in docs.columns}
    if length in out:
        new = F.when(changed, F.length(cleaned)).otherwise(F.col(length))
        out[length] = new.cast(docs.schema[length].dataType)
    out[text] = F.col(cleaned)
    return rows.select(*(value.alias(c) for c, value in out.items()))
