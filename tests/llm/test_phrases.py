"""Collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np

from lanecost.llm import phrases

FIELDS = "doc_id long, text string, lang string"


def plain(rows, least, top, longest=3):
    counts = Counter()
    total = Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", folded):
            words = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts[lang, *words[i : i + size]] += 1
    kept = {p: a for p, a in counts.items() if 3 <= len(p) <= longest + 1 and a >= least}
    found = []
    for (lang, *words), a in kept.items():
        inside = (f for (other, *longer), f in kept.items() if other == lang and len(longer) > len(words)
                  and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1)))
        if any(100 * f >= 50 * a for f in inside):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, *words[:k]], counts[lang, *words[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.append((lang, " ".join(words), a, left, right, total[lang], score))
    ranked = []
    for lang in sorted({f[0] for f in found}):
        best = sorted((f for f in found if f[0] == lang), key=lambda f: (-f[6], -f[2], f[1].encode()))[:top]
        ranked += [(lang, i + 1, *f[1:]) for i, f in enumerate(best)]
    return ranked


def mined(docs, **options):
    return sorted((tuple(r) for r in phrases.collocations(docs, **options).collect()), key=lambda r: r[:2])


def corpus():
    rng = random.Random(3)
    words = [*"abcdefgh", "Ä", "ü", "new", "york", "city", "'", "x y", "\x00", "ﬀ"]
    weights = [2.0 ** -(i % 7) for i in range(len(words))]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(80)):
            parts += ["New", "York", "city"] if rng.random() < 0.1 else rng.choices(words, weights)
            parts.append(rng.choices([" ", "  ", "\t", ". ", ",", "\n", "!x"], [9, 1, 1, 1, 0.3, 0.3, 0.1])[0])
        text = "".join(p if p in " \t\n" or p[0] in ".,!" else p + " " for p in parts)
        rows.append((i, text, rng.choice(["en", "en", "de", None, "und", ""])))
    return rows + [(500, None, "en"), (None, "", "fr"), (501, " \t.,", "fr"), (502, "word " * 20_000, "long"), (502, "word " * 50, None)]


def test_equals_plain_counting(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, FIELDS).repartition(3)
    assert mined(docs, least=3) == plain(rows, 3, 2000)
    assert mined(docs, least=3, top=5) == plain(rows, 3, 5)
    assert mined(docs, longest=2) == plain(rows, 10, 2000, longest=2)


def test_small_tries_and_slices(spark, monkeypatch):
    """Long texts in slices, tries that burst and spill all the time."""
    monkeypatch.setattr(phrases, "TRIE_ENTRIES", 100)
    rows = corpus()
    assert mined(spark.createDataFrame(rows, FIELDS).repartition(2), least=2) == plain(rows, 2, 2000)


def test_slices_end_with_words():
    text = b"one two.three four five" * 30
    for size in (1, 5, 64, 10_000):
        phrases.SLICE_BYTES, then = size, phrases.SLICE_BYTES
        try:
            parts = list(phrases._slices(text))
        finally:
            phrases.SLICE_BYTES = then
        assert b"".join(parts) == text
        assert sum((phrases._words(p) for p in parts), []) == phrases._words(text)


def test_trie_counts_what_it_is_given(monkeypatch):
    monkeypatch.setattr(phrases, "BURST", 50)
    rng = np.random.default_rng(1)
    trie, want = phrases.Trie(3), Counter()
    spilled = Counter()
    for _ in range(40):
        ids = rng.zipf(1.4, (600, 3)).clip(max=2_000_000)
        keys = ids[:, 0] << 42 | ids[:, 1] << 21 | ids[:, 2]
        want.update(keys.tolist())
        trie.add(keys)
        if len(trie) > 5_000:
            for run, counts in trie.spill(2_000):
                assert (np.diff(run) > 0).all()
                spilled.update(dict(zip(run.tolist(), counts.tolist(), strict=True)))
            assert len(trie) <= 2_000
    assert len(trie.containers) > 10 and (np.diff(trie.lows) > 0).all()
    for run, counts in trie.spill():
        spilled.update(dict(zip(run.tolist(), counts.tolist(), strict=True)))
    assert spilled == want and len(trie) == 0


def test_no_rows_and_clashing_names(spark):
    assert mined(spark.createDataFrame([], FIELDS)) == []
    rows = [(i, "left right. up", "en") for i in range(12)]
    names = ["word", "n", "w1", "rank", "score", "part"]
    docs = spark.createDataFrame([(*r, *names) for r in rows], FIELDS + "".join(f", {n} string" for n in names))
    assert mined(docs) == [("en", 1, "left right", 12, 12, 12, 36, 1_000_000)] == plain(rows, 10, 2000)


def test_another_seed_where_two_words_share_an_id(spark, monkeypatch):
    rows = [(i, "left right", "en") for i in range(12)]
    docs = spark.createDataFrame(rows, FIELDS)
    tables, seeds = phrases._word_counts, []

    def clashing(texts, seed):
        seeds.append(seed)
        found = tables(texts, seed)
        return found.selectExpr("0L AS word_id", "lang", "word", "n") if seed == 0 else found

    monkeypatch.setattr(phrases, "_word_counts", clashing)
    assert len(mined(docs)) == 1 and seeds == [0, 1]
