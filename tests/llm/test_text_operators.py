"""Operators on texts against brute force: op1, op2, op3, op5, op9, op10."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lanecost.llm import chunks, huffman, ngrams, pieces, pii, quality, rules, sharding
from lanecost.llm.queries import BYTES, PIECES, vocabulary
from lanecost.llm.sql import SHARDS

ODD = [
    None,
    "",
    " ",
    "a@b.c.@d.e x@y.z",
    "1.2.3.4.5.6.7.8 256.1.1.1 0000255.01.1.1 1.2.3.4@ab.cd",
    "4111 1111 1111 1111 4111-1111-1111-1111-",
    "+1 (017) 555-7713+1 (017) 555-77135 +12",
    "é😀a@b.co 😀 4111111111111111 ñ",
    "a" * 30_000 + "@b.c",
    "1." * 10_000,
    "a@a" + ".a" * 20_000,
    "+1" * 10_000,
    "one two three one two three one two three\n\n \none two\none two\n" * 3,
    "a b c d " * 40,
    "tab\tand\x0bvertical\x0cfeed\r\n#*$%&|<>",
    "  two  spaces ▁ mark \n line ",
    "日本語　テスト ﬁ \xa0 x",
    "<|endoftext|> <s> it's 'S we'll\n\n 12  34 ",
    "private use",
    "The same text twice, of a few words more than five.",
    "The same text twice, of a few words more than five.",
]


def table(spark, texts, **extra):
    """Documents with an extra column whose name an operator uses for its own."""
    rows = [(i, t, "en" if i % 3 else None, i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, kept int")


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, ODD)


# Personal data


def plain_spans(text):
    text = text or ""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(d) for d in reversed(m[0]) if d.isdigit()]
        total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            found.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end(), "phone"))
    return sorted(found)


def test_base_spans_equal_plain_patterns(docs):
    for row in pii.report(docs).collect():
        expected = plain_spans(ODD[row["doc_id"]])
        told = ",".join(f"{k}:{a}:{b}" for a, _, b, k in expected)
        assert row["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        kinds = Counter(k for *_, k in expected)
        assert [row[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [kinds[k] for k in ("email", "ip", "card", "phone")]
        assert set(filter(None, told.split(","))) <= set(row["spans"].split(","))


def test_secrets_are_added_and_plain_words_are_not(spark):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f96"
    texts = [f'some words token = "{key}{i % 10}" and more' for i in range(40)]
    texts += [f"plain words of number {i} and averyverylongword2 here" for i in range(200)]
    rows = {r["doc_id"]: r["spans"] for r in pii.report(table(spark, texts)).collect()}
    assert all(rows[i] == "secret:20:60" for i in range(40))
    assert all(rows[i] == "" for i in range(40, 240))


def test_redaction_replaces_spans_and_keeps_the_rest(spark):
    text = "write to é😀 ann@example.com or +1 (017) 555-7713, not 10.1.2.3!"
    rows = spark.createDataFrame([(1, text, 5, "x"), (2, None, None, "y"), (3, "clean", 5, "z")], "doc_id long, text string, n_chars long, spans string")
    got = {r["doc_id"]: r for r in pii.redact(rows).collect()}
    assert got[1]["text"] == "write to é😀 [EMAIL] or [PHONE], not [IP]!"
    assert got[1]["n_chars"] == len(got[1]["text"])
    assert (got[2]["text"], got[2]["n_chars"], got[3]["text"], got[3]["n_chars"]) == (None, None, "clean", 5)
    assert [got[i]["spans"] for i in (1, 2, 3)] == ["x", "y", "z"]


def test_texts_with_more_spans_than_a_piece(spark):
    """Walks set full pieces of spans aside; places and order stay those of the patterns."""
    counts = [pii.PIECE - 1, pii.PIECE, pii.PIECE + 1, 5 * pii.PIECE + 3]
    texts = [" ".join(f"é{i} u{i}@ex.org 10.0.0.{i % 300}" for i in range(n)) for n in counts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.report(docs).collect()}
    clean = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    for i, text in enumerate(texts):
        found = [("email", m) for m in re.finditer(r"u\d+@ex\.org", text)]
        found += [("ip", m) for m in re.finditer(r"10\.0\.0\.(\d+)", text) if int(m[1]) <= 255]
        found = sorted((m.start(), kind, m.end()) for kind, m in found)
        assert got[i] == ",".join(f"{kind}:{start}:{end}" for start, kind, end in found)
        plain = re.sub(r"u\d+@ex\.org", "[EMAIL]", text)
        assert clean[i] == re.sub(r"10\.0\.0\.(\d+)", lambda m: "[IP]" if int(m[1]) <= 255 else m[0], plain)


def test_em_finds_the_reliable_labelers(spark):
    random = np.random.default_rng(5)
    hits, alarms = [0.9, 0.8, 0.7, 0.9, 0.6], [0.1, 0.3, 0.2, 0.05, 0.5]
    votes = Counter()
    for _ in range(20_000):
        rates = hits if random.random() < 0.4 else alarms
        votes[tuple(1 if random.random() < r else -1 for r in rates)] += 1
    patterns = spark.createDataFrame([(4, list(v), n) for v, n in votes.items()], "kind int, votes array<int>, n long")
    found = pii.reliabilities(patterns, rounds=60).head()
    assert found["share"] == pytest.approx(0.4, abs=0.05)
    assert np.allclose(found["hits"], hits, atol=0.06) and np.allclose(found["alarms"], alarms, atol=0.06)


# Pieces and ids


def test_pieces_equal_the_library(docs):
    path = vocabulary(PIECES)
    model = pieces.processor(path)
    assert pieces.keeps_to_words(model)
    rows = pieces.decode(pieces.encode(docs, path), path).collect()
    assert len(rows) == len(ODD)
    for row in rows:
        ids = model.encode(ODD[row["doc_id"]] or "")
        assert row["ids"] == ids
        assert row["decoded"] == model.decode(ids)
        assert row["kept"] == row["doc_id"]


def test_a_table_of_chunks_begun_anew_gives_the_same(monkeypatch):
    path = vocabulary(PIECES)
    table = pieces._table(path)
    monkeypatch.setattr(table, "_most", 3)
    texts = [t or "" for t in ODD] * 2
    ids, stops = pieces.encode_texts(texts[:10], path)
    more, ends = pieces.encode_texts(texts, path)
    assert [x.tolist() for x in np.split(more, ends[:-1])] == pieces.processor(path).encode(texts)
    assert more[: stops[-1]].tolist() == ids.tolist()


@pytest.mark.parametrize(("part", "block"), [(1 << 22, 1 << 18), (5_000, 700)])
def test_huffman_files_give_back_the_ids(spark, docs, monkeypatch, part, block):
    path = vocabulary(BYTES)
    monkeypatch.setattr(huffman, "PART_IDS", part)
    monkeypatch.setattr(huffman.write_ids, "__defaults__", (huffman.LONGEST, block))
    rows = huffman.round_trip(docs, path, end=2).orderBy("doc_id").collect()
    start = 0
    assert [r["doc_id"] for r in rows] == list(range(len(ODD)))
    for row, text in zip(rows, ODD, strict=True):
        ids = [*huffman.tokenizer(path).encode(text or "", add_special_tokens=False).ids, 2]
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


@pytest.mark.parametrize("longest", [4, 6, 18])
def test_code_lengths_are_best_for_their_bound(longest):
    random = np.random.default_rng(longest)
    counts = random.geometric(0.01, 14) ** 2
    counts[3] = 0
    lengths = huffman.code_lengths(counts, longest).astype(int)
    used = counts > 0
    assert lengths[3] == 0 and lengths.max() <= longest and sum(2.0 ** -lengths[used]) <= 1
    best = {(0.0, 0): 0}  # by Kraft sum and number of ids placed, longest codes for the rarest
    order = np.sort(counts[used])
    for c in order:
        nxt = {}
        for (kraft, n), cost in best.items():
            for size in range(1, longest + 1):
                k = kraft + 2.0**-size
                if k <= 1 and cost + c * size < nxt.get((k, n + 1), math.inf):
                    nxt[k, n + 1] = cost + c * size
        best = nxt
    assert int((lengths * counts).sum()) == min(best.values())


def test_codes_of_none_one_and_many_ids():
    assert huffman.code_lengths(np.zeros(5, int)).sum() == 0
    for ids in (np.full(1000, 7), np.random.default_rng(0).zipf(1.3, 70_000) % 5000, np.zeros(0, int)):
        counts = np.bincount(ids, minlength=9)
        code = huffman.Code(huffman.code_lengths(counts))
        payload, offsets = code.encode(ids)
        assert np.array_equal(huffman.Decoder(code).decode(payload, offsets, len(ids)), ids)


# Rules and perplexity


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(covered)


def test_base_rules_equal_plain_code(docs):
    rows = rules.judged(docs, prefix="x_").collect()
    assert len(rows) == len(ODD)
    for row in rows:
        expected = plain_measures(ODD[row["doc_id"]])
        assert tuple(row[f"x_{m}"] for m in rules.MEASURES) == expected
        failed = expected[0] < 50 or 100 * expected[4] > 50 * expected[0]
        assert row["x_base_failed"] == failed and (not failed or not row["x_kept"])
        assert row["kept"] == row["doc_id"]


def test_bands_reject_above_and_below(spark):
    """Junk above the band, also where it has many copies, and a text of few patterns below."""
    random = np.random.default_rng(3)
    usual = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ter") for b in ("n", "ra", "st") for c in ("en", "o", "is", "um")]
    rows = [(i, " ".join(random.choice(usual, 300))) for i in range(300)]
    junk = " ".join("".join(map(chr, random.integers(33, 123, 6))) for _ in range(300))
    rows += [(k, junk) for k in range(1000, 1040)]
    few = [f"kanen{'o' * i}" for i in range(1, 71)]
    rows += [(2000, " ".join(random.permutation(few)))]
    docs = spark.createDataFrame([(i, x, "x") for i, x in rows], "doc_id long, text string, lang string")
    found = {r["doc_id"]: r for r in rules.judged(docs).collect()}
    assert not any(r["base_failed"] for r in found.values())
    assert all(found[i]["log_perplexity"] > found[i]["high"] and not found[i]["kept"] for i in range(1000, 1040))
    assert found[2000]["log_perplexity"] < found[2000]["low"] and not found[2000]["kept"]
    assert sum(found[i]["kept"] for i in range(300)) >= 290


def plain_scores(counts):
    """Interpolated modified Kneser-Ney by dictionaries, of one language."""
    levels = [{g: n for g, n in counts.items() if n > 0}]
    for size in (3, 2, 1):
        shorter = Counter(g[-size:] for g in levels[-1])
        levels.append(dict(shorter))
    levels.reverse()
    found = []
    for level in levels:
        of = Counter(level.values())
        n = [of[i] for i in range(5)]
        share = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        d = [0.0] * 4
        for i in (1, 2, 3):
            d[i] = min(max(i - (i + 1) * share * n[i + 1] / n[i], 0.05), i) if n[1] and n[i] else 0.25 + 0.25 * i
        total, spare = Counter(), defaultdict(float)
        for g, c in level.items():
            total[g[:-1]] += c
            spare[g[:-1]] += d[min(c, 3)]
        found.append((level, d, total, spare))
    symbols = len(levels[0]) + 1

    def probability(gram):
        below = probability(gram[1:]) if len(gram) > 1 else 1 / symbols
        level, d, total, spare = found[len(gram) - 1]
        if gram[:-1] not in total:
            return below
        c = level.get(gram, 0)
        return ((c - d[min(c, 3)] if c else 0) + spare[gram[:-1]] * below) / total[gram[:-1]]

    return probability


LEARN = ["the cat sat on the mat", "the cat ate the rat", "a rat sat on a mat and ate", "on and on the mat"]
ASK = ["the rat sat", "zebra Ω😀", "the cat sat on the mat"]


def test_scores_equal_a_plain_model(spark):
    rows = [(t, "en", True) for t in LEARN] + [(t, "en", False) for t in ASK] + [("", "en", True), (None, None, None)]
    data = spark.createDataFrame(rows, "text string, lang string, learn boolean")
    counts = ngrams.gram_counts(data, "text", "lang", F.col("learn"))

    def grams(text):
        padded = "\x02" * 3 + text + "\x03"
        return [tuple(min(ord(c), 0xFFFF) for c in padded[i : i + 4]) for i in range(len(padded) - 3)]

    plain = Counter(g for t in LEARN for g in grams(t))
    got = {r["gram"]: r["n"] for r in counts.collect()}
    packed = lambda g: sum(c << 16 * (3 - i) for i, c in enumerate(g))
    assert got == {packed(g): plain[g] for t in LEARN + ASK for g in grams(t)}
    probability = plain_scores(plain)
    scores = {r["gram"]: r["score"] for r in ngrams.gram_scores(counts).collect()}
    for t in LEARN + ASK:
        for g in grams(t):
            assert math.exp(scores[packed(g)]) == pytest.approx(probability(g), rel=1e-9)
    alphabet = {c for g in plain for c in g[3:]}
    context = grams("the cat")[4][1:]
    assert sum(probability((*context, c)) for c in alphabet) == pytest.approx(1 - probability((*context, 0x4E00)), rel=1e-9)


def test_blocks_and_broadcast_score_alike(spark):
    texts = [*LEARN, *ASK, "", None, "x" * 5000, *LEARN]
    rows = [(i, t, "en" if i % 2 else None, {"a": i}) for i, t in enumerate(texts)]
    data = spark.createDataFrame(rows, "doc_id long, text string, lang string, extra map<string,int>")
    counts = ngrams.gram_counts(data, "text", "lang", F.col("doc_id") < 8)
    scores = ngrams.gram_scores(counts)
    data = data.withColumn("lang", F.coalesce("lang", F.lit("")))
    a = ngrams.scored(data, scores, "text", "lang", "score", drop=("text",)).collect()
    b = ngrams.scored(data, scores, "text", "lang", "score", drop=("text",), broadcast_grams=0).collect()
    key = lambda r: r["doc_id"]
    assert [r.asDict() for r in sorted(a, key=key)] == [r.asDict() for r in sorted(b, key=key)]


def test_long_texts_are_scored_in_pieces(monkeypatch):
    text = "the cat sat on the mat and " * 50
    whole = [np.sort(np.concatenate([g for g, _ in ngrams.pieces([text, "", "ab"])]))]
    monkeypatch.setattr(ngrams, "CHARS", 7)
    parts = list(ngrams.pieces([text, "", "ab"]))
    assert np.array_equal(np.sort(np.concatenate([g for g, _ in parts])), whole[0])
    assert Counter(np.concatenate([o for _, o in parts]).tolist()) == {0: len(text) + 1, 2: 3}


def test_quantiles_equal_sorting(spark):
    random = np.random.default_rng(3)
    values = [("a", float(x)) for x in random.normal(2, 1, 500)] + [("b", 1.0), ("b", None)]
    got = {r["k"]: r for r in ngrams.quantiles(spark.createDataFrame(values, "k string, v double"), "k", "v", {"half": 0.5, "most": 0.9}).collect()}
    own = sorted(v for k, v in values if k == "a")
    assert got["a"]["half"] == pytest.approx(own[249], abs=0.0011)
    assert got["a"]["most"] == pytest.approx(own[449], abs=0.0011)
    assert (got["b"]["n"], got["b"]["half"]) == (1, pytest.approx(1.0))


def test_quality_on_held_out_labels(spark):
    """Accuracy on labelled documents that are hidden from training."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    shown = labels.where("doc_id % 3 > 0")
    got = quality.judged(docs, shown).join(labels.where("doc_id % 3 = 0"), "doc_id")
    rate = {r["quality"]: r["rate"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("rate")).collect()}
    assert rate[1] >= 0.97 and rate[0] <= 0.35


def test_huffman_rows_of_one_key(spark):
    """Many rows without a key, and repeated ones: all there, each id once in the file."""
    path = vocabulary(BYTES)
    rows = [(None, f"text number {i % 50}") for i in range(400)] + [(3, "a"), (3, "b"), (3, "a"), (1, None)]
    got = huffman.round_trip(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), path).collect()
    ends = sorted((r["start"], r["start"] + r["n_tokens"]) for r in got)
    assert len(got) == len(rows) and ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))
    ids = [np.array([*huffman.tokenizer(path).encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for _, t in rows]
    assert sorted(r["ids_crc32"] for r in got) == sorted(map(zlib.crc32, ids))
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == [None] * 400 + [1, 3, 3, 3]


@pytest.mark.parametrize("trusted", [1, 2, 4])
def test_quality_with_few_trusted_texts(spark, trusted):
    """Whatever their hashes, some are held out, so that junk is judged."""
    good = "the men of the town went to see the old house at the end of the road and came back in the evening. "
    for seed in range(3):
        rows = [(i, f"{good * 12} {seed} {i} men of the town", "en") for i in range(trusted)]
        rows += [(10, "zq#%" * 200, "en"), (11, good * 9, "en"), (12, "zq#%" * 200, "de")]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        labels = spark.createDataFrame([(i, 1) for i in range(trusted)], "doc_id long, quality int")
        kept = {r["doc_id"]: r["kept"] for r in quality.judged(docs, labels).collect()}
        assert kept == {**{i: True for i in range(trusted)}, 10: False, 11: True, 12: True}


def test_quality_without_labels_keeps_all_texts(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.judged(docs, labels, names=("p", "t", "k")).collect()
    assert all(r["k"] == bool(ODD[r["doc_id"]]) for r in rows if r["p"] is not None)
    kept = quality.keep(docs, labels)
    assert kept.columns == docs.columns


# Shards


def test_shards_follow_the_published_algorithm(spark):
    ids = [0, 1, 2, 973, -1, -(2**63), 2**63 - 1, 123456789123456789]
    data = spark.createDataFrame([(i, "x") for i in ids], "doc_id long, text string")

    def jump(key, n):
        key &= 2**64 - 1
        b, j = -1, 0
        while j < n:
            b = j
            key = (key * 2862933555777941757 + 1) & (2**64 - 1)
            j = int(float(b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
        return b

    for row in sharding.shard_rows(data, 40).collect():
        assert (row["shard"], row["grown_shard"]) == (jump(row["doc_id"], 40), jump(row["doc_id"], 41))


def test_shards_on_documents(spark):
    folder = "/root/testdata/sf0.01"
    got = sharding.shard_rows(spark.read.parquet(f"{folder}/documents.parquet"), 40, rows_per_chunk=100).toPandas()
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    expected = duckdb.sql(SHARDS).df().set_index("doc_id")
    assert (got.set_index("doc_id").shard == expected.shard.reindex(got.doc_id)).all()
    assert (got.set_index("doc_id").grown_shard == expected.grown_shard.reindex(got.doc_id)).all()
    for _, own in got.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    moved = got[got.shard != got.grown_shard]
    assert (moved.grown_shard == 40).all() and 0.005 < len(moved) / len(got) < 0.06


def test_odd_rows_have_shards(spark, docs):
    rows = sharding.shard_rows(docs.unionByName(docs).withColumn("doc_id", F.when(F.col("doc_id") > 1, F.col("doc_id"))), 3, rows_per_chunk=4).toPandas()
    assert len(rows) == 2 * len(ODD)
    for _, own in rows.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    assert rows[rows.doc_id.isna()].shard.nunique() == 1
    nothing = rows[rows["size"] == 16]
    assert len(nothing) and (nothing.text_crc32 == 0).all()


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    path = vocabulary(PIECES)
    assert pii.report(docs).count() == 0
    assert pieces.decode(pieces.encode(docs, path), path).count() == 0
    assert rules.judged(docs).count() == 0
    assert quality.judged(docs, labels).count() == 0
    assert huffman.round_trip(docs, vocabulary(BYTES)).count() == 0
    assert sharding.shard_rows(docs).count() == 0


@pytest.mark.parametrize("most", [5, 10**6])
def test_ids_of_irregular_spacing_and_trimmed_tables(monkeypatch, most):
    path = vocabulary(BYTES)
    huffman._table.cache_clear()
    monkeypatch.setattr(huffman._table(path), "_most", most)
    texts = [t or "" for t in ODD if huffman.FIRST not in (t or "")]
    texts += ["a  b", " a", "a ", "a\n b", "a \tb c", "x  y z", "plain words of a text", "", " ", "\n"] * 3
    for i in range(0, len(texts), 4):
        ids, stops = huffman.tokenize(texts[i : i + 4], path)
        expected = [x.ids for x in huffman.tokenizer(path).encode_batch(texts[i : i + 4], add_special_tokens=False)]
        assert [x.tolist() for x in np.split(ids, stops[:-1])] == expected
    huffman._table.cache_clear()


@pytest.mark.parametrize("most", [(5, 1 << 20), (10**6, 200), (10**6, 1 << 26)])
def test_ids_of_random_texts_are_those_of_the_library(monkeypatch, most):
    """Signs, line ends, spaces of all kinds, added tokens and private-use characters beside
    one another, with tables that hold few chunks, few bytes, or all."""
    path = vocabulary(BYTES)
    huffman._table.cache_clear()
    monkeypatch.setattr(huffman._table(path), "_most", most[0])
    monkeypatch.setattr(chunks, "MOST_BYTES", most[1])
    monkeypatch.setattr(huffman, "JOINED", min(most))
    parts = [*"abZ09'.,;<|>_- \n\t\r\x0b\x1c\x7f\x85\xa0éüß×÷ªº½ʼɏȿΩя日の\u3000\u2009\u200b\ufeff\u180e“”—«😀\ue000"]
    parts += ["<|endoftext|>", "'s", "'ll", "  ", "\n\n", " word", "the ", "word.\nNext", "über, "]
    random = np.random.default_rng(7)
    for n in (1, 3, 8, 40):
        texts = ["".join(random.choice(parts, random.integers(0, n + 1))) for _ in range(500)]
        ids, stops = huffman.tokenize(texts, path)
        expected = [x.ids for x in huffman.tokenizer(path).encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in np.split(ids, stops[:-1])] == expected
    huffman._table.cache_clear()


def test_words_are_segmented_once_whatever_signs_follow(monkeypatch):
    path = vocabulary(BYTES)
    huffman._table.cache_clear()
    table, given = huffman._table(path), []
    own = table._segment
    monkeypatch.setattr(table, "_segment", lambda new, *more: given.extend(new) or own(new, *more))
    words = [f"w{chr(97 + i)}rd" for i in range(20)]
    texts = [f"{a} {a}, {a}. {a}{sign}\n{b} {b}" for a in words for b in words for sign in ("", ".", "!", ":", "ü.", "...")]
    ids, stops = huffman.tokenize(texts, path)
    expected = [x.ids for x in huffman.tokenizer(path).encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, stops[:-1])] == expected
    assert len(given) <= 100
    huffman._table.cache_clear()
