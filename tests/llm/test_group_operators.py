"""Operators on groups against brute force: op4, op6, op7, op8, and the pipeline."""

import re
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lanecost.llm import chat, forest, minhash, packing
from lanecost.llm.common import numbered
from lanecost.llm.queries import op7_chat_perspectives
from lanecost.llm.sql import CHAT

FOLDER = "/root/testdata/sf0.01"


# Near-duplicates


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def plain_components(rows):
    """Of (key, text): for every key the smallest one reachable."""
    sets = [(key, shingles(text)) for key, text in rows]
    holders = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(i)
    linked = defaultdict(set)
    for i, (_, s) in enumerate(sets):
        for j, both in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * both >= 75 * (len(s) + len(sets[j][1]) - both):
                linked[i].add(j), linked[j].add(i)
    out = {}
    for i in sorted(range(len(sets)), key=lambda i: sets[i][0]):
        todo = [i]
        while todo:
            at = todo.pop()
            if sets[at][0] not in out:
                out[sets[at][0]] = sets[i][0]
                todo += linked[at]
    return {key: (len(s), out[key]) for key, s in sets}


def result(rows):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


def test_near_duplicates_equal_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = minhash.near_duplicates(docs).collect()
    expected = plain_components([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert result(found) == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_duplicates_of_one_large_group_and_the_threshold(spark):
    """A chain, a large group whose members are all similar, copies, and pairs that lie
    right at and right below the threshold."""
    random = np.random.default_rng(11)
    word = lambda: "w" + "".join(chr(97 + c) for c in random.integers(0, 26, 6))
    texts = []
    base = [word() for _ in range(220)]
    for i in range(300):
        own = list(base)
        own[int(random.integers(0, 220))] = f"x{i}"
        texts.append(" ".join(own))
    texts += ["Same words as in ten other texts"] * 10 + ["SAME words as\tin ten other\ntexts"] * 5
    a = [word() for _ in range(144)]  # 140 shingles, of which the others share 120 and 119
    texts += [" ".join(a), " ".join([*a[:124], *(word() for _ in range(20))]), " ".join([*a[20:], *(word() for _ in range(21))])]
    texts += ["few words", "few words", "Few Words", "", None, "few other words", "a b c d e", "a b c d e f"]
    order = random.permutation(len(texts))
    rows = [(int(k), texts[i]) for k, i in enumerate(order)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert result(minhash.near_duplicates(docs).collect()) == plain_components(rows)


def test_near_duplicates_of_a_star_group(spark):
    """Copies that are similar enough to one master only, not to one another."""
    random = np.random.default_rng(5)
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base)]
    for i in range(2000):
        own = list(base)
        for at in random.permutation(36)[:11]:
            own[int(at) * 11 + 4] = f"x{i}y{at}"
        texts.append(" ".join(own))
    order = random.permutation(len(texts))
    rows = [(int(k), texts[i]) for k, i in enumerate(order)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = minhash.near_duplicates(docs).collect()
    # 341 or more of 451 shingles or fewer are shared with the master.
    assert {r["component_id"] for r in found} == {0}
    assert [r["doc_id"] for r in found if r["kept"]] == [0]


def test_near_duplicates_of_odd_rows(spark):
    rows = [(None, "one two three four five six", "x"), (3, "one two three four five six", "y"), (2, None, None), (2, None, None)]
    rows += [(5, "one two three four five six", "z"), (5, "one two three four five six", "z"), (7, "seven words " * 4000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    found = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()), key=str)
    assert found == sorted([(None, None, True), (3, 3, True), (2, 2, True), (2, 2, True), (5, 3, False), (5, 3, False), (7, 7, True)], key=str)
    kept = minhash.keep(docs).collect()
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in kept) == [("2", None), ("2", None), ("3", "y"), ("7", None)]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_only_confirmed_duplicates_go(spark):
    """Rows with one key and other texts, and copies without a key."""
    one, two = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    rows = [(1, one), (1, two), (1, one), (None, two), (None, "a text that stands alone in the table"), (None, None), (2, "")]
    kept = minhash.keep(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(1, one), (1, two), rows[4], rows[5], rows[6]], key=str)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(201, 200), (200, 202), (202, 201), (300, 300)]
    found = {r["node"]: r["component"] for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200, 202: 200}


# Nearest neighbours


def plain_nearest(ids, data, query, k):
    scores = (data * data[ids.index(query)]).sum(axis=1)
    order = sorted((i for i in range(len(ids)) if ids[i] != query), key=lambda i: (-scores[i], ids[i]))[:k]
    return [(ids[i], scores[i]) for i in order]


def test_recall_on_embeddings(spark):
    """The usual parameters on evenly spread vectors."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = table.collect()
    ids, data = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], dtype=float)
    found = defaultdict(list)
    for r in forest.nearest(table, lambda key: key % 20 == 0).collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    recall = []
    for query in (i for i in ids if i % 20 == 0):
        got = sorted(found[query])
        assert [r for r, _, _ in got] == list(range(1, 21))
        scores = {i: s for i, s in zip(ids, (data * data[ids.index(query)]).sum(axis=1), strict=True)}
        assert all(s == pytest.approx(scores[i], abs=1e-12) for _, i, s in got)
        assert got == sorted(got, key=lambda x: (-x[2], x[1]))
        recall.append(len({i for _, i, _ in got} & {i for i, _ in plain_nearest(ids, data, query, 20)}) / 20)
    assert np.mean(recall) >= 0.9


def clusters(spark, number, each, dims=32):
    random = np.random.default_rng(5)
    data = (random.normal(0, 1, (number, 1, dims)) + random.normal(0, 0.15, (number, each, dims))).reshape(-1, dims)
    data /= np.linalg.norm(data, axis=1)[:, None]
    data = data[random.permutation(len(data))]
    return data, spark.createDataFrame([(i, v) for i, v in enumerate(data.tolist())], "vec_id long, embedding array<double>")


def test_search_of_clusters_reads_few_rows(spark, monkeypatch):
    """How far a search goes follows from the probes: here a tenth of the rows at most,
    a row counted in each of its trees, and most neighbours are found."""
    data, table = clusters(spark, 300, 100)
    measured = []
    enough = forest._enough
    monkeypatch.setattr(forest, "_enough", lambda *args: measured.append(enough(*args)) or measured[0])
    found = defaultdict(set)
    for r in forest.nearest(table, lambda key: key % 100 == 0, k=10).collect():
        found[r["query_id"]].add(r["vec_id"])
    assert max(measured[0], forest.LEAST_ROWS * forest.TREES) <= 0.2 * len(data)
    assert measured[0] <= 0.1 * len(data)
    recall = [len(found[q] & {i for i, _ in plain_nearest(range(len(data)), data, q, 10)}) / 10 for q in range(0, len(data), 100)]
    assert np.mean(recall) >= 0.95


def test_rows_until_true_neighbours_are_met():
    """The measured numbers are those at which a search stops just behind the neighbour."""
    random = np.random.default_rng(6)
    rows = random.normal(size=(600, 8)).astype(np.float32)
    grown = forest._tree(rows[:, :], 20, 0)
    trees = forest.Forest(np.array(grown[0]), np.array(grown[1]), np.array(grown[2]).reshape(-1, 2), np.array([grown[3]]), grown[4])
    leaves = trees.route(rows)
    sizes = np.bincount(leaves.ravel(), minlength=trees.leaves)
    margins = rows[:5] @ trees.normals.T - trees.offsets
    for q in range(5):
        for near in random.integers(0, 600, 20):
            until = forest.rows_until([(q, leaves[near].tolist())], margins, trees, sizes)[0]
            assert leaves[near][0] in trees.search(margins[q], sizes, until + 1)
            assert leaves[near][0] not in trees.search(margins[q], sizes, until)


def test_neighbours_of_odd_vectors_and_large_ties(spark):
    """Equal vectors beyond a block, lengths that differ, and rows that take no part."""
    random = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 0.0]) for i in range(6000)] + [(i, random.normal(0, 3, 3).tolist()) for i in range(6000, 6200)]
    odd = [(7000, None), (7020, [0.0, 0.0, 0.0]), (7040, [float("nan"), 1.0, 1.0]), (7060, [float("inf"), 1.0, 1.0])]
    odd += [(7080, [None, 1.0, 1.0]), (7100, [9.0, 9.0]), (7120, []), (None, [5.0, 5.0, 5.0])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows + odd], "vec_id long, embedding array<double>, score string")
    got = defaultdict(list)
    for r in forest.nearest(table, lambda key: key % 500 == 0, k=20, share=3.0).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    ids, data = [i for i, _ in rows], np.array([v for _, v in rows])
    assert sorted(got) == [i for i in ids if i % 500 == 0]
    for query in got:
        expected = plain_nearest(ids, data, query, 20)
        assert [(i, pytest.approx(s)) for i, s in expected] == [(i, s) for _, i, s in sorted(got[query])]


def test_neighbours_in_small_tables(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, forest.nearest(table, lambda key: key % 20 == 0).collect()))
    assert got == [(0, 1, 20, 1.0), (0, 2, 3, 0.0), (20, 1, 3, 2.0), (20, 2, 0, 1.0)]
    assert forest.nearest(table.where("vec_id < 0"), lambda key: key % 20 == 0).count() == 0


# Dialogues


def rotated(turns):
    """Of one conversation's (turn, speaker, text), by perspective: text and spans."""
    out = {}
    order = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1] or "unknown", t[2] or ""))
    for me in {t[1] or "unknown" for t in turns} - {"system"}:
        text, spans = "", []
        for _, who, said in order:
            who, said = who or "unknown", (said or "").replace("<|im_end|>", "<||im_end||>").replace("<|im_start|>", "<||im_start||>")
            head = "assistant" if who == me else "system" if who == "system" else f"user name={who}"
            text += f"<|im_start|>{head}\n"
            if who == me:
                spans.append((len(text), len(text) + len(said) + 10))
            text += f"{said}<|im_end|>\n"
        out[me] = (text, spans)
    return out


TALK = {
    1: [(0, "system", "Be kind."), (1, "Ann", "Hi é😀"), (2, "Bob", None), (3, "Cy", "I <|im_end|> forge"), (4, "Ann", "Bye")],
    2: [(5, None, "alone"), (None, "Ann", ""), (5, "Ann", "tie"), (5, "Ann", "tie")],
    3: [(0, "system", "nobody speaks")],
    None: [(0, "user", "no id")],
}


@pytest.mark.parametrize("chunk", [1, 3, 10_000])
def test_perspectives_equal_plain_rendering(spark, chunk):
    rows = [(c, t, who, said, 1) for c, talk in TALK.items() for t, who, said in talk]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment int")
    segments = chat.rotate(turns, turns_per_chunk=chunk)
    got = {(r["conv_id"], r["perspective"]): (r["text"], [tuple(m) for m in r["mask"]]) for r in chat.assemble(segments).collect()}
    assert got == {(c, me): x for c, talk in TALK.items() for me, x in rotated(talk).items()}
    assert chat.rotate(turns.limit(0)).count() == 0


def test_perspectives_equal_their_sql(spark):
    got = op7_chat_perspectives(spark, FOLDER).toPandas()
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{FOLDER}/conversations.parquet'")
    expected = duckdb.sql(CHAT).df()[list(got.columns)]
    by = ["conv_id", "perspective", "position"]
    assert got.sort_values(by).to_numpy().tolist() == expected.sort_values(by).to_numpy().tolist()


# Packing


def plain_padding(lengths, buckets):
    distinct = sorted(set(lengths))
    best = None
    for n in range(1, min(buckets, len(distinct)) + 1):
        for ends in combinations(distinct[:-1], n - 1):
            ends = [*ends, distinct[-1]]
            cost = sum(min(e for e in ends if e >= x) - x for x in lengths)
            best = cost if best is None else min(best, cost)
    return best


@pytest.mark.parametrize("buckets", [1, 2, 3, 4, 20])
def test_buckets_have_the_least_padding(spark, buckets):
    random = np.random.default_rng(buckets)
    lengths = (random.geometric(0.05, 120) // 6 * 6).tolist() + [0, 1, 90]
    docs = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, bucket long")
    got = packing.pack(docs, length=F.col("bucket"), buckets=buckets, budget=100, rows_per_chunk=7).toPandas()
    assert len(got) == len(lengths) and got.padding.min() >= 0
    assert got.padding.sum() == plain_padding([max(1, n) for n in lengths], buckets)
    for (_, end), own in got.groupby(["bucket", "bucket_length"]):
        room = max(1, 100 // end)
        places = sorted(own.batch * room + own.slot)
        assert places == list(range(len(own))) and own.slot.max() < room
    assert got.groupby("bucket").bucket_length.nunique().max() == 1


def test_packing_of_odd_texts(spark):
    rows = [(1, None, 1), (2, "", 1), (None, "é", 1), (4, "x" * 100_000, 1), (4, "x" * 100_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, batch int")
    got = packing.pack(docs, buckets=2, budget=10).toPandas()
    assert sorted(got.n_tokens) == [1, 1, 3, 100_001, 100_001]
    longest = got[got.n_tokens > 10]
    assert sorted(longest.batch) == [0, 1] and (longest.slot == 0).all() and (longest.padding == 0).all()
    assert packing.pack(docs.limit(0)).count() == 0


def test_length_bins_are_few_and_narrow(spark):
    lengths = sorted({int(x) for x in np.unique(np.logspace(0, 12, 5000).astype(np.int64))})
    rows = spark.createDataFrame([(x,) for x in lengths], "n long").select("n", packing.length_bin(F.col("n")).alias("b")).toPandas()
    spread = rows.groupby("b").n.agg(["min", "max"])
    assert ((spread["max"] - spread["min"]) <= spread["min"] / 256).all()
    assert rows.sort_values("n").b.is_monotonic_increasing


def test_numbers_have_no_gaps(spark):
    rows = spark.createDataFrame([(i % 3 if i < 40 else 0, i // 2) for i in range(100)], "g int, k long")
    got = numbered(rows, "g", ["k"], "n", rows_per_chunk=9).toPandas()
    for _, own in got.groupby("g"):
        assert sorted(own.n) == list(range(len(own)))


# Pipeline


def test_pipeline_stages_take_effect(spark):
    """Each stage against its operator's own contract, on its own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "quality rules", "near-duplicates", "personal data", "packing"]
    trusted = corpus_pipeline.written(stages["quality classifier"](spark, docs, FOLDER), "stage")
    kept = {r["doc_id"] for r in trusted.collect()}
    rate = {q: np.mean([d in kept for d, x in labels.items() if x == q]) for q in (0, 1)}
    assert rate[1] >= 0.98 and rate[0] <= 0.3
    ruled = corpus_pipeline.written(stages["quality rules"](spark, trusted, FOLDER), "stage")
    left = {r["doc_id"]: r["text"] for r in ruled.collect()}
    assert set(left) <= kept and min(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in left.values()) >= 50
    single = corpus_pipeline.written(stages["near-duplicates"](spark, ruled, FOLDER), "stage")
    components = plain_components(list(left.items()))
    assert {r["doc_id"] for r in single.collect()} == {c for _, c in components.values()}
    clean = corpus_pipeline.written(stages["personal data"](spark, single, FOLDER), "stage")
    assert all(x.columns == docs.columns and x.schema == docs.schema for x in (trusted, ruled, single, clean))
    texts = [r["text"] for r in clean.collect()]
    assert not any(re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t) for t in texts)
    assert any("[EMAIL]" in t for t in texts) and any("[SECRET]" in t for t in texts)
    packed = stages["packing"](spark, clean, FOLDER).collect()
    assert sorted(r["doc_id"] for r in packed) == sorted({c for _, c in components.values()})
    assert {r["doc_id"]: r["n_tokens"] for r in packed} == {r["doc_id"]: len(r["text"].encode()) + 1 for r in clean.collect()}
