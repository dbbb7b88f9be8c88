"""Links of vectors against brute force, with crowded regions and odd values."""

import math

import numpy as np
import pytest

from lanecost.llm import polytope


def found(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def plain(ids, x):
    x = x / np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= polytope.COSINE
    np.fill_diagonal(linked, False)
    first = np.array(ids)
    while True:
        then = first.copy()
        for i in range(len(ids)):
            first[i] = min(first[i], first[linked[i]].min(initial=first[i]))
        if (first == then).all():
            break
    return {i: (int(n), int(c), int(c) == i) for i, n, c in zip(ids, linked.sum(axis=1), first, strict=True)}


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(v) for v in x]) for i, x in rows], "vec_id long, embedding array<float>")


def near(rng, centre, cosine, n):
    """Vectors at an angle to a centre."""
    away = rng.normal(size=(n, len(centre)))
    away -= np.outer(away @ centre, centre)
    away /= np.linalg.norm(away, axis=1)[:, None]
    return cosine * centre + math.sqrt(1 - cosine**2) * away


def test_groups_and_singles_equal_brute_force(spark):
    """Two crowded groups, one of them loose, a chain whose ends are not linked, copies
    and vectors of their own."""
    rng = np.random.default_rng(5)
    axis = np.eye(64)
    x = [near(rng, axis[0], 0.997, 900), near(rng, axis[1], 0.976, 500), rng.normal(size=(300, 64))]
    x.append(np.array([math.cos(t) * axis[2] + math.sin(t) * axis[3] for t in np.linspace(0, 1.5, 12)]))
    x.append(np.repeat(rng.normal(size=(1, 64)), 40, axis=0))
    x = np.concatenate(x).astype(np.float32)
    ids = [int(i) for i in rng.permutation(len(x)) * 3 - 50]
    got, want = found(polytope.near_duplicates(frame(spark, zip(ids, x, strict=True)))), plain(ids, x.astype(float))
    assert all(got[i][0] <= want[i][0] for i in ids)
    assert sum(n for n, _, _ in got.values()) >= 0.995 * sum(n for n, _, _ in want.values())
    tight = [i for i in ids[:900] + ids[1400:]]
    assert {i: got[i] for i in tight} == {i: want[i] for i in tight}
    assert [got[i][1:] for i in ids] == [want[i][1:] for i in ids]


def test_crowds_of_copies_are_counted_without_their_pairs(spark):
    """A group of 3,000 near copies forms cores; tiles hold far fewer rows than its square."""
    rng = np.random.default_rng(6)
    x = near(rng, np.eye(64)[0], 0.998, 3000)
    rows = frame(spark, enumerate(x)).selectExpr("vec_id AS node", "1L AS weight", "CAST(embedding AS array<double>) AS vector", "vec_id AS key")
    named = polytope._named(rows.select("key", "vector")).selectExpr("key AS node", "1L AS weight", "vector", "64 AS dim")
    codes = polytope.written(polytope._hashed(named, 3000), "codes")
    members, cores = polytope._cores(codes, math.acos(polytope.COSINE))
    assert members.count() > 2_500
    entries = polytope.written(polytope._entries(codes, members), "entries")
    pairs = polytope.written(polytope._unit_pairs(entries), "pairs")
    whole = polytope._whole_links(pairs, cores, math.acos(polytope.COSINE))
    assert whole.count() > 0
    left = pairs.join(whole, ["dim", "u", "v"], "left_anti")
    assert (left.selectExpr("sum(nu * nv)").head()[0] or 0) < 3000**2
    got = found(polytope.near_duplicates(frame(spark, enumerate(x))))
    assert set(got.values()) == {(2999, 0, True), (2999, 0, False)}


def test_odd_values(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1e300, 1e290]), (4, [1e-300, 0.0]), (5, [0.0, 0.0]), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (8, [None, 1.0]), (9, None), (10, []), (11, [1.0]), (12, [-1.0, 0.0]), (13, [0.0, 5.0]),
        (None, [3.0, 0.1]), (13, [0.0, 5.0]), (14, [7.0]), (None, None), (20, [1.0, 0.0, 0.0]),
    ]
    got = [tuple(r) for r in polytope.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()]
    by_id = {}
    for i, *rest in got:
        by_id.setdefault(i, []).append(tuple(rest))
    for i in (1, 2, 3, 4):
        assert by_id[i] == [(4, 1, i == 1)]
    assert sorted(by_id[None], key=repr) == [(0, None, True), (4, 1, False)]
    for i in (5, 6, 7, 8, 9, 10, 12, 20):
        assert by_id[i] == [(0, i, True)]
    assert by_id[13] == [(1, 13, True)] * 2
    assert by_id[11] == [(1, 11, True)] and by_id[14] == [(1, 11, False)]


@pytest.mark.parametrize("type", ["array<float>", "array<int>"])
def test_no_rows_and_clashing_names(spark, type):
    empty = spark.createDataFrame([], f"vec_id long, embedding {type}")
    assert polytope.near_duplicates(empty).collect() == []
    names = ["node", "weight", "core", "key", "name", "vector"]
    rows = spark.createDataFrame([(1, [1, 0], *names), (2, [1, 0], *names)], "vec_id long, embedding array<int>" + "".join(f", {n} string" for n in names))
    got = polytope.near_duplicates(rows.withColumn("embedding", rows.embedding.cast(type)))
    assert found(got) == {1: (1, 1, True), 2: (1, 1, False)}


def test_rotations_keep_lengths_and_hashes_meet():
    rng = np.random.default_rng(7)
    x = polytope._unit(rng.normal(size=(50, 48)))
    assert np.allclose(np.linalg.norm(polytope.rotated(x, 3), axis=1), 1)
    y = polytope._unit(np.stack([near(rng, v, 0.95, 1)[0] for v in polytope._unit(rng.normal(size=(4000, 64)))]))
    z = polytope._unit(np.stack([near(rng, v, 0.95, 1)[0] for v in y]))
    a, b = polytope.buckets(y, 3), polytope.buckets(z, 3)
    met = (a[:, :, :1] == b).any(axis=2) | (b[:, :, :1] == a).any(axis=2)
    assert met.any(axis=1).mean() > 0.995
