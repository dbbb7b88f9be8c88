"""The manifest against a plain tree, on rows with every kind of value."""

import hashlib
import zlib

import pytest

from lanecost.llm import merkle

FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([digest(*found[-1][i : i + 16]) for i in range(0, len(found[-1]), 16)])
    return found


def siblings(tree, i):
    for level in tree[:-1]:
        start = i // 16 * 16
        yield "".join(level[start:i]), "".join(level[i + 1 : start + 16])
        i //= 16


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    first = lambda v: (v is not None, v or 0)
    ordered = {g: sorted(groups[g], key=lambda r: (first(r[0]), leaf(r))) for g in names}
    trees = {g: levels([leaf(r) for r in ordered[g]]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    found = []
    for nth, g in enumerate(names):
        for i, row in enumerate(ordered[g]):
            path = [*siblings(trees[g], i), *siblings(top, nth)]
            text = row[4]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf((*row[:4], text))
            for left, right in path:
                node = digest(left, node, right)
            root = top[-1][0]
            found.append((row[0], leaf(row), trees[g][-1][0], root, digest(*(a + b for a, b in path)), node, node == root))
    return sorted(found, key=repr)


def checked(docs):
    rows = merkle.verified(merkle.manifest(docs, presented=merkle.lowered_where(5)))
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def corpus():
    rows = [(i, ("a", "b", "ü", "")[i % 7 % 4], "en", i * 3, f"Text {i} ÄÖ Z") for i in range(700)]
    rows += [(None, "a", None, None, None), (None, None, "de", 1, ""), (5, "a", "en", 15, "Text 5 ÄÖ Z"), (5, "a", "en", 15, "Other")]
    rows += [(-4, "alone", "fr", 2, "X" * 100_000), (9000, None, None, 0, "A")]
    return rows + [(7, "same", "en", 1, "Twice A")] * 20


@pytest.mark.parametrize("levels_in_block", [3, 1])
def test_equals_a_plain_tree(spark, monkeypatch, levels_in_block):
    """With blocks of one level the larger groups take several rounds."""
    monkeypatch.setattr(merkle, "LEVELS", levels_in_block)
    monkeypatch.setattr(merkle, "BLOCK", 16**levels_in_block)
    monkeypatch.setattr(merkle, "ROWS_PER_TASK", 100)
    rows = corpus()
    got = checked(spark.createDataFrame(rows, FIELDS).repartition(3))
    assert got == plain(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 16, 17])
def test_sizes_around_a_run(spark, n):
    rows = [(i, "s", None, i, "Aa") for i in range(n)]
    assert checked(spark.createDataFrame(rows, FIELDS)) == plain(rows)


def test_no_rows(spark):
    assert checked(spark.createDataFrame([], FIELDS)) == []


def test_columns_with_the_names_of_helpers(spark):
    rows = corpus()[:40]
    names = ["group_key", "node", "path", "root", "leaf", "at", "size"]
    docs = spark.createDataFrame([(*r, *names) for r in rows], FIELDS + "".join(f", {n} string" for n in names))
    assert checked(docs) == plain(rows)
