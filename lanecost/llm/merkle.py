"""Merkle manifests: one digest for a dataset, a short proof for each of its rows.

Rows are leaves, ordered by key inside their group. Every ``FANOUT`` consecutive nodes
become one, until one is left per group; the groups' roots, in order, likewise give the
root of the dataset.

Nodes are kept by aligned blocks of ``BLOCK`` nodes. A block holds each of its levels as
one string of hexadecimal digests of fixed width: substrings are hashed to the parents,
and what stands left and right of a digest in its run are its siblings. The roots of the
blocks are the nodes of the next round. So no task ever holds more than a block, a group
of any size is many blocks, and the number of rounds grows with the logarithm of the
largest group. Each round is a written table, which together are the manifest.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanecost.llm.common import written

FANOUT = 16
LEVELS = 3
"""Levels in a block."""
BLOCK = FANOUT**LEVELS
DIGEST = 64
ROWS_PER_TASK = 50_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(values: list[Column]) -> Column:
    """The digest of a row: of each value ``-`` if it is null, else its length in bytes of
    UTF-8, a colon and the value; one after the other."""
    texts = [v.cast("string") for v in values]
    told = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*told), 256)


@dataclass(frozen=True)
class Tree:
    """The rounds of a tree. Each is a table of blocks: group_key, block, size (nodes of
    the group in this round), depth (levels above the block's nodes), entries, top, and
    ``l0`` to ``l2``, the levels. ``tops`` has group_key and top, the root of each group."""

    rounds: list[DataFrame]
    tops: DataFrame


def _placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``pos``, the place of a node in its group_key by ``order``, from 0, and
    ``size``, the nodes of the group. Nodes are dealt by ranges; a task numbers its own
    and what lies before them is added from counts, so a group may be of any size."""
    tasks = max(1, math.ceil(nodes.count() / ROWS_PER_TASK))
    # Rows alike in everything are told apart by where they were read, so that they spread.
    by = ["group_key", *order, "read_at"]
    ordered = nodes.withColumn("read_at", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange(tasks, *by).sortWithinPartitions(*by).drop("read_at")
    rows = written(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("at", 33).alias("part")
    of_group = Window.partitionBy("group_key")
    before = of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("group_key", part).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    runs = runs.select(
        "group_key",
        "part",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(of_group).alias("size"),
    )
    found = rows.withColumn("part", part).join(runs, ["group_key", "part"])
    return found.withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _parents(level: Column) -> Column:
    """The next level of a level's string: the digests of its substrings."""
    width = DIGEST * FANOUT
    runs = F.sequence(F.lit(0), F.ceil(F.octet_length(level) / width).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda i: F.sha2(level.substr(i * width + 1, F.lit(width)), 256)), "").cast("binary")


def _blocks(nodes: DataFrame) -> DataFrame:
    """The blocks of nodes (group_key, pos, size, node, and ``entry``, what is to be kept
    of it). A group that fits one block rises until a single node is left, any other by
    all levels of the block."""
    rows = nodes.groupBy("group_key", F.floor(F.col("pos") / BLOCK).alias("block"), "size").agg(
        F.sort_array(F.collect_list(F.struct("pos", "node", "entry"))).alias("entries")  # at most BLOCK
    )
    depth = F.lit(LEVELS)
    for levels in reversed(range(LEVELS)):
        depth = F.when(F.col("size") <= FANOUT**levels, levels).otherwise(depth)
    rows = rows.withColumns({"depth": depth, "l0": F.array_join("entries.node", "").cast("binary"), "entries": F.col("entries.entry")})
    for level in range(LEVELS):
        above = F.when(F.col("depth") > level, _parents(F.col(f"l{level}")))
        rows = rows.withColumn(f"l{level + 1}", above)
    top = F.coalesce(*(F.col(f"l{level}") for level in reversed(range(LEVELS + 1))))
    return rows.withColumn("top", top.cast("string")).drop(f"l{LEVELS}")


def grow(nodes: DataFrame, order: list[str]) -> Tree:
    """The tree of every group_key over its nodes (group_key, node, entry and the order
    columns), each round written."""
    nodes = _placed(nodes, order).select("group_key", "pos", "size", "node", "entry")
    rounds, tops = [], None
    while True:
        blocks = written(_blocks(nodes), "blocks")
        rounds.append(blocks)
        done = blocks.where(F.col("size") <= BLOCK).select("group_key", "top")
        tops = done if tops is None else tops.unionByName(done)
        more = blocks.where(F.col("size") > BLOCK)
        if more.isEmpty():
            return Tree(rounds, tops)
        nodes = more.select(
            "group_key",
            F.col("block").alias("pos"),
            F.ceil(F.col("size") / BLOCK).alias("size"),
            F.col("top").alias("node"),
            F.lit(None).cast("string").alias("entry"),
        )


def _siblings(level: int) -> Column:
    """Of node ``i`` of a block: what stands beside its ancestor of a level in its run."""
    text = F.col(f"l{level}")
    at = F.shiftright("i", 4 * level)
    within = at.bitwiseAND(FANOUT - 1)
    left = text.substr((at - within) * DIGEST + 1, within * DIGEST)
    right = text.substr((at + 1) * DIGEST + 1, (FANOUT - 1 - within) * DIGEST)
    return F.struct(left.cast("string").alias("left"), right.cast("string").alias("right"))


def _paths(blocks: DataFrame) -> DataFrame:
    """group_key, block, i, entry, node and path of every node. ``above`` is the path of the
    block's root; a path is the siblings of each level, from the node upwards."""
    rows = blocks.select("*", F.posexplode("entries").alias("i", "entry")).drop("entries")
    inside = F.slice(F.array(*(_siblings(level) for level in range(LEVELS))), F.lit(1), F.col("depth"))
    node = F.col("l0").substr(F.col("i") * DIGEST + 1, F.lit(DIGEST)).cast("string")
    return rows.select("group_key", "block", "i", "entry", node.alias("node"), F.concat(inside, "above").alias("path"))


def climb(tree: Tree, above: DataFrame) -> DataFrame:
    """group_key, entry, node and path of every node of the tree's first round. ``above``
    has the path over each group's root (group_key, above)."""
    over = None
    for blocks in reversed(tree.rounds):
        single = blocks.where(F.col("size") <= BLOCK).join(above, "group_key")
        if over is not None:
            many = blocks.where(F.col("size") > BLOCK).join(over, ["group_key", "block"])
            single = single.unionByName(many)
        paths = _paths(single)
        over = paths.select("group_key", (F.col("block") * BLOCK + F.col("i")).alias("block"), F.col("path").alias("above"))
    return paths


def proof_text(path: Column) -> Column:
    """All siblings, level by level from left to right."""
    return F.array_join(F.flatten(F.transform(path, lambda s: F.array(s["left"], s["right"]))), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def manifest(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "source",
    fields: tuple[str, ...] = FIELDS,
    presented: Mapping[str, Column] | None = None,
) -> DataFrame:
    """key, leaf, subroot, root, path, presented_leaf of every row.

    ``presented`` has the fields that are shown for verification in another form than
    they are stored, as columns of ``docs``; ``presented_leaf`` is the leaf of that form.
    ``path`` holds the siblings (left, right) of each level up to the root.

    Leaves stand by key, rows with one key by leaf; nulls come first, as does the group of
    null. Values count by their type's text, a null differs from an empty text. A lone
    leaf is its group's root, a lone group's root that of the dataset. Rows that are alike
    are leaves of their own. No rows give no rows. Other columns are not read, whatever
    they are called.
    """
    shown = presented or {}
    stored = [F.col(c) for c in fields]
    other = leaf_digest([shown.get(c, F.col(c)) for c in fields]) if shown else F.lit(None).cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0")).alias("group_key"),
        F.col(key).alias("key"),
        leaf_digest(stored).alias("node"),
        other.alias("other"),
    )
    leaves = written(leaves, "leaves").withColumn("entry", F.struct("key", "other"))
    tree = grow(leaves, ["key", "node"])
    groups = tree.tops.select(F.lit("").alias("group_key"), F.col("group_key").alias("entry"), F.col("top").alias("node"))
    over = grow(groups, ["entry"])
    first = over.tops.head()  # one row, if there is any
    root = F.lit(first.top if first else None).cast("string")
    none = docs.sparkSession.createDataFrame([("", [])], "group_key string, above array<struct<left: string, right: string>>")
    above = climb(over, none).select(F.col("entry").alias("group_key"), F.col("node").alias("subroot"), F.col("path").alias("above"))
    above = written(above, "groups")
    rows = climb(tree, above.select("group_key", "above")).join(above.select("group_key", "subroot"), "group_key")
    return rows.select(
        F.col("entry.key").alias(key),
        F.col("node").alias("leaf"),
        "subroot",
        root.alias("root"),
        "path",
        F.coalesce("entry.other", "node").alias("presented_leaf"),
    )


def verified(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root, verified of the rows of a
    manifest: the root that the presented leaf leads to, and whether it is the root."""
    found = folded(F.col("presented_leaf"), F.col("path"))
    told = F.sha2(proof_text(F.col("path")), 256)
    rows = rows.select(key, "leaf", "subroot", "root", told.alias("proof_sha256"), found.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered_where(every: int, key: str = "doc_id", text: str = "text") -> dict[str, Column]:
    """A tampered text: A-Z in lower case where ``every`` divides the key's checksum."""
    chosen = F.crc32(F.col(key).cast("string")) % every == 0
    return {text: F.when(chosen, F.translate(text, UPPER, LOWER)).otherwise(F.col(text))}
