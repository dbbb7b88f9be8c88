"""Near-duplicates of vectors by cross-polytope hashing.

A unit vector is rotated at random by three rounds of sign changes and fast Hadamard
transforms; the signed axis that it then lies nearest to is its hash, a corner of the
cross-polytope. Several hashes make a bucket of a table. A vector lies in one bucket of
each table and looks into those next to it as well, found by the axes it nearly chose.
Vectors of which one looks into the other's bucket are compared in double precision.

Equal vectors are one node with a weight. Pairs are never written out: a tile of two
blocks of a bucket yields for each node the weight that it is linked with and one node it
is reached from. A pair that meets in several buckets counts in the first one only.

Crowded regions do not cost the square of their size. Where a bucket is crowded its centre
is taken, and nodes that look into it and lie within half the permitted angle of it form
a core: any two of them are linked by the triangle inequality, and so are two cores whose
centres and radii leave no other choice. What is linked that way is counted by weight.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanecost.llm.common import written
from lanecost.llm.minhash import components

COSINE = 0.95
TABLES = 10
PROBES_PER_HASH = 2
NEAREST = 3
"""Axes of each hash that a vector may look into."""
ROUNDS = 3
SEED = 20250611
CROWD = 64
"""Nodes of a bucket of the first table from which its centre is taken."""
MARGIN = 1e-6
"""Angle by which rounding cannot be wrong."""
BLOCK_ROWS = 1_024
BIN_ROWS = 8_192
SUM_ROWS = 4_096
FREE = -(1 << 63)
"""In place of the core of a node that has none."""


def hashes_per_table(nodes: int, dimensions: int) -> int:
    """So many that a bucket holds less than one unrelated node on average."""
    corners = 2 * _padded(dimensions)
    return max(1, min(math.ceil(math.log(8 * max(nodes, 1)) / math.log(corners)), int(58 / math.log2(corners))))


def _padded(dimensions: int) -> int:
    return 1 << max(0, dimensions - 1).bit_length()


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised transform of each row; their length is a power of two."""
    n, size = x.shape
    step = 1
    while step < size:
        pairs = x.reshape(n, -1, 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        step *= 2
    return x / math.sqrt(size)


def rotated(x: np.ndarray, number: int) -> np.ndarray:
    """Unit vectors under the rotation of a number."""
    size = _padded(x.shape[1])
    signs = np.random.default_rng([SEED, size, number]).choice([-1.0, 1.0], (ROUNDS, size))
    x = np.pad(x, ((0, 0), (0, size - x.shape[1])))
    for flip in signs:
        x = _hadamard(x * flip)
    return x


def buckets(x: np.ndarray, hashes: int, tables: int = TABLES) -> np.ndarray:
    """Of every unit vector and table: its bucket and those it looks into, nearest first."""
    probes = PROBES_PER_HASH * hashes
    size = _padded(x.shape[1])
    nearest = min(NEAREST, size)
    combinations = np.array(list(itertools.product(range(nearest), repeat=hashes)))
    probes = min(probes, len(combinations))
    found = np.zeros((len(x), tables, probes), np.int64)
    for t in range(tables):
        corner, loss = [], np.zeros((len(x), len(combinations)))
        for k in range(hashes):
            y = rotated(x, t * hashes + k)
            length = np.abs(y)
            axis = np.argsort(-length, axis=1, kind="stable")[:, :nearest]
            near = np.take_along_axis(length, axis, 1)
            corner.append(2 * axis + (np.take_along_axis(y, axis, 1) < 0))
            loss += ((near[:, :1] - near) ** 2)[:, combinations[:, k]]
        code = np.zeros((len(x), len(combinations)), np.int64)
        for k in range(hashes):
            code = code * (2 * size) + corner[k][:, combinations[:, k]]
        found[:, t] = np.take_along_axis(code, np.argsort(loss, axis=1, kind="stable")[:, :probes], 1)
    return found


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of doubles from their bytes, all of one length."""
    data = column.to_pylist()
    return np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1)


def _named(rows: DataFrame) -> DataFrame:
    """key, vector (its doubles, null where it takes no part) and name, which equal
    vectors share."""
    schema = T.StructType([
        T.StructField("key", rows.schema["key"].dataType),
        T.StructField("vector", T.BinaryType()),
        T.StructField("name", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            values = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64)  # a null is not a number
            stops = np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))
            vectors, names = [], []
            for start, stop in zip(np.append(0, stops[:-1]), stops, strict=True):
                x = values[start:stop]
                fit = len(x) > 0 and np.isfinite(x).all() and x.any()
                vectors.append(x.tobytes() if fit else None)
                names.append(xxhash.xxh128_digest(vectors[-1]) if fit else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(vectors, pa.binary()), pa.array(names, pa.binary())], schema.names
            )

    return rows.mapInArrow(run, schema)


def _hashed(classes: DataFrame, nodes: int) -> DataFrame:
    """Adds ``codes``: of every table the buckets of a node, its own first."""
    schema = T.StructType([*classes.schema.fields, T.StructField("codes", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dimensions in sorted(set(batch.column("dim").to_pylist())):
                part = batch.filter(pa.compute.equal(batch.column("dim"), dimensions))
                found = buckets(_unit(_matrix(part.column("vector"))), hashes_per_table(nodes, dimensions))
                offsets = np.arange(len(found) + 1, dtype=np.int32) * found[0].size
                codes = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, codes], schema.names)

    return classes.mapInArrow(run, schema)


def _first_buckets(codes: DataFrame) -> DataFrame:
    """node and ``core``, the buckets of the first table that it looks into."""
    first = F.slice("codes", 1, (F.size("codes") / TABLES).cast("int"))
    return codes.select("node", "dim", "vector", F.explode(first).alias("core"))


def _centres(codes: DataFrame) -> DataFrame:
    """dim, core, centre of the crowded buckets of the first table, by those that lie in
    them: the direction of their sum, taken in parts of bounded size."""
    lying = codes.select("node", "dim", F.get("codes", F.lit(0)).alias("core"), "vector")
    crowds = lying.groupBy("dim", "core").agg(F.count("*").alias("n")).where(F.col("n") >= CROWD)
    crowded = lying.join(written(crowds, "crowds"), ["dim", "core"])
    crowded = crowded.withColumn("part", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / SUM_ROWS))).drop("n")
    schema = "dim int, core long, vector binary"

    def total(part: pa.Table, unit: bool) -> pa.Table:
        x = _matrix(part.column("vector"))
        x = (_unit(x) if unit else x).sum(axis=0)
        return pa.table([part.column("dim")[:1], part.column("core")[:1], pa.array([x.tobytes()], pa.binary())], ["dim", "core", "vector"])

    parts = crowded.groupBy("dim", "core", "part").applyInArrow(lambda part: total(part, True), schema)
    sums = parts.groupBy("dim", "core").applyInArrow(lambda part: total(part, False), schema)
    return sums.withColumnRenamed("vector", "centre")


def _angles(rows: DataFrame, one: str, other: str) -> DataFrame:
    """Adds ``angle``, that between two vectors, and drops them."""
    kept = [f for f in rows.schema.fields if f.name not in (one, other)]
    schema = T.StructType([*kept, T.StructField("angle", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angles = []
            for x, y in zip(batch.column(one), batch.column(other), strict=True):
                pair = np.frombuffer(x.as_buffer(), np.float64), np.frombuffer(y.as_buffer(), np.float64)
                if all(v.any() for v in pair):
                    x, y = (_unit(v[None])[0] for v in pair)
                    angles.append(2 * math.atan2(np.linalg.norm(x - y), np.linalg.norm(x + y)))
                else:  # vectors that cancel out have no centre
                    angles.append(math.pi)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(angles)], schema.names)

    return rows.mapInArrow(run, schema)


def _cores(codes: DataFrame, limit: float) -> tuple[DataFrame, DataFrame]:
    """node, core of the nodes within half the limit of the nearest centre they look at;
    and dim, core, centre, radius, weight, first (its smallest node) of the cores."""
    centres = written(_centres(codes), "centres")
    near = _angles(_first_buckets(codes).join(centres, ["dim", "core"]), "vector", "centre")
    near = near.where(F.col("angle") <= limit / 2 - MARGIN)
    members = near.groupBy("node").agg(F.min(F.struct("angle", "core")).alias("best"), F.first("dim").alias("dim"))
    members = written(members.select("node", "dim", "best.*"), "members")
    found = members.join(codes.select("node", "weight"), "node").groupBy("dim", "core")
    found = found.agg(F.max("angle").alias("radius"), F.sum("weight").alias("weight"), F.min("node").alias("first"))
    return members.select("node", "dim", "core"), written(found.join(centres, ["dim", "core"]), "cores")


_PLACE = ["dim", "at", "bucket"]


def _entries(codes: DataFrame, members: DataFrame) -> DataFrame:
    """dim, at (the table), bucket, node, core, own: a row for each bucket that a node
    lies in (own) or looks into, of those in which nodes can meet that are not linked
    by their core already."""
    probes = F.col("probes")
    rows = codes.join(members.drop("dim"), "node", "left")
    rows = rows.select("node", "dim", F.coalesce("core", F.lit(FREE)).alias("core"), (F.size("codes") / TABLES).cast("int").alias("probes"),
                       F.posexplode("codes").alias("pos", "bucket"))
    rows = rows.select(
        "dim", F.floor(F.col("pos") / probes).cast("int").alias("at"), "bucket", "node", "core", (F.col("pos") % probes == 0).alias("own")
    )
    live = rows.groupBy(*_PLACE).agg(
        F.count("*").alias("n"), F.max("own").alias("owned"), F.min("core").alias("least"), F.max("core").alias("most")
    )
    live = live.where(F.col("owned") & (F.col("n") > 1) & ((F.col("least") != F.col("most")) | (F.col("least") == FREE)))
    return rows.join(written(live.select(*_PLACE), "live"), _PLACE)


def _unit_pairs(entries: DataFrame) -> DataFrame:
    """dim, at, bucket, u, v, nu, nv: parts of a bucket by core that are to meet (u <= v)
    with the numbers of their nodes; nodes without a core are one part."""
    units = entries.groupBy(*_PLACE, "core").agg(F.count("*").alias("n"), F.max("own").alias("owned"))
    units = written(units, "units")
    one = units.select(*_PLACE, F.col("core").alias("u"), F.col("n").alias("nu"), F.col("owned").alias("ou"))
    two = units.select(*_PLACE, F.col("core").alias("v"), F.col("n").alias("nv"), F.col("owned").alias("ov"))
    met = one.join(two, _PLACE).where((F.col("u") < F.col("v")) | ((F.col("u") == F.col("v")) & (F.col("u") == FREE) & (F.col("nu") > 1)))
    return met.where(F.col("ou") | F.col("ov")).drop("ou", "ov")


def _whole_links(pairs: DataFrame, cores: DataFrame, limit: float) -> DataFrame:
    """u, v, dim: cores that are linked as a whole, each node with each."""
    met = pairs.where((F.col("u") != FREE) & (F.col("v") != FREE)).select("dim", "u", "v").distinct()
    sides = []
    for name in ("u", "v"):
        sides.append(cores.select("dim", F.col("core").alias(name), F.col("centre").alias(f"c{name}"), F.col("radius").alias(f"r{name}")))
    met = _angles(met.join(sides[0], ["dim", "u"]).join(sides[1], ["dim", "v"]), "cu", "cv")
    return met.where(F.col("angle") + F.col("ru") + F.col("rv") <= limit - MARGIN).select("dim", "u", "v")


def _tiles(pairs: DataFrame, entries: DataFrame) -> DataFrame:
    """tile, bin, at, bucket, side, node: every node for each tile it is in. A tile is two blocks
    of two parts of a bucket, or one block of a part; small tiles share a bin."""
    blocks = lambda n: F.ceil(F.col(n) / BLOCK_ROWS)
    tiles = pairs.withColumns({"bu": blocks("nu"), "bv": blocks("nv")})
    tiles = tiles.withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bu") - 1)))
    start = F.when(F.col("u") == F.col("v"), F.col("x")).otherwise(0)
    tiles = tiles.withColumn("y", F.explode(F.sequence(start, F.col("bv") - 1)))
    tiles = written(tiles.withColumn("tile", F.monotonically_increasing_id()), "tiles")
    rows = tiles.agg(F.sum(F.col("nu") / F.col("bu") + F.col("nv") / F.col("bv"))).head()[0] or 0
    bins = max(1, math.ceil(rows / BIN_ROWS))

    def side(number: int, part: str, block: str, number_of: str, of: DataFrame) -> DataFrame:
        of = of.select(*_PLACE, F.col(part).alias("core"), F.col(block).alias("block"), F.col(number_of).alias("blocks"), "tile")
        met = entries.join(of, [*_PLACE, "core"]).where(F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")) == F.col("block"))
        return met.select("tile", "at", "bucket", F.lit(number).alias("side"), "node")

    apart = (F.col("u") != F.col("v")) | (F.col("x") != F.col("y"))
    found = side(0, "u", "x", "bu", tiles).unionByName(side(1, "v", "y", "bv", tiles.where(apart)))
    return found.withColumn("bin", F.pmod(F.xxhash64("tile"), F.lit(bins)))


def _reached(one: np.ndarray, two: np.ndarray, n: int) -> np.ndarray:
    """Of each of n nodes the smallest that it is connected with by the pairs."""
    first = np.arange(n)
    while True:
        least = np.minimum(first[one], first[two])
        then = first.copy()
        np.minimum.at(first, one, least)
        np.minimum.at(first, two, least)
        first = first[first]
        if (first == then).all():
            return first


def _compared(dealt: DataFrame, codes: DataFrame, cosine: float) -> DataFrame:
    """node, weight, reached: of every tile the nodes with links in it, the weight of what
    they are linked with and a node they are connected with."""
    rows = dealt.join(codes.select("node", "weight", "vector", "codes"), "node")

    def tile(part: pa.Table) -> list[np.ndarray]:
        x = _unit(_matrix(part.column("vector")))
        weight, node, side = (np.asarray(part.column(c)) for c in ("weight", "node", "side"))
        codes = np.asarray(part.column("codes").combine_chunks().flatten()).reshape(len(x), TABLES, -1)
        at, bucket = part.column("at")[0].as_py(), part.column("bucket")[0].as_py()
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1)
        if len(right):
            i, j = np.nonzero(x[left] @ x[right].T >= cosine)
            i, j = left[i], right[j]
        else:
            i, j = np.nonzero(np.triu(x @ x.T >= cosine, 1))
        looks = [(codes[a, :, :1] == codes[b]).any(axis=2) for a, b in ((i, j), (j, i))]
        met = looks[0] | looks[1]
        # Where both look at each other the bucket of the smaller node counts.
        low, high = np.where(node[i] < node[j], i, j), np.where(node[i] < node[j], j, i)
        other = (codes[high, at, :] == codes[low, at, :1]).any(axis=1)
        here = np.where(other, codes[low, at, 0], codes[high, at, 0]) == bucket
        counts = met[:, at] & here & ~met[:, :at].any(axis=1)
        i, j = i[counts], j[counts]
        linked = np.bincount(i, weight[j], len(x)).astype(np.int64) + np.bincount(j, weight[i], len(x)).astype(np.int64)
        first = _reached(i, j, len(x))
        held = linked > 0
        return [node[held], linked[held], node[first[held]]]

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by("tile")
        ids = np.asarray(part.column("tile"))
        edges = np.append(np.flatnonzero(np.diff(ids, prepend=ids[0] - 1)), len(ids))
        found = [tile(part.slice(i, j - i)) for i, j in itertools.pairwise(edges)]
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["node", "weight", "reached"])

    return rows.groupBy("bin").applyInArrow(run, "node long, weight long, reached long")


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """key, n_links, component_id, kept of every row.

    Vectors whose cosine is found to be ``cosine`` or more, in double precision, are
    linked; none below is. ``n_links`` counts the other rows that a row is linked with,
    equal vectors included; component_id is the smallest key reachable, its own included,
    and kept says whether that is its own. Pairs at a cosine of 0.95 are missed with a
    chance of about 0.001, closer ones far more rarely.

    Vectors that are null or empty, zero, or hold nulls or values that are not finite are
    linked with nothing: their component is their own key and they are kept. Vectors of
    different lengths are not linked. Rows with a null key are linked like others, but
    are nobody's component as long as a key is there. Rows that repeat a key and a vector
    are linked with each other. An empty table gives an empty table; other columns are
    not read.
    """
    limit = math.acos(cosine)
    taken = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    named = written(_named(taken), "vectors")
    rows = named.select("key", "name")
    classes = named.where(F.col("name").isNotNull()).groupBy("name").agg(
        F.min("key").alias("key"), F.count("*").alias("weight"), F.first("vector").alias("vector")
    )
    dim = (F.octet_length("vector") / 8).cast("int").alias("dim")
    classes = written(classes.select("name", "key", "weight", "vector", dim, F.monotonically_increasing_id().alias("node")), "classes")
    codes = written(_hashed(classes.select("node", "weight", "vector", "dim"), classes.count()), "codes")

    members, cores = _cores(codes, limit)
    entries = written(_entries(codes, members), "entries")
    pairs = written(_unit_pairs(entries), "unit-pairs")
    whole = written(_whole_links(pairs, cores, limit), "whole")
    pairs = pairs.join(whole, ["dim", "u", "v"], "left_anti")
    tiles = written(_compared(_tiles(pairs, entries), codes, cosine), "compared")

    both = whole.unionByName(whole.select("dim", F.col("v").alias("u"), F.col("u").alias("v")))
    heavy = cores.select("dim", F.col("core").alias("v"), "weight", F.col("first").alias("other"))
    around = both.join(heavy, ["dim", "v"]).groupBy("dim", F.col("u").alias("core")).agg(F.sum("weight").alias("beside"), F.min("other").alias("other"))
    weights = cores.join(around, ["dim", "core"], "left").select(
        "dim", "core", (F.col("weight") + F.coalesce("beside", F.lit(0))).alias("in_core"), "first", "other"
    )
    of_tiles = tiles.groupBy("node").agg(F.sum("weight").alias("in_tiles"))
    # Joined with the members first: most nodes have no core, and would meet in one task.
    of_core = members.join(weights, ["dim", "core"]).select("node", "in_core", "first", "other")
    linked = classes.join(of_core, "node", "left").join(of_tiles, "node", "left")
    n_links = F.coalesce("in_core", F.col("weight")) - 1 + F.coalesce("in_tiles", F.lit(0))
    linked = written(linked.select("node", "name", "key", "first", "other", n_links.alias("n_links")), "linked")

    edges = tiles.select(F.col("node").alias("a"), F.col("reached").alias("b"))
    edges = edges.unionByName(linked.where("first IS NOT NULL").select(F.col("node").alias("a"), F.col("first").alias("b")))
    edges = edges.unionByName(linked.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")).distinct())
    found = components(edges)
    placed = linked.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("key").alias("component_id"))
    of_name = placed.join(least, "component").select("name", "n_links", "component_id")
    return _report(rows, of_name, key)


def _report(rows: DataFrame, of_name: DataFrame, key: str) -> DataFrame:
    own: Column = F.col("key")
    component = F.coalesce("component_id", own)
    return rows.join(of_name, "name", "left").select(
        own.alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(own).alias("kept"),
    )
