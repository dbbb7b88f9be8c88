"""Near-duplicates by an LSH forest over MinHash signatures.

Every set of word shingles has several signature orders, one per tree: paths of MinHash
values. Rows of a tree are sorted by path, so texts with long common prefixes stand next
to each other, and neighbours with a common prefix are candidates. How deep a prefix has
to be for two rows to meet follows from how crowded their region is: in a thin region
the first value suffices, in a crowded one only the nearest of the order meet. Sorting by
ranges splits regions of any size over tasks.

Candidates are confirmed on the full sets, and confirmed links give components. Where
more rows share a value than an order's neighbours reach, rows still apart are compared
in tiles: first their sketches, then the full sets of those that are likely.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanecost.llm.common import few, fresh, written
from lanecost.llm.words import word_ids

WORDS = 5
PERCENT = 75
TREES = 12
DEPTH = 6
NEIGHBOURS = 8
"""Rows of a tree's order that a row is compared with, in a region of any size."""
LIKELY = 0.5
"""Share of equal MinHash values from which a pair is confirmed: five standard deviations
below the smallest similarity that counts."""
ROWS_PER_TASK = 40_000
RUN_VALUES = 3
"""Consecutive values that rows of a crowded region share to be compared: 24 disjoint
runs of them, all missed at similarity 0.75 with a chance of 2e-6."""
TILE_ROWS = 1_024
TILE_BYTES = 16 << 20
"""Rows and bytes of sets in a block; a tile holds two blocks of a group of any size."""
COLUMNS = 2_048

_VALUES = TREES * DEPTH
_RANDOM = np.random.default_rng(20240229)
_FACTORS = _RANDOM.integers(0, 1 << 63, _VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, _VALUES, dtype=np.uint64) * np.uint64(2)
_PLACES = _RANDOM.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct 5-word shingles of a whole text as sorted 64-bit hashes. A-Z count as
    a-z. Fewer words are one shingle; none, or no text, an empty set."""
    ids, distinct = word_ids((text or "").encode().lower())
    if len(ids) == 0:
        return np.zeros(0, np.uint64)
    if len(ids) < WORDS:
        return np.array([xxhash.xxh64_intdigest(b" ".join(distinct[i] for i in ids), seed=1)], np.uint64)
    word = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))[ids]
    n = len(ids) - WORDS + 1
    total = np.zeros(n, np.uint64)
    for k in range(WORDS):
        total += word[k : k + n] * _PLACES[k]
    return np.unique(_mixed(total))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The MinHash values of a set that isn't empty, 32 bits each."""
    least = np.full(_VALUES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        values = shingles[i : i + 2048, None] * _FACTORS + _SHIFTS
        np.minimum(least, values.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, n_shingles, set_key (128 bits that name the set), paths (the values of all
    trees, highest byte first) and sketch (the lowest byte of each); of empty sets the
    last three are null."""
    schema = T.StructType([
        T.StructField("key", docs.schema[key].dataType),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_key", T.BinaryType()),
        T.StructField("paths", T.BinaryType()),
        T.StructField("sketch", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, paths, sketches = [], [], [], []
            for t in batch.column(1):
                found = shingle_set(t.as_py())
                sizes.append(len(found))
                if len(found):
                    values = minima(found)
                    names.append(xxhash.xxh128_digest(found.tobytes()))
                    paths.append(values.astype(">u4").tobytes())
                    sketches.append(values.astype(np.uint8).tobytes())
                else:
                    names.append(None), paths.append(None), sketches.append(None)
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
            values = [pa.array(v, k) for v, k in zip((sizes, names, paths, sketches), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *values], schema.names)

    return docs.select(key, text).mapInArrow(run, schema)


def candidates(classes: DataFrame, neighbours: int = NEIGHBOURS) -> DataFrame:
    """a, b (a < b), alike: pairs of nodes that stand close in some tree, once each, with
    their share of equal values. ``classes`` has node, n_shingles, paths, sketch."""
    rows = classes.select("node", "n_shingles", "sketch", "paths", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    rows = rows.select(
        "tree", F.expr(f"substring(paths, tree * {4 * DEPTH} + 1, {4 * DEPTH})").alias("path"), "node", "n_shingles", "sketch"
    )
    tasks = max(1, math.ceil(classes.count() * TREES / ROWS_PER_TASK))
    order = ["tree", "path", "node"]
    ordered = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    kind = classes.schema["node"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("alike", T.FloatType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A pair that a task's edge cuts apart in one tree meets in the others.
        carried: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            fresh_from = carried.num_rows if carried else 0
            now = pa.concat_tables([carried, now]).combine_chunks() if carried else now
            n = now.num_rows
            tree = np.asarray(now.column("tree"))
            size = np.asarray(now.column("n_shingles"))
            path = np.frombuffer(b"".join(now.column("path").to_pylist()), ">u4").reshape(n, DEPTH)[:, 0]
            sketch = np.frombuffer(b"".join(now.column("sketch").to_pylist()), np.uint8).reshape(n, _VALUES)
            node = now.column("node").combine_chunks()
            for s in range(1, min(neighbours, n - 1) + 1):
                i = np.arange(max(0, fresh_from - s), n - s)
                j = i + s
                met = (tree[i] == tree[j]) & (path[i] == path[j])
                low, high = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
                met &= 100 * low >= PERCENT * high  # else they cannot be similar enough
                i, j = i[met], j[met]
                if len(i) == 0:
                    continue
                alike = (sketch[i] == sketch[j]).mean(axis=1, dtype=np.float32)
                likely = alike >= LIKELY
                x, y = node.take(pa.array(i[likely])), node.take(pa.array(j[likely]))
                yield pa.RecordBatch.from_arrays([x, y, pa.array(alike[likely], pa.float32())], schema.names)
            carried = now.slice(max(0, n - neighbours))

    met = ordered.mapInArrow(scan, schema)
    return met.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("alike").alias("alike"))


def sets_of(docs: DataFrame, nodes: DataFrame, key: str, text: str) -> DataFrame:
    """node and its whole set, for the nodes (node, set_key) given."""
    named = docs.select(F.col(key).alias("node"), F.col(text).alias("text")).join(nodes, "node")
    schema = T.StructType([T.StructField("node", nodes.schema["node"].dataType), T.StructField("shingles", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = [], []
            for i, (t, name) in enumerate(zip(batch.column("text"), batch.column("set_key"), strict=True)):
                data = shingle_set(t.as_py()).tobytes()
                if xxhash.xxh128_digest(data) == name.as_py():  # a key may name several texts
                    at.append(i)
                    out.append(data)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(at, pa.int64())), pa.array(out, pa.binary())], schema.names
            )

    return named.mapInArrow(run, schema)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b whose whole sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    met = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "left", "right")
    kind = pairs.schema["a"].dataType

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right"), strict=True):
                one, two = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(one) > len(two):
                    one, two = two, one
                at = np.searchsorted(two, one)
                both = int((two[np.minimum(at, len(two) - 1)] == one).sum())
                keep.append(100 * both >= PERCENT * (len(one) + len(two) - both))
            chosen = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            yield chosen

    return met.mapInArrow(check, T.StructType([T.StructField("a", kind), T.StructField("b", kind)]))


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node of a or b.

    Alternating rounds: each node's larger neighbours are hung on its smallest one, then
    its smaller ones, until nothing moves. Each round is written, so a lost executor
    costs no more than that round. No node's neighbours are collected: the smallest is a
    partial aggregate, and joins on a hub's key can be split.
    """
    links = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")

    def hung(pairs: DataFrame, both: bool) -> DataFrame:
        """(u, v) with v < u; for each u the smallest of v and u, m; v hangs on m."""
        around = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else pairs
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = around.join(least, "u")
        if both:  # larger neighbours
            return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        hang = joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        return hang.where("u <> v").distinct()

    def mark(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head())

    now = mark(links)
    while True:
        links = written(hung(hung(links, True), False), "links")
        then, now = now, mark(links)
        if then == now:
            break
    tops = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """node, component by the pairs that full sets confirm.

    A large group of copies has many more pairs than it needs links. So every node's
    smallest likely neighbour is confirmed first, then a pair for any two components
    that candidates join, and at last all pairs that still lie in two components.
    """
    doubtful = 100 * F.col("alike") < PERCENT
    rank = F.struct(doubtful, "a", -F.col("alike"))
    chances = [
        lambda left: left.groupBy("b").agg(F.min_by("a", rank).alias("a")),
        lambda left: left.groupBy("ca", "cb").agg(F.min_by(F.struct("a", "b"), F.struct(-F.col("alike"), "a", "b")).alias("p")).select("p.*"),
        lambda left: left,
    ]
    left = pairs.withColumn("ca", F.col("a")).withColumn("cb", F.col("b"))
    found = None
    for chance in chances:
        chosen = written(chance(left).select("a", "b"), "chosen")
        links = confirmed(chosen, sets)
        if found is not None:
            links = links.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b")))
        found = components(links)
        side = found.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        other = found.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        left = left.drop("ca", "cb").join(chosen, ["a", "b"], "left_anti").join(side, "a", "left").join(other, "b", "left")
        left = left.withColumn("ca", F.coalesce("ca", "a")).withColumn("cb", F.coalesce("cb", "b")).where("ca <> cb")
        left = left.withColumns({"ca": F.least("ca", "cb"), "cb": F.greatest("ca", "cb")})
        left = written(left, "apart")
        if left.isEmpty():
            break
    return found


def _tiles(rows: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """The rows of each group in ``groups`` (by, n_blocks), once for each pair of blocks
    x <= y that they are in. Any two rows of a group meet in a tile."""
    dealt = rows.join(few(groups), by).withColumn("block", F.pmod(F.xxhash64("node", F.lit(5)), F.col("n_blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    return dealt.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")}).drop("block", "other", "n_blocks")


def _reached(met: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a symmetric matrix: every row that is met, beside the first row it is reached from."""
    first = np.full(len(met), -1)
    for i in np.flatnonzero(met.any(axis=1)):
        if first[i] < 0:
            edge = np.array([i])
            first[i] = i
            while len(edge):
                edge = np.flatnonzero(met[edge].any(axis=0) & (first < 0))
                first[edge] = i
    rows = np.flatnonzero((first >= 0) & (first != np.arange(len(met))))
    return rows, first[rows]


def _apart(part: pa.Table, size: np.ndarray) -> np.ndarray:
    """Pairs in two components whose sizes permit enough similarity."""
    component = np.asarray(part.column("component").combine_chunks().dictionary_encode().indices)
    low, high = np.minimum(size[:, None], size), np.maximum(size[:, None], size)
    return (component[:, None] != component) & (100 * low >= PERCENT * high)


def _links(part: pa.Table, met: np.ndarray) -> pa.Table:
    node = part.column("node").combine_chunks()
    rows, first = _reached(met)
    return pa.table({"a": node.take(pa.array(first, pa.int64())), "b": node.take(pa.array(rows, pa.int64()))})


def _pairs_type(df: DataFrame) -> T.StructType:
    kind = df.schema["node"].dataType
    return T.StructType([T.StructField("a", kind), T.StructField("b", kind)])


def neighbourhoods(classes: DataFrame, neighbours: int = NEIGHBOURS) -> DataFrame:
    """node, hood: nodes in crowded regions, in two components, that likely pairs connect.

    ``classes`` has node, n_shingles, paths, sketch, component. Crowded is a value at the
    head of a tree that more rows share than a row's neighbours reach. Every two of these
    rows that share ``RUN_VALUES`` values are compared by their sketches."""
    crowded = written(_crowded(classes, neighbours), "crowded")
    runs = range(_VALUES // RUN_VALUES)
    width = 4 * RUN_VALUES
    at = F.explode(F.array(*(F.lit(i) for i in runs))).alias("run")
    rows = crowded.select("node", "n_shingles", "sketch", "component", "paths", at)
    rows = rows.withColumn("path", F.expr(f"substring(paths, run * {width} + 1, {width})")).drop("paths")
    groups = rows.groupBy("run", "path").agg(
        F.ceil(F.count("*") / TILE_ROWS).alias("n_blocks"), F.min("component").alias("least"), F.max("component").alias("most")
    )
    groups = written(groups.where("least <> most").select("run", "path", "n_blocks"), "runs")

    def compare(part: pa.Table) -> pa.Table:
        n = part.num_rows
        sketch = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint8).reshape(n, _VALUES)
        same = np.zeros((n, n), np.uint8)
        for k in range(_VALUES):
            same += sketch[:, k, None] == sketch[:, k]
        return _links(part, _apart(part, np.asarray(part.column("n_shingles"))) & (same >= LIKELY * _VALUES))

    tiles = _tiles(rows, groups, ["run", "path"])
    likely = tiles.groupBy("run", "path", "x", "y").applyInArrow(compare, _pairs_type(classes))
    return components(likely).withColumnRenamed("component", "hood")


def _crowded(classes: DataFrame, neighbours: int) -> DataFrame:
    heads = classes.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))))
    heads = heads.select("set_key", "component", "tree", F.expr(f"substring(paths, tree * {4 * DEPTH} + 1, 4)").alias("head"))
    crowds = heads.groupBy("tree", "head").agg(
        F.count("*").alias("n"), F.min("component").alias("least"), F.max("component").alias("most")
    )
    crowds = written(crowds.where(f"n > {neighbours} + 1 AND least <> most").select("tree", "head"), "crowds")
    return classes.join(heads.join(few(crowds), ["tree", "head"]).select("set_key").distinct(), "set_key", "left_semi")


def _joined(hoods: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: links between components by the full sets of every two rows of a
    neighbourhood. ``hoods`` has node, hood, component."""
    rows = hoods.join(sets, "node").withColumn("size", F.octet_length("shingles").cast("long"))
    blocks = F.greatest(F.ceil(F.count("*") / TILE_ROWS), F.ceil(F.sum("size") / TILE_BYTES))
    groups = written(rows.groupBy("hood").agg(blocks.alias("n_blocks")), "hoods")

    def compare(part: pa.Table) -> pa.Table:
        n = part.num_rows
        size = np.asarray(part.column("size")) // 8
        every = np.frombuffer(b"".join(part.column("shingles").to_pylist()), np.uint64)
        _, column, held = np.unique(every, return_inverse=True, return_counts=True)
        shared = held > 1
        place = np.cumsum(shared) - 1
        owner, chosen = np.repeat(np.arange(n), size), shared[column]
        owner, column = owner[chosen], place[column[chosen]]
        by = np.argsort(column, kind="stable")
        owner, column = owner[by], column[by]
        both = np.zeros((n, n), np.float32)  # counts below 2**24 are exact
        for start in range(0, int(shared.sum()), COLUMNS):
            i, j = np.searchsorted(column, [start, start + COLUMNS])
            has = np.zeros((n, COLUMNS), np.float32)
            has[owner[i:j], column[i:j] - start] = 1
            both += has @ has.T
        both = both.astype(np.int64)
        return _links(part, _apart(part, size) & (100 * both >= PERCENT * (size[:, None] + size - both)))

    return _tiles(rows, groups, ["hood"]).groupBy("hood", "x", "y").applyInArrow(compare, _pairs_type(hoods))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", neighbours: int = NEIGHBOURS) -> DataFrame:
    """key, n_shingles, component_id, kept of every row.

    Sets with 100 * intersection >= 75 * union are linked; component_id is the smallest
    key reachable, kept says whether it is the row's own. Equal sets are one node. Null
    and empty texts have no shingles and are linked with nothing, so are rows with a null
    key: their component is their own key and they are kept. Rows that repeat a key
    and text share the result. An empty table gives an empty table; other columns are
    not read.
    """
    rows = written(signatures(docs, key, text), "signatures")
    usable = rows.where("n_shingles > 0 AND key IS NOT NULL")
    classes = written(
        usable.groupBy("set_key").agg(
            F.min("key").alias("node"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("paths").alias("paths"),
            F.first("sketch").alias("sketch"),
        ),
        "classes",
    )
    # A key with several texts is several classes with one node: linked by definition.
    pairs = written(candidates(classes, neighbours).where("a <> b"), "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = written(sets_of(docs, classes.select("node", "set_key").join(ends, "node"), key, text), "sets")

    final = _linked(pairs, sets)
    now = classes.join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    hoods = neighbourhoods(written(now, "linked"), neighbours).join(now.select("node", "component").distinct(), "node")
    hoods = written(hoods, "neighbourhoods")
    if not hoods.isEmpty():
        apart = sets_of(docs, classes.select("node", "set_key").join(hoods.select("node"), "node"), key, text)
        links = written(_joined(hoods, written(apart.distinct(), "sets")), "joined")
        final = components(links.unionByName(final.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    of_set = classes.join(final, "node", "left").select("set_key", F.coalesce("component", "node").alias("component"))
    own = rows.join(of_set, "set_key", "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    return own.select(
        F.col("key").alias(key),
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("key")).alias("kept"),
    )


def keep(docs: DataFrame, key: str = "doc_id", text: str = "text", neighbours: int = NEIGHBOURS) -> DataFrame:
    """One document of every component, with its own columns: the one with the smallest
    key, null keys last. Only confirmed near-duplicates go: rows that share a key but not
    their text are documents of their own, those without words all stay, and rows without
    a key are compared like any other."""
    row = fresh(docs, "row")
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = written(near_duplicates(rows.select(row, text), row, text, neighbours).select(F.col(row).alias("row"), "component_id"), "found")
    ranked = rows.select(F.col(row).alias("row"), F.struct(F.col(key).isNull(), F.col(key), F.col(row)).alias("rank")).join(found, "row")
    chosen = ranked.groupBy("component_id").agg(F.min_by("row", "rank").alias(row)).select(row)
    return rows.join(written(chosen, "chosen"), row, "left_semi").select(*docs.columns)
