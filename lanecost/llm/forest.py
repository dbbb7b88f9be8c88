"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are fitted on a bounded sample, and every row is put into a leaf of each. A
query searches all trees through one priority queue, which always goes on at the node
whose splits it lies nearest to, until the leaves found hold enough rows. The rows of
these leaves are its candidates and are ranked by their exact inner products. How many
rows are enough is measured: some queries are compared with all rows, and the searches
go on until they would have met a stated share of those true neighbours.

Largest inner products become nearest directions by one more coordinate, which brings
all rows to the length of the longest (and is 0 for queries).
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanecost.llm.common import written

TREES = 12
ROWS_PER_LEAF = 200
"""Rows of a leaf, at most; no leaf is split that holds ``LEAST_LEAF`` sample rows or fewer."""
LEAST_LEAF = 16
SAMPLE_VALUES = 4_000_000
"""Bound of the sample that trees are fitted on, in vector components: 62,500 rows of 64."""
RECALL = 0.95
"""Share of the true neighbours of the probes that a search must meet."""
PROBES = 128
"""Queries that are compared with all rows, to measure how far a search must go."""
LEAST_ROWS = 500
FIRST = 24
"""Leaves from the queue's front that give each query a first bound."""
ROWS_PER_BLOCK = 4_096
QUERIES_PER_BLOCK = 2_048


class Forest:
    """Nodes of all trees: a row goes right where normal * row > offset. Children below 0
    are leaves, -1 - number."""

    def __init__(self, normals: np.ndarray, offsets: np.ndarray, children: np.ndarray, roots: np.ndarray, leaves: int) -> None:
        self.normals, self.offsets, self.children, self.roots, self.leaves = normals, offsets, children, roots, leaves

    def route(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of every row in every tree."""
        out = np.zeros((len(rows), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            at = np.full(len(rows), root, np.int64)
            going = np.flatnonzero(at >= 0)
            while len(going):
                node = at[going]
                side = np.einsum("ij,ij->i", rows[going], self.normals[node]) > self.offsets[node]
                at[going] = self.children[node, side.astype(np.int64)]
                going = going[at[going] >= 0]
            out[:, t] = -1 - at
        return out

    def search(self, margins: np.ndarray, sizes: np.ndarray, enough: float) -> list[int]:
        """Leaves in the order of the shared queue, until they hold enough rows.
        ``margins`` of the query at every node; ``sizes`` of the leaves."""
        queue = [(-math.inf, int(root)) for root in self.roots]
        heapq.heapify(queue)
        found: list[int] = []
        held = 0
        left, right = self.children[:, 0], self.children[:, 1]
        while queue and held < enough:
            far, node = heapq.heappop(queue)
            if node < 0:
                found.append(-1 - node)
                held += sizes[-1 - node]
                continue
            m = margins[node]
            heapq.heappush(queue, (max(far, m), int(left[node])))
            heapq.heappush(queue, (max(far, -m), int(right[node])))
        return found


def _tree(rows: np.ndarray, leaf: int, seed: int) -> tuple[list, list, list, int, int]:
    """Splits between two centres that a few rounds of 2-means give, as nodes; by a stack,
    so that a tree may be deep. Rows that are all alike stay in one leaf."""
    random = np.random.default_rng(seed)
    normals: list[np.ndarray] = []
    offsets: list[float] = []
    children: list[list[int]] = []
    leaves = 0
    root = 0
    todo = [(np.arange(len(rows)), -1, 0)]
    while todo:
        own, parent, side = todo.pop()
        split = None
        if len(own) > leaf:
            for _ in range(4):
                some = rows[random.choice(own, min(len(own), 256), replace=False)]
                a, b = some[0], some[1]
                for _ in range(5):
                    right = some @ (b - a) > (b @ b - a @ a) / 2
                    if right.all() or not right.any():
                        break
                    a, b = some[~right].mean(axis=0), some[right].mean(axis=0)
                size = float(np.linalg.norm(b - a))
                if size < 1e-12:
                    continue
                normal = ((b - a) / size).astype(np.float32)
                offset = float(normal @ (a + b) / 2)
                goes = rows[own] @ normal > offset
                if goes.all() or not goes.any():
                    continue
                split = (normal, offset, goes)
                if 0.1 < goes.mean() < 0.9:
                    break
        if split is None:
            leaves += 1
            name = -leaves
        else:
            name = len(normals)
            normals.append(split[0]), offsets.append(split[1]), children.append([0, 0])
            todo += [(own[~split[2]], name, 0), (own[split[2]], name, 1)]
        if parent < 0:
            root = name
        else:
            children[parent][side] = name
    return normals, offsets, children, root, leaves


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), dims)


def _lengthened(rows: np.ndarray, longest: float) -> np.ndarray:
    """Rows with the coordinate that brings them to the length of the longest."""
    rest = np.sqrt(np.maximum(longest**2 - np.einsum("ij,ij->i", rows, rows), 0))
    return np.column_stack([rows, rest]).astype(np.float32)


def fit(
    rows: DataFrame, dims: int, total: int, longest: float, trees: int = TREES, sample_values: int = SAMPLE_VALUES
) -> Forest:
    """A forest fitted on the rows first by hash, at most ``sample_values`` components in
    all, of ``total`` rows; each tree in a task of its own."""
    spark = rows.sparkSession
    most = max(2, sample_values // dims)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(most).select("vector").toArrow()
    data = spark.sparkContext.broadcast(_lengthened(_vectors(sample.column("vector").combine_chunks(), dims), longest))
    leaf = max(LEAST_LEAF, ROWS_PER_LEAF * len(data.value) // max(total, 1))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seed in batch.column("id").to_pylist():
                normals, offsets, children, root, leaves = _tree(data.value, leaf, seed)
                values = [seed, np.array(normals, np.float32).tobytes(), np.array(offsets).tobytes(), np.array(children, np.int64).tobytes(), root, leaves]
                kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], k) for v, k in zip(values, kinds, strict=True)],
                    ["id", "normals", "offsets", "children", "root", "leaves"],
                )

    shape = "id long, normals binary, offsets binary, children binary, root long, leaves long"
    grown = spark.range(0, trees, 1, trees).mapInArrow(grow, shape).collect()
    normals, offsets, children, roots, nodes, leaves = [], [], [], [], 0, 0
    for tree in sorted(grown, key=lambda x: x["id"]):
        own = np.frombuffer(tree["children"], np.int64).reshape(-1, 2)
        children.append(np.where(own >= 0, own + nodes, own - leaves))
        roots.append(tree["root"] + nodes if tree["root"] >= 0 else tree["root"] - leaves)
        normals.append(np.frombuffer(tree["normals"], np.float32).reshape(-1, dims + 1))
        offsets.append(np.frombuffer(tree["offsets"]))
        nodes += len(own)
        leaves += tree["leaves"]
    return Forest(np.concatenate(normals), np.concatenate(offsets), np.concatenate(children), np.array(roots), leaves)


def _usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id, vector of the rows that take part."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(key).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    return rows.select(F.col(key).alias("id"), v.alias("vector"))


def _best(found: DataFrame, k: int) -> DataFrame:
    """Of (query, id, score) each query's k best, once each, with their rank."""
    once = found.groupBy("query", "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _scaled(data: np.ndarray, longest: float) -> np.ndarray:
    """Queries, brought to the length of the longest row."""
    return data * (longest / np.linalg.norm(data, axis=1)[:, None])


def _true_neighbours(routed: DataFrame, probes: pa.Table, dims: int, k: int) -> DataFrame:
    """probe, leaves: of every probe, the leaves of each of the k rows nearest among all.
    A task keeps k rows a probe, whatever it reads."""
    names = np.asarray(probes.column("id"))
    data = _vectors(probes.column("vector").combine_chunks(), dims)
    sent = routed.sparkSession.sparkContext.broadcast((names, data))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, data = sent.value
        scores = np.full((len(names), k), -np.inf)
        leaves: np.ndarray | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            close = data @ _vectors(batch.column("vector"), dims).T
            close[names[:, None] == np.asarray(batch.column("id"))[None, :]] = -np.inf
            own = np.asarray(batch.column("leaves").flatten()).reshape(batch.num_rows, -1)
            if leaves is None:
                leaves = np.zeros((len(names), k, own.shape[1]), np.int64)
            few = min(k, batch.num_rows)
            at = np.argpartition(-close, few - 1, axis=1)[:, :few]
            all_scores = np.concatenate([scores, np.take_along_axis(close, at, axis=1)], axis=1)
            all_leaves = np.concatenate([leaves, own[at]], axis=1)
            keep = np.argpartition(-all_scores, k - 1, axis=1)[:, :k]
            scores = np.take_along_axis(all_scores, keep, axis=1)
            leaves = np.take_along_axis(all_leaves, keep[:, :, None], axis=1)
        if leaves is not None:
            i, j = np.nonzero(scores > -np.inf)
            width = leaves.shape[2]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(i) + 1) * width, pa.int32()), pa.array(leaves[i, j].ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(scores[i, j]), lists], ["probe", "score", "leaves"])

    found = routed.mapInArrow(best, "probe long, score double, leaves array<long>")
    order = Window.partitionBy("probe").orderBy(F.col("score").desc(), "leaves")
    return found.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= k).select("probe", "leaves")


def rows_until(truth: list[tuple[int, list[int]]], margins: np.ndarray, forest: Forest, sizes: np.ndarray) -> list[int]:
    """For every (query, leaves of a true neighbour), the rows that the query's search
    holds when it comes to the first of these leaves."""
    before: dict[int, np.ndarray] = {}
    for query in {q for q, _ in truth}:
        turn = np.array(forest.search(margins[query], sizes, math.inf), np.int64)
        held = np.zeros(forest.leaves, np.int64)
        held[turn] = np.cumsum(sizes[turn]) - sizes[turn]
        before[query] = held
    return [int(before[q][leaves].min()) for q, leaves in truth]


def _enough(
    routed: DataFrame, queries: DataFrame, forest: Forest, sizes: np.ndarray, dims: int, longest: float, k: int, recall: float
) -> float:
    """Rows that a search must hold, so that those of the probes (the ``PROBES`` queries
    first by hash) together meet the given share of their true neighbours."""
    probes = queries.orderBy(F.xxhash64("id"), "id").limit(PROBES).toArrow()
    if not probes.num_rows:
        return 0
    truth = [(r["probe"], r["leaves"]) for r in _true_neighbours(routed, probes, dims, k).collect()]  # PROBES * k at most
    if not truth:
        return 0
    data = _scaled(_vectors(probes.column("vector").combine_chunks(), dims), longest)
    needed = sorted(rows_until(truth, data.astype(np.float32) @ forest.normals[:, :-1].T - forest.offsets, forest, sizes))
    return needed[math.ceil(recall * len(needed)) - 1] + 1


def _ranked(rows: DataFrame, asked: DataFrame, dims: int, k: int) -> DataFrame:
    """query, id, score: of every block of rows, each asking query's k best that reach
    its bound, by inner products in double precision."""

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            ids = np.asarray(left.column("id"))
            data = _vectors(left.column("vector").combine_chunks(), dims)
            queries = _vectors(right.column("vector").combine_chunks(), dims)
            names, bounds = np.asarray(right.column("query")), np.asarray(right.column("bound"))
            close = queries @ data.T
            for i, name in enumerate(names):
                # candidates with a margin for rounding, then sums in one fixed order
                near = close[i]
                least = bounds[i]
                if len(near) > k + 1:
                    least = max(least, np.partition(near, len(near) - k - 1)[len(near) - k - 1])
                at = np.flatnonzero((near >= least - 1e-9 * max(1.0, abs(least))) & (ids != name))
                exact = (data[at] * queries[i]).sum(axis=1)
                by = np.lexsort((ids[at], -exact))[:k]
                out.append((np.full(len(by), name), ids[at][by], exact[by]))
        columns = [np.concatenate([x[c] for x in out]) if out else [] for c in range(3)]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query", "id", "score"])

    keys = ["leaf", "part", "group"]
    return rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(rank, "query long, id long, score double")


def nearest(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    trees: int = TREES,
    recall: float = RECALL,
    share: float | None = None,
    sample_values: int = SAMPLE_VALUES,
) -> DataFrame:
    """query_id, rank (from 1), ``key``, score: of every query its k nearest found.

    ``key`` is an integer; ``is_query`` says of a key whether it asks. Nearness is the inner product
    of the original vectors in double precision, largest first, ties to the smaller key;
    a query is no candidate of its own. Rows with a null key or a vector that is null,
    empty, zero or holds null or non-finite components take no part, nor do vectors of
    another length than most have (of equally frequent lengths the smaller counts). A key
    that several rows have counts once per query, by its best score; as a query it is
    one per row's vector, merged. Tables with fewer rows give all candidates; an empty
    table gives an empty one. Other columns are not read. All rows are indexed, and a
    leaf of any size, as of equal vectors, is cut into blocks.

    A search ends when its leaves hold as many rows (a row counted in each of its trees)
    as ``PROBES`` queries needed to meet ``recall`` of their true neighbours, or the given
    ``share`` of all rows. Vectors in clusters need few leaves, evenly spread ones many.
    """
    schema = T.StructType([
        T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()),
        T.StructField(key, T.LongType()), T.StructField("score", T.DoubleType()),
    ])
    spark = vectors.sparkSession
    rows = _usable(vectors, key, vector).withColumn("id", F.col("id").cast("long"))
    lengths = rows.groupBy(F.size("vector").alias("dims")).count().orderBy(F.col("count").desc(), "dims").limit(1)
    common = lengths.head()
    if common is None:
        return spark.createDataFrame([], schema)
    dims, total = common["dims"], common["count"]
    rows = rows.where(F.size("vector") == dims)
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    longest = math.sqrt(rows.agg(F.max(square)).head()[0])
    forest = spark.sparkContext.broadcast(fit(rows, dims, total, longest, trees, sample_values))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = forest.value.route(_lengthened(_vectors(batch.column("vector"), dims), longest))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(leaves) + 1) * leaves.shape[1], pa.int32()), pa.array(leaves.ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vector"), lists], ["id", "vector", "leaves"])

    kind = rows.schema["vector"].dataType.simpleString()
    routed = written(rows.mapInArrow(route, f"id long, vector {kind}, leaves array<long>"), "routed")
    counted = routed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect()  # at most one per leaf
    sizes = np.zeros(forest.value.leaves, np.int64)
    for row in counted:
        sizes[row["leaf"]] = row["count"]
    sent = spark.sparkContext.broadcast(sizes)
    queries = routed.where(is_query(F.col("id"))).select("id", "vector")
    number = queries.count()
    least = max(LEAST_ROWS, k + 1) * trees
    if share is None:
        enough = max(_enough(routed, queries, forest.value, sizes, dims, longest, k, recall), least)
    else:
        enough = max(share * total, least)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees_of = forest.value
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                data = _scaled(_vectors(part.column("vector"), dims), longest)
                margins = data.astype(np.float32) @ trees_of.normals[:, :-1].T - trees_of.offsets
                found = [trees_of.search(m, sent.value, enough) for m in margins]
                at = np.repeat(np.arange(len(found)), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(at)),
                        part.column("vector").take(pa.array(at)),
                        pa.array(np.concatenate(found), pa.int64()),
                        pa.array(np.concatenate([np.arange(len(f)) for f in found]), pa.int32()),
                    ],
                    ["query", "vector", "leaf", "turn"],
                )

    tasks = max(1, math.ceil(number / 256))
    asked = queries.repartition(tasks, "id").mapInArrow(search, f"query long, vector {kind}, leaf long, turn int")
    asked = written(asked, "searched")

    # blocks of rows and groups of queries by leaf; leaves that nobody asks are left out
    asks = asked.groupBy("leaf").count().collect()  # at most one per leaf
    shape = [
        (r["leaf"], max(1, math.ceil(int(sizes[r["leaf"]]) / ROWS_PER_BLOCK)), math.ceil(r["count"] / QUERIES_PER_BLOCK)) for r in asks
    ]
    by_leaf = F.broadcast(spark.createDataFrame(shape, "leaf long, parts int, groups int"))
    blocks = routed.select("id", "vector", F.explode("leaves").alias("leaf")).join(by_leaf, "leaf").select(
        "leaf",
        F.pmod(F.xxhash64("id", "vector"), "parts").cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"),
        "id",
        "vector",
    )
    asking = asked.join(by_leaf, "leaf").select(
        "leaf",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("query", "vector"), "groups").cast("int").alias("group"),
        "query",
        "vector",
        "turn",
    )
    first = asking.where(F.col("turn") < FIRST).withColumn("bound", F.lit(float("-inf")))
    front = written(_best(_ranked(blocks, first.drop("turn"), dims, k), k), "front")
    bounds = front.where(F.col("rank") == k).select(F.col("query").alias("bounded"), F.col("score").alias("bound"))
    later = asking.where(F.col("turn") >= FIRST).join(bounds, F.col("query") == F.col("bounded"), "left")
    later = later.withColumn("bound", F.coalesce("bound", F.lit(float("-inf")))).drop("turn", "bounded")
    rest = _ranked(blocks, later, dims, k)
    final = _best(front.select("query", "id", "score").unionByName(rest), k)
    return final.select(
        F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score"
    )
