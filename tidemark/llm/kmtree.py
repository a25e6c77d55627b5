"""Nearest neighbours through a hierarchical k-means tree.

The top of the tree is fitted on a bounded sample; every row is then put into a
leaf.  A leaf with more than SPLIT_ROWS rows grows its own subtree where its
rows are, again on a bounded sample of them, level by level, so leaves stay of
bounded size however large the table is, and no task or driver holds the whole
tree.

A query takes nodes from a priority queue by the distance to their centroids,
so it meets leaves best bin first; in each leaf with a subtree it goes on there
in the same way.  How many leaves it visits is calibrated at each level: some
rows are compared with all rows exactly, and the visits are widened until the
neighbours found that way are reached at the wanted recall.

Of rows with equal vectors only the ``k`` + 1 with the smallest ids can be among
anybody's ``k`` nearest, so the others are no candidates, and a vector that a
third of all rows share fills no leaf.  Leaves and query lists of any size are
cut into blocks, each by its own count.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reach_workers
from .common import join_counted, materialise

#: Rows that one tree is fitted on, chosen by hash; children of a node; sample rows of a leaf; rounds of Lloyd's algorithm.
FIT_ROWS, BRANCHES, LEAF_ROWS, ROUNDS = 16_384, 8, 512, 8
#: Rows from which a leaf gets a subtree, and levels of trees at most (each divides by the number of leaves of one tree).
SPLIT_ROWS, LEVELS = 4_096, 4
#: Rows compared with all rows for calibration, and the recall they must reach.
CALIBRATION_ROWS, RECALL = 100, 0.97
#: Rows of a leaf, and of its queries, in one block.
BLOCK_ROWS = 8_192
#: Leaves of one tree at most.  Those of the tree that grew from leaf n have the numbers n * NUMBERS + 1 and on; those of the top tree 1 and on.
NUMBERS = 4_096


class Tree:
    """Centroids of all nodes, children of each node ([]: a leaf) and the leaf number of each leaf."""

    def __init__(self, sample: np.ndarray, leaf_rows: int, most: int):
        self.centroids: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self._grow(sample, np.random.default_rng(11), leaf_rows, most)
        self.centroids = np.array(self.centroids)
        self.leaf_of = {n: k for k, n in enumerate(n for n, c in enumerate(self.children) if not c)}
        #: Rows known to be in each leaf.
        self.counts = np.bincount(self.leaves(sample), minlength=len(self.leaf_of))

    def _grow(self, sample: np.ndarray, draw: np.random.Generator, leaf_rows: int, most: int) -> None:
        """Split the largest node first, as long as nodes have over ``leaf_rows`` rows and there are no more than ``most`` leaves."""
        todo: list[tuple[int, int, np.ndarray]] = []

        def add(rows: np.ndarray) -> int:
            node = len(self.children)
            self.centroids.append(rows.mean(0))
            self.children.append([])
            if len(rows) > max(leaf_rows, BRANCHES):
                heapq.heappush(todo, (-len(rows), node, rows))
            return node

        add(sample)
        leaves = 1
        while todo and leaves + BRANCHES - 1 <= most:
            _, node, rows = heapq.heappop(todo)
            centers = rows[draw.choice(len(rows), BRANCHES, replace=False)]
            for _ in range(ROUNDS):
                near = _squared(rows, centers).argmin(1)
                centers = np.array([rows[near == k].mean(0) if (near == k).any() else centers[k] for k in range(BRANCHES)])
            near = _squared(rows, centers).argmin(1)
            parts = [rows[near == k] for k in range(BRANCHES) if (near == k).any()]
            if len(parts) > 1:  # else all rows are the same
                self.children[node] = [add(p) for p in parts]
                leaves += len(parts) - 1

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of every row: the nearest child, level by level."""
        out, todo = np.zeros(len(rows), np.int64), [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            if not self.children[node]:
                out[at] = self.leaf_of[node]
            elif len(at):
                kids = self.children[node]
                near = _squared(rows[at], self.centroids[kids]).argmin(1)
                todo += [(kid, at[near == k]) for k, kid in enumerate(kids)]
        return out

    def visits(self, distances: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first, from a query's distances to all centroids."""
        queue = [(distances[0], 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                yield self.leaf_of[node]
            for kid in self.children[node]:
                heapq.heappush(queue, (distances[kid], kid))


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)


def nearest(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest rows of every query, its own id left out, by exact distance and then id: query positions, row positions and distances.

    Candidates come from a fast product form with a margin for its rounding;
    those within it are measured exactly.
    """
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    norms = (rows * rows).sum(1)
    few = min(k, len(rows))
    for at in range(0, len(queries) if few else 0, 256):
        part = queries[at : at + 256]
        own = (part * part).sum(1)
        rough = own[:, None] - 2 * part @ rows.T + norms
        rough[query_ids[at : at + 256][:, None] == ids] = np.inf
        limit = np.partition(rough, few - 1, axis=1)[:, few - 1] + 1e-9 * (norms.max() + own)
        near = (rough <= limit[:, None]) & np.isfinite(rough)
        step = max(1, 1_000_000 // (1 + near.sum(1).max()))  # equal distances can make the lists long
        for first in range(0, len(part), step):
            q, r = np.nonzero(near[first : first + step])
            q += first
            exact = np.sqrt(((rows[r] - part[q]) ** 2).sum(1))
            order = np.lexsort((ids[r], exact, q))
            q, r, exact = q[order], r[order], exact[order]
            best = np.arange(len(q)) - np.searchsorted(q, q) < k
            out.append((q[best] + at, r[best], exact[best]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def usable(vector: Column) -> Column:
    """Vectors without nulls and non-finite components that are not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    """Vectors held as the bytes of their doubles."""
    cells = column.to_pylist() if isinstance(column, pa.Array) else list(column)
    return np.frombuffer(b"".join(cells), np.float64).reshape(len(cells), -1)


_INDEX = "vec_id long, v binary, leaf long"


def _plain(batch: pa.RecordBatch) -> list[bytes]:
    lists = batch.column(1)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
    return [row.tobytes() for row in flat]


def _planted(rows: DataFrame, models: DataFrame, columns: str, visit: Callable[[Tree, pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Run ``visit`` over ``rows``, each beside the tree of its ``leaf``; rows of other leaves are left out.

    ``models`` (leaf, n, model) has one tree for each leaf; a leaf's rows are
    cut into parts of about SPLIT_ROWS, and each part gets the tree once.
    """
    names = [c.split()[0] for c in columns.split(", ")]
    counts = rows.groupBy(F.col("leaf").alias("leaf_")).agg(F.count("*").alias("n"))
    parts = counts.join(models.select(F.col("leaf").alias("leaf_")), "leaf_", "left_semi").withColumn("parts", F.ceil(F.col("n") / SPLIT_ROWS))
    parts = materialise(parts, "parts")
    cut = join_counted(rows.withColumn("leaf_", F.col("leaf")), parts, ["leaf_"], rows.count()).withColumn("part_", F.pmod(F.xxhash64("vec_id"), "parts")).select("leaf_", "part_", F.lit(None).cast("binary").alias("model_"), *names)
    heads = models.select(F.col("leaf").alias("leaf_"), F.col("model").alias("model_")).join(parts, "leaf_").withColumn("part_", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    heads = heads.select("leaf_", "part_", "model_", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in columns.split(", ")])
    dealt = heads.unionByName(cut).repartition("leaf_", "part_").sortWithinPartitions("leaf_", "part_", F.col("model_").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for batch in batches:
            heads = [i for i, m in enumerate(batch.column(2).is_valid().to_pylist()) if m]
            edges = [0, *heads, batch.num_rows]
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                if i in heads:
                    tree = pickle.loads(batch.column(2)[i].as_py())
                    i += 1
                if i < j:
                    yield visit(tree, batch.slice(i, j - i).select(names))

    return dealt.mapInArrow(run, schema)


def _split(index: DataFrame, level: int) -> tuple[DataFrame, DataFrame | None]:
    """``index`` with the leaves of more than SPLIT_ROWS rows split, and the subtrees (leaf, n, model); none if there are none."""
    large = index.groupBy("leaf").agg(F.count("*").alias("n")).filter(F.col("n") > SPLIT_ROWS)
    large = materialise(large, "large")
    if large.isEmpty():
        return index, None
    draw = F.pmod(F.xxhash64("vec_id", F.lit(level)), F.lit(1 << 30)) / float(1 << 30)
    sample = join_counted(index, large.withColumn("all", F.col("n")), ["leaf"], index.count()).filter(draw * F.col("all") < FIT_ROWS)

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n, drawn = int(rows["all"].iloc[0]), len(rows)
        tree = Tree(_matrix(rows["v"]), max(BRANCHES, LEAF_ROWS * drawn // n), NUMBERS)
        return pd.DataFrame({"leaf": [key[0]], "n": [n], "model": [pickle.dumps(tree)]}) if len(tree.leaf_of) > 1 else pd.DataFrame({"leaf": [], "n": [], "model": []})

    models = materialise(sample.select("leaf", "all", "v").groupBy("leaf").applyInPandas(fit, "leaf long, n long, model binary"), "models")
    if models.isEmpty():
        return index, None

    def put(tree: Tree, batch: pa.RecordBatch) -> pa.RecordBatch:
        leaf = batch.column(2).to_numpy() * NUMBERS + 1 + tree.leaves(_matrix(batch.column(1)))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf)], names=["vec_id", "v", "leaf"])

    split = _planted(index, models, _INDEX, put, _INDEX)
    whole = index.join(models.select("leaf"), "leaf", "left_anti").select("vec_id", "v", "leaf")
    return materialise(whole.unionByName(split), "index"), models


def nearest_neighbours(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = RECALL) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` (Euclidean distance, smallest first, ties to the smaller id).

    Queries are the rows whose id is divisible by ``every``; candidates all
    rows with another id.  Vectors that are null, zero or hold null or
    non-finite components take no part, nor do those of another length than
    most, nor rows with a null id.  Of repeated query ids one vector is
    searched; repeated candidate rows each count.  With fewer candidates than
    ``k`` all are returned; an empty table gives no rows.  Other columns are
    not read, whatever their names.
    """
    spark = vectors.sparkSession
    reach_workers(spark)
    clean = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    clean = clean.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    sizes = clean.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    clean = clean.filter(F.size("embedding") == sizes[0].d)
    by_hash = clean.orderBy(F.xxhash64("vec_id"), "vec_id")
    tree = Tree(np.array([r[0] for r in by_hash.select("embedding").limit(FIT_ROWS).collect()], np.float64), LEAF_ROWS, NUMBERS)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = _plain(batch)
                leaf = 1 + tree.leaves(np.frombuffer(b"".join(cells), np.float64).reshape(len(cells), -1))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells), pa.array(leaf)], names=["vec_id", "v", "leaf"])

    placed = materialise(clean.mapInArrow(put, _INDEX), "placed")
    queries = placed.filter(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    copies = Window.partitionBy("v").orderBy("vec_id")
    index = materialise(placed.withColumn("copy", F.dense_rank().over(copies)).filter(F.col("copy") <= k + 1).drop("copy"), "index")

    tree.counts[:] = 0
    for r in index.groupBy("leaf").count().collect():  # NUMBERS rows at most
        tree.counts[r["leaf"] - 1] = r["count"]
    levels: list[DataFrame] = []
    while len(levels) < LEVELS - 1:
        index, models = _split(index, len(levels))
        if models is None:
            break
        levels.append(models)
    share = recall ** (1 / (1 + len(levels)))
    known = _neighbours_of_some(index, k)
    rows = [(i, v.tobytes(), path) for i, v, leaf in known for path in [_path(leaf)]]
    many = _widened([_place(tree, np.frombuffer(v, np.float64), path[0] - 1) for _, v, path in rows], share)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _to_leaves(tree, batch, many, k, NUMBERS)

    columns = "vec_id long, v binary, leaf long"
    routed = queries.mapInArrow(first, columns)
    for depth, models in enumerate(levels, 1):
        below = spark.createDataFrame([(i, v, p[depth - 1], p[depth] - p[depth - 1] * NUMBERS - 1) for i, v, p in rows if len(p) > depth], "vec_id long, v binary, leaf long, child long")

        def measure(t: Tree, batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([_place(t, v, c) for v, c in zip(_matrix(batch.column(1)), batch.column(3).to_pylist(), strict=True)], pa.int64())], names=["place"])

        inner = _widened([r.place for r in _planted(below, models, f"{columns}, child long", measure, "place long").collect()], share)  # k * CALIBRATION_ROWS rows
        routed = materialise(routed, "routed")
        deeper = _planted(routed, models, columns, lambda t, batch, inner=inner: _to_leaves(t, batch, inner, k, NUMBERS, batch.column(2).to_numpy()), columns)
        routed = deeper.unionByName(routed.join(models.select("leaf"), "leaf", "left_anti").select("vec_id", "v", "leaf"))
    routed = materialise(routed.withColumnsRenamed({"vec_id": "query_id", "v": "query"}), "routed")

    rows_of = index.groupBy("leaf").agg(F.count("*").alias("rows"))
    blocks = routed.groupBy("leaf").agg(F.count("*").alias("asked")).join(rows_of, "leaf")
    blocks = materialise(blocks.select("leaf", "rows", "asked", F.ceil(F.col("rows") / BLOCK_ROWS).alias("row_parts"), F.ceil(F.col("asked") / BLOCK_ROWS).alias("query_parts")), "blocks")

    def dealt(side: DataFrame, n: str, own: str, mine: str, other: str) -> DataFrame:
        cut = join_counted(side, blocks.withColumn("n", F.col(n)), ["leaf"], side.count())
        cut = cut.withColumn(mine, F.pmod(F.xxhash64(own), f"{mine}s")).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}s") - 1)))
        return cut.withColumn("block", F.col("row_part") * F.col("query_parts") + F.col("query_part")).drop("rows", "asked", "row_part", "row_parts", "query_part", "query_parts")

    def search(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, query_ids = right["vec_id"].to_numpy(), left["query_id"].to_numpy()
        q, r, exact = nearest(query_ids, _matrix(left["query"]), ids, _matrix(right["v"]), k)
        return pd.DataFrame({"query_id": query_ids[q], "vec_id": ids[r], "score": exact})

    asked, held = dealt(routed, "asked", "query_id", "query_part", "row_part"), dealt(index, "rows", "vec_id", "row_part", "query_part")
    met = asked.groupBy("leaf", "block").cogroup(held.groupBy("leaf", "block")).applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _to_leaves(tree: Tree, batch: pa.RecordBatch, many: int, k: int, numbers: int, above: np.ndarray | None = None) -> pa.RecordBatch:
    """Each query of a batch once for each of its first ``many`` leaves, or more until they hold over ``k`` rows."""
    at, leaf = [], []
    for q, distances in enumerate(_squared(_matrix(batch.column(1)), tree.centroids)):
        base, room = 1 if above is None else int(above[q]) * numbers + 1, 0
        for visit, x in enumerate(tree.visits(distances)):
            if visit >= many and room > k:
                break
            room += tree.counts[x]
            at.append(q)
            leaf.append(base + x)
    at = pa.array(at, pa.int64())
    return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(leaf, pa.int64())], names=["vec_id", "v", "leaf"])


def _place(tree: Tree, vector: np.ndarray, leaf: int) -> int:
    """As how manieth a query meets a leaf."""
    return 1 + next(i for i, x in enumerate(tree.visits(_squared(vector[None], tree.centroids)[0])) if x == leaf)


def _path(leaf: int) -> list[int]:
    """The leaf numbers from the top tree's down to ``leaf``."""
    out = [leaf]
    while out[-1] > NUMBERS:
        out.append((out[-1] - 1) // NUMBERS)
    return out[::-1]


def _neighbours_of_some(index: DataFrame, k: int) -> list[tuple[int, np.ndarray, int]]:
    """Number and vector of CALIBRATION_ROWS rows with the leaf of each of their k nearest among all rows, found exactly."""
    sample = index.orderBy(F.xxhash64("vec_id", F.lit(-1)), "vec_id").limit(CALIBRATION_ROWS).collect()
    if not sample:
        return []
    ids, queries = np.array([r.vec_id for r in sample]), np.frombuffer(b"".join(r.v for r in sample), np.float64).reshape(len(sample), -1)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                q, r, exact = nearest(ids, queries, batch.column(0).to_numpy(), _matrix(batch.column(1)), k)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(batch.column(2).to_numpy()[r], pa.int64()), pa.array(exact)], names=["q", "leaf", "score"])

    order = Window.partitionBy("q").orderBy("score", "leaf")
    true = index.mapInArrow(compare, "q long, leaf long, score double").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return [(r.q, queries[r.q], r.leaf) for r in true.collect()]  # k * CALIBRATION_ROWS rows


def _widened(places: list[int], share: float) -> int:
    """How many leaves reach ``share`` of the neighbours, whose leaves come at these ``places``."""
    ordered = sorted(places)
    return ordered[min(len(ordered) - 1, int(np.ceil(share * len(ordered))))] if ordered else 1
