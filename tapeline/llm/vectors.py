"""Nearest vectors by cosine: a hierarchical k-means tree with best-bin-first search.

The tree is fitted on a bounded sample of vectors and holds at most `MOST_LEAVES` leaves; every vector
is put into the leaf that it reaches by going to the nearest centre at each level. A search goes
through the tree by a priority queue: of all branches seen so far, the one whose centre is nearest is
opened next, until enough leaves are found. How many is calibrated: the exact neighbours of `PROBES`
vectors that the tree was not fitted on are found by going through the whole table once, and leaves are
added until the share of neighbours in them reaches `RECALL`. A search whose leaves hold fewer
vectors than an answer has goes on until they hold as many, so every answer is full.

Equal vectors form a class that is searched as one and known by its smallest ids, as many as an answer
can name. A leaf is split by hash into blocks of about `BLOCK` classes, its queries as well, and every
pair of blocks is compared in a task of its own, so neither a common vector nor a full leaf grows a
task. A search is compared with its nearest leaf first: whatever is farther than the answer found there
cannot be in the answer, and is not passed on from the other leaves.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm.common import hashed_sample, stored

SAMPLE = 20_000
BRANCHES = 16
LEAF = 200
MOST_LEAVES = 4_096
PROBES = 200
RECALL = 0.97
BLOCK = 2_000


@dataclass
class Tree:
    """Centres by node; children of a node; number of the leaf, or -1."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray

    @property
    def n_leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, unit: np.ndarray) -> np.ndarray:
        """Leaf of each unit vector."""
        leaf = np.zeros(len(unit), np.int64)
        todo = [(0, np.arange(len(unit)))]
        while todo:
            node, rows = todo.pop()
            below = self.children[node]
            if not below:
                leaf[rows] = self.leaf[node]
                continue
            nearest = np.argmax(unit[rows] @ self.centres[below].T, axis=1)
            todo += [(c, rows[nearest == i]) for i, c in enumerate(below) if (nearest == i).any()]
        return leaf

    def leaves(
        self, unit: np.ndarray, least: int, sizes: np.ndarray | None = None, enough: int = 0
    ) -> list[int]:
        """The first leaves for a vector, best bin first: `least` of them, and as many more as it takes
        for their `sizes` to add up to `enough`."""
        queue, found, held = [(-1.0, 0)], [], 0
        while queue and (len(found) < least or held < enough):
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                found.append(int(self.leaf[node]))
                held += 0 if sizes is None else int(sizes[found[-1]])
            for near, child in zip((self.centres[below] @ unit).tolist(), below, strict=True):
                heapq.heappush(queue, (-near, child))
        return found


def _split(unit: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Spherical k-means: the cluster of each row."""
    centres = unit[rng.choice(len(unit), k, replace=False)]
    for _ in range(8):
        cluster = np.argmax(unit @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cluster, unit)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centres)
    return np.argmax(unit @ centres.T, axis=1)


def fit_tree(unit: np.ndarray, leaves: int, branches: int = BRANCHES, seed: int = 7) -> Tree:
    """Split the largest leaf into up to `branches` until there are `leaves` of them."""
    rng = np.random.default_rng(seed)

    def centre(rows: np.ndarray) -> np.ndarray:
        total = unit[rows].sum(axis=0)
        return total / max(np.linalg.norm(total), 1e-12)

    every = np.arange(len(unit))
    centres, children = [centre(every)], [[]]
    open_leaves = [(-len(every), 0, every)]
    while len(open_leaves) < leaves:
        size, node, rows = heapq.heappop(open_leaves)
        k = min(branches, leaves - len(open_leaves), len(rows))
        cluster = _split(unit[rows], k, rng) if k > 1 else np.zeros(len(rows), int)
        parts = [rows[cluster == i] for i in range(k) if (cluster == i).any()]
        if len(parts) < 2:
            heapq.heappush(open_leaves, (size, node, rows))
            break
        for part in parts:
            children[node].append(len(centres))
            centres.append(centre(part))
            children.append([])
            heapq.heappush(open_leaves, (-len(part), len(centres) - 1, part))
    leaf = np.full(len(centres), -1)
    for i, (_, node, _) in enumerate(sorted(open_leaves, key=lambda x: x[1])):
        leaf[node] = i
    return Tree(np.array(centres), children, leaf)


def _matrix(vectors: pa.Array, dimension: int) -> np.ndarray:
    """Vectors that are known to be whole, as rows."""
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension).astype(np.float64)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a with the same row of b, in double precision."""
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def vector_classes(vectors: DataFrame, names: int, id_column: str, column: str) -> DataFrame:
    """Classes of equal usable vectors: `key`, `vector`, `ids` (the smallest, ascending), `first_id`.

    Ids are cut to the smallest in every task before they are shuffled, so a common vector sends a
    few ids per task.
    """
    usable = (
        vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(column).alias("vector"))
        .where(F.col("id").isNotNull() & F.col("vector").isNotNull())
        .where(
            F.expr(
                """forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))
                   AND exists(vector, x -> x <> 0)"""
            )
        )
    )
    # Zeros of either sign are equal.
    usable = usable.withColumn(
        "vector", F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x).cast("double"))
    )
    keyed = usable.select(
        F.struct(F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(1), "vector").alias("b")).alias("key"),
        "id",
        "vector",
    )

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            held: dict[tuple, list[int]] = {}
            row: dict[tuple, int] = {}
            for i, (k, one) in enumerate(zip(key, ids, strict=True)):
                k = (k["a"], k["b"])
                row.setdefault(k, i)
                held.setdefault(k, []).append(one)
            some = batch.take(pa.array(row.values(), pa.int64()))
            few = pa.array([sorted(set(x))[:names] for x in held.values()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [some.column(0), few, some.column(2)], ["key", "ids", "vector"]
            )

    partial = keyed.mapInArrow(
        smallest, "key struct<a: bigint, b: bigint>, ids array<bigint>, vector array<double>"
    )
    grouped = partial.groupBy("key").agg(
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, names).alias("ids"),
        F.first("vector").alias("vector"),
    )
    return grouped.withColumn("first_id", F.get("ids", F.lit(0)))


def _exact_leaf_ranks(classes: DataFrame, probes: pa.Table, tree: Tree, k: int, dimension: int) -> list:
    """For each neighbour of a probe, the place of its leaf in the probe's order of leaves.

    The whole table is compared with the probes, a fixed number, block by block.
    """
    asked = _unit(_matrix(probes.column("vector"), dimension))
    sent = classes.sparkSession.sparkContext.broadcast((asked, vars(tree)))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, parts = sent.value
        tree = Tree(**parts)
        score = np.full((len(asked), k + 1), -2.0)
        leaf = np.full((len(asked), k + 1), -1)
        for batch in batches:
            unit = _unit(_matrix(batch.column(0), dimension))
            where = tree.assign(unit)
            for first in range(0, len(unit), BLOCK):
                near = asked @ unit[first : first + BLOCK].T
                every = np.concatenate([score, near], axis=1)
                places = np.concatenate(
                    [leaf, np.broadcast_to(where[first : first + BLOCK], near.shape)], axis=1
                )
                top = np.argsort(-every, axis=1, kind="stable")[:, : k + 1]
                score = np.take_along_axis(every, top, axis=1)
                leaf = np.take_along_axis(places, top, axis=1)
        keep = leaf.ravel() >= 0
        columns = [
            pa.array(np.repeat(np.arange(len(asked)), k + 1)[keep], pa.int64()),
            pa.array(score.ravel()[keep], pa.float64()),
            pa.array(leaf.ravel()[keep], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["probe", "score", "leaf"])

    found = classes.select("vector").mapInArrow(best, "probe bigint, score double, leaf bigint")
    window = Window.partitionBy("probe").orderBy(F.col("score").desc(), "leaf")
    rows = found.withColumn("place", F.row_number().over(window)).where(F.col("place") <= k + 1)
    order = [{leaf: i for i, leaf in enumerate(tree.leaves(u, tree.n_leaves))} for u in asked]
    # The first place is the probe itself.
    return [order[r["probe"]][r["leaf"]] for r in rows.collect() if r["place"] > 1]


def _compared(askers: DataFrame, members: DataFrame, k: int, dimension: int) -> DataFrame:
    """`asker`, `key`, `score`: of each leaf's members the nearest to each of its askers, k and a few
    more per pair of blocks, as far as they are not below the asker's `floor`."""

    # Blocks of each leaf, on both sides: as many as its counts ask for. One row per leaf.
    def blocks(side: DataFrame) -> DataFrame:
        return side.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"))

    n_blocks = F.broadcast(
        blocks(members)
        .withColumnRenamed("n", "_members")
        .join(blocks(askers).withColumnRenamed("n", "_askers"), "leaf")
    )

    # Both sides' keys need the same types, as they are dealt out by their hashes.
    def block_of(count: str) -> Column:
        return F.pmod(F.xxhash64("key", F.lit(5)), F.col(count)).cast("int")

    right = (
        members.join(n_blocks, "leaf")
        .withColumn("m", block_of("_members"))
        .withColumn("q", F.explode(F.expr("sequence(0, _askers - 1)")))
        .select("leaf", "m", "q", "key", "vector")
    )
    left = (
        askers.join(n_blocks, "leaf")
        .withColumn("q", block_of("_askers"))
        .withColumn("m", F.explode(F.expr("sequence(0, _members - 1)")))
        .select("leaf", "m", "q", "key", "vector", "floor")
    )

    def compare(askers: pa.Table, members: pa.Table) -> pa.Table:
        a, b = (_matrix(t.column("vector"), dimension) for t in (askers, members))
        near = _unit(a) @ _unit(b).T if len(a) and len(b) else np.empty((len(a), 0))
        # A little more than is needed, so that rounding in the product cannot push out a tie.
        more = min(k + 4, near.shape[1])
        top = np.argpartition(-near, more - 1, axis=1)[:, :more] if more else np.empty((len(a), 0), int)
        left, right = np.repeat(np.arange(len(a)), more), top.ravel()
        score = _cosines(a[left], b[right])
        keep = score >= askers.column("floor").to_numpy()[left]
        left, right, score = left[keep], right[keep], score[keep]
        return pa.table(
            {
                "asker": askers.column("key").take(pa.array(left)),
                "key": members.column("key").take(pa.array(right)),
                "score": pa.array(score, pa.float64()),
            }
        )

    by = ["leaf", "m", "q"]
    kinds = "asker struct<a: bigint, b: bigint>, key struct<a: bigint, b: bigint>, score double"
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(compare, kinds)


def nearest_vectors(
    vectors: DataFrame,
    k: int = 5,
    queries: str = "vec_id % 50 = 0",
    id_column: str = "vec_id",
    column: str = "embedding",
    recall: float = RECALL,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row its `k` nearest other rows.

    `queries` says which rows ask; all rows answer. Ties go to the smaller id. Vectors that are null,
    zero, or have null or non-finite components take no part, nor do rows without an id, nor vectors
    of another length than most of the sample. Rows equal in id and vector count once; a row with the
    query's id is the query's own. A table without usable vectors gives no rows.
    """
    spark = vectors.sparkSession
    # A query can lose one id of a class to itself, and its own class of one to itself.
    classes = stored(vector_classes(vectors, k + 1, id_column, column), "vector-classes")
    every = classes.count()
    sample = hashed_sample(classes.select("key", "vector"), F.col("key"), SAMPLE + PROBES, every)
    sample = sample.select("key", "vector").toArrow()
    lengths = np.array([len(v) for v in sample.column("vector")], np.int64)
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    if not len(lengths):
        return spark.createDataFrame([], empty)
    dimension = int(np.bincount(lengths).argmax())
    sample = sample.filter(pa.array(lengths == dimension))
    classes = classes.where(F.size("vector") == dimension)
    n_classes = classes.count()
    leaves = max(1, min(MOST_LEAVES, n_classes // LEAF, sample.num_rows // 2))
    # The probes are not fitted on, so what holds for them holds for other vectors.
    n_probes = min(PROBES, sample.num_rows // 5)
    fitted, probes = sample.slice(n_probes), sample.slice(0, n_probes)
    tree = fit_tree(_unit(_matrix(fitted.column("vector"), dimension)), leaves)

    ranks = _exact_leaf_ranks(classes, probes, tree, k, dimension) if n_probes else []
    visits = 1
    if ranks:
        within = np.cumsum(np.bincount(ranks, minlength=tree.n_leaves)) / len(ranks)
        visits = int(np.searchsorted(within, recall)) + 1
    visits = min(visits, tree.n_leaves)
    sent = spark.sparkContext.broadcast(vars(tree))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(**sent.value)
        for batch in batches:
            leaf = tree.assign(_unit(_matrix(batch.column(3), dimension)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf)], ["key", "ids", "first_id", "vector", "leaf"]
            )

    kinds = "key struct<a: bigint, b: bigint>, ids array<bigint>, first_id bigint, vector array<double>"
    placed = stored(
        classes.select("key", "ids", "first_id", "vector").mapInArrow(place, f"{kinds}, leaf bigint"),
        "vector-leaves",
    )

    asking = vectors.where(F.expr(queries)).select(
        F.col(id_column).cast("bigint").alias("query_id"), F.col(column).alias("vector")
    )
    asking = asking.where(F.col("query_id").isNotNull() & F.col("vector").isNotNull()).select(
        "query_id",
        F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x).cast("double")).alias("v"),
    )
    asking = asking.select(
        "query_id",
        F.struct(F.xxhash64("v").alias("a"), F.xxhash64(F.lit(1), "v").alias("b")).alias("key"),
    ).distinct()
    asked = placed.join(asking.select("key").distinct(), "key", "left_semi").select("key", "vector")

    # One number per leaf.
    sizes = np.zeros(tree.n_leaves, np.int64)
    for row in placed.groupBy("leaf").count().collect():
        sizes[row["leaf"]] = row["count"]
    sent_sizes = spark.sparkContext.broadcast(sizes)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, sizes = Tree(**sent.value), sent_sizes.value
        for batch in batches:
            unit = _unit(_matrix(batch.column(1), dimension))
            found = [tree.leaves(u, visits, sizes, k + 1) for u in unit]
            # The nearest leaves that by themselves hold an answer.
            first = [
                i <= int(np.searchsorted(np.cumsum(sizes[f]), k + 1)) for f in found for i in range(len(f))
            ]
            some = batch.take(pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found])))
            leaf = pa.array([x for f in found for x in f], pa.int64())
            columns = [*some.columns, leaf, pa.array(first, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "vector", "leaf", "first"])

    kinds = "key struct<a: bigint, b: bigint>, vector array<double>, leaf bigint, first boolean"
    searches = stored(asked.mapInArrow(search, kinds), "vector-searches")

    nearby = searches.where("first").withColumn("floor", F.lit(-2.0))
    found = stored(_compared(nearby, placed, k, dimension), "vector-nearby")
    last = Window.partitionBy("asker").orderBy(F.col("score").desc())
    floors = (
        found.withColumn("_place", F.row_number().over(last))
        .where(F.col("_place") == k + 1)
        .select(F.col("asker").alias("key"), F.col("score").alias("floor"))
    )
    others = searches.where("NOT first").join(floors, "key", "left").fillna(-2.0, ["floor"])
    compared = found.unionByName(_compared(others, placed, k, dimension))
    names = classes.select("key", "ids", "first_id")
    best = Window.partitionBy("asker").orderBy(F.col("score").desc(), "first_id")
    top = (
        compared.join(names, "key")
        .withColumn("_place", F.row_number().over(best))
        .where(F.col("_place") <= k + 1)
        .select(F.col("asker").alias("key"), "score", F.explode("ids").alias("vec_id"))
    )
    final = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        asking.join(top, "key")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(final).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
