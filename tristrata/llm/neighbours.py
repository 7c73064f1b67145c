"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is trained on a bounded sample; every vector is put into the leaf that it falls
to. A query visits leaves best bin first: a priority queue holds the open branches by the
inner product of the query with their centres. How many leaves are visited is
calibrated: for a bounded sample of queries the true neighbours are worked out against all
vectors, and the visits are widened until enough of them lie in visited leaves.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tristrata.llm.shared import ship, staged

NEAREST = 20
BRANCHES = 16
# Fixed bounds of the fit: vectors that train the tree, queries that calibrate the visits.
SAMPLE_ROWS = 32_768
CALIBRATION_QUERIES = 256
TARGET_RECALL = 0.97
LEAF_ROWS = 256
# Rows of one unit of work: a larger leaf is cut into blocks.
BLOCK_ROWS = 4096
# Leaves visited by the end of a round, times those by the end of the round before.
WIDENING = 4
QUERY_ROWS = 8192


@dataclass
class Tree:
    """Inner nodes have the centres of their children; a child below zero is leaf ``-1 - child``."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaves: int = 0

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: down to the nearest centre at every node."""
        out = np.zeros(len(vectors), np.int64)
        open_ = [(0, np.arange(len(vectors)))] if self.centres else []
        while open_:
            node, rows = open_.pop()
            centres = self.centres[node]
            nearest = (vectors[rows] @ centres.T - (centres * centres).sum(axis=1) / 2).argmax(axis=1)
            for i, child in enumerate(self.children[node]):
                here = rows[nearest == i]
                if len(here) and child < 0:
                    out[here] = -1 - child
                elif len(here):
                    open_.append((child, here))
        return out

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first."""
        if not self.centres:
            return [0]
        found: list[int] = []
        queue: list[tuple[float, int]] = [(0.0, 0)]
        while queue and len(found) < most:
            _, node = heapq.heappop(queue)
            if node < 0:
                found.append(-1 - node)
                continue
            for near, child in zip(self.centres[node] @ query, self.children[node]):
                heapq.heappush(queue, (-float(near), child))
        return found


def _cluster(vectors: np.ndarray, k: int, order: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centres = vectors[order.choice(len(vectors), k, replace=False)]
    for _ in range(rounds):
        own = (vectors @ centres.T - (centres * centres).sum(axis=1) / 2).argmax(axis=1)
        used = np.unique(own)
        centres = np.stack([vectors[own == i].mean(axis=0) for i in used])
    own = (vectors @ centres.T - (centres * centres).sum(axis=1) / 2).argmax(axis=1)
    return centres, own


def grow(sample: np.ndarray, leaf_rows: int, branches: int = BRANCHES, seed: int = 5) -> Tree:
    """Split nodes of more than ``leaf_rows`` sampled vectors by k-means."""
    tree, order = Tree(), np.random.default_rng(seed)
    if len(sample) <= leaf_rows:
        tree.leaves = 1
        return tree

    def split(vectors: np.ndarray) -> int:
        """The new node, or below zero a leaf."""
        if len(vectors) > leaf_rows:
            k = min(branches, max(2, len(vectors) // max(leaf_rows // 2, 1)))
            centres, own = _cluster(vectors, min(k, len(vectors)), order)
            groups = [vectors[own == i] for i in range(len(centres))]
            if max(map(len, groups)) < len(vectors):
                node = len(tree.centres)
                tree.centres.append(centres)
                tree.children.append([])
                tree.children[node] = [split(g) for g in groups]
                return node
        tree.leaves += 1
        return -tree.leaves

    if split(sample) < 0:
        return Tree(leaves=1)
    return tree


def usable(vector: Column) -> Column:
    """Neither null, nor empty, nor all zero, nor with a null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy()
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _best(queries: np.ndarray, points: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, point number and inner product of each query's best points, with all that
    tie with the last of them."""
    scores = queries @ points.T
    if scores.shape[1] > most:
        last = np.partition(scores, -most, axis=1)[:, -most]
        # A sum of products is off by its length times the rounding of the largest sum there could be.
        lengths = np.linalg.norm(queries, axis=1) * np.linalg.norm(points, axis=1).max()
        slack = 4 * queries.shape[1] * np.finfo(float).eps * lengths
        q, p = np.nonzero(~(scores < (last - slack)[:, None]))
    else:
        q, p = np.nonzero(np.ones(scores.shape, bool))
    # Summed again row by row, so that a pair's score does not depend on its batch.
    return q, p, (queries[q] * points[p]).sum(axis=1)


def _assigned(points: DataFrame, tree: Tree) -> DataFrame:
    shared = points.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.assign(_matrix(batch.column("vec")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])

    schema = "point bigint, asked boolean, ids array<bigint>, vec array<double>, leaf bigint"
    return points.mapInArrow(run, schema)


def _visits_needed(points: DataFrame, tree: Tree, nearest: int, target: float, queries: int) -> int:
    """The number of visits at which the sampled queries' true neighbours are in visited leaves."""
    rows = (
        points.where("asked").orderBy(F.xxhash64("point"), "point").limit(queries).select("point", "vec").collect()
    )
    if not rows or tree.leaves == 1:
        return 1
    asked = np.array([r.vec for r in rows])
    own = np.array([r.point for r in rows])
    shared = points.sparkSession.sparkContext.broadcast((asked, own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, numbers = shared.value
        held: list[tuple] = []
        for batch in batches:
            q, p, score = _best(vectors, _matrix(batch.column("vec")), nearest + 1)
            point = batch.column("point").to_numpy()[p]
            leaf = batch.column("leaf").to_numpy()[p]
            other = point != numbers[q]
            held.append((q[other], leaf[other], score[other]))
        if held:
            q, leaf, score = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((-score, q))
            place = np.arange(len(q)) - np.searchsorted(q[order], q[order])
            best = order[place < nearest]
            yield pa.RecordBatch.from_arrays(
                [pa.array(q[best]), pa.array(leaf[best]), pa.array(score[best])], names=["q", "leaf", "score"]
            )

    found = points.select("point", "vec", "leaf").mapInArrow(run, "q bigint, leaf bigint, score double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    true = found.withColumn("rank", rank).where(F.col("rank") <= nearest).select("q", "leaf").collect()
    if not true:
        return 1
    ranks = [{leaf: i for i, leaf in enumerate(tree.visits(v, tree.leaves))} for v in asked]
    needed = np.sort([ranks[r.q][r.leaf] for r in true])
    return int(needed[min(int(np.ceil(target * len(needed))), len(needed)) - 1]) + 1


def _search(points: DataFrame, tree: Tree, visits: int, nearest: int) -> DataFrame:
    """``asked, point, score``: each asked point's best points in the leaves it visits.

    Visits are widened in rounds of growing length. What a round returns must be as near as the
    last of the points that the rounds before it found, so a round adds few points a query.
    """
    shared = points.sparkSession.sparkContext.broadcast(tree)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = [shared.value.visits(v, visits) for v in _matrix(batch.column("vec"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("point"), batch.column("vec"), pa.array(leaves, pa.list_(pa.int64()))],
                names=["point", "vec", "leaves"],
            )

    asked = points.where("asked").select("point", "vec")
    routed = asked.mapInArrow(route, "point bigint, vec array<double>, leaves array<bigint>")
    routed = staged(routed)
    rank = F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("score")))
    found, done, until = None, 0, 1
    while done < visits:
        leaves = F.slice("leaves", done + 1, until - done)
        now = routed.select("point", "vec", F.explode(leaves).alias("leaf"))
        floor = F.lit(float("-inf"))
        if found is not None:
            last = found.withColumn("rank", rank).where(F.col("rank") == nearest + 1)
            now = now.join(last.select(F.col("asked").alias("point"), F.col("score").alias("last")), "point", "left")
            floor = F.coalesce("last", floor)
        new = staged(_visit(points, now.select("point", "vec", "leaf", floor.alias("floor")), nearest))
        found = new if found is None else found.union(new)
        done, until = until, WIDENING * until
    return found


def _visit(points: DataFrame, routed: DataFrame, nearest: int) -> DataFrame:
    """Visits ``point, vec, leaf, floor``: the best points of each leaf, none below the floor."""
    # One row a leaf, and the number of leaves is bounded by the size of the tree's sample.
    sizes = points.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    calls = routed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("parts"))
    units = F.broadcast(staged(sizes.join(calls, "leaf")))
    everywhere = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one_of = lambda n: F.pmod(F.xxhash64("point"), F.col(n)).cast("int")
    keys = ["leaf", "block", "part"]
    there = points.join(units, "leaf").select(
        "leaf", one_of("blocks").alias("block"), everywhere("parts").alias("part"),
        F.lit(0).alias("kind"), "point", "vec", F.lit(0.0).alias("floor"),
    )
    here = routed.join(units, "leaf").select(
        "leaf", everywhere("blocks").alias("block"), one_of("parts").alias("part"),
        F.lit(1).alias("kind"), "point", "vec", "floor",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, numbers, vectors = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = np.stack([batch.column(c).to_numpy() for c in (*keys, "kind")])
            cuts = [0, *(np.flatnonzero((table[:, 1:] != table[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                *key, kind = table[:, a].tolist()
                point = batch.column("point").to_numpy()[a:b]
                vec = _matrix(batch.column("vec").slice(a, b - a))
                if key != unit:
                    unit, numbers, vectors = key, [], []
                if kind == 0:
                    numbers.append(point)
                    vectors.append(vec)
                elif numbers:
                    number, vector = np.concatenate(numbers), np.concatenate(vectors)
                    numbers, vectors = [number], [vector]
                    floor = batch.column("floor").to_numpy()[a:b]
                    for at in range(0, len(point), 512):
                        q, p, score = _best(vec[at : at + 512], vector, nearest + 1)
                        # Both are summed in the same way.
                        near = score >= floor[at : at + 512][q]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(point[at : at + 512][q][near]), pa.array(number[p][near]), pa.array(score[near])],
                            names=["asked", "point", "score"],
                        )

    dealt = there.union(here).repartition(*keys).sortWithinPartitions(*keys, "kind")
    return dealt.mapInArrow(run, "asked bigint, point bigint, score double")


def nearest_neighbours(
    vectors: DataFrame,
    asked: Column,
    nearest: int = NEAREST,
    target: float = TARGET_RECALL,
    sample_rows: int = SAMPLE_ROWS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest rows of each row that ``asked`` picks.

    ``vectors`` has ``vec_id`` and ``embedding``; nearness is the inner product, ties go to the
    smaller vec_id. Rows without an id or with an unusable vector take no part, nor do vectors of
    another length than most. A row that is there twice counts once, and rows with a query's
    own id are not among its neighbours. Equal vectors are one point of the index with its
    ``nearest + 1`` smallest ids, which is all that a result can show of them; a crowd
    of copies is one row. Extra columns play no part; an empty table gives no rows.
    """
    ship(vectors.sparkSession)
    rows = vectors.where("vec_id is not null").where(usable(F.col("embedding"))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vec"),
        F.coalesce(asked, F.lit(False)).alias("asked"),
    )
    rows = rows.withColumn("key", F.unhex(F.sha2(F.col("vec").cast("string"), 256)))
    lengths = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width = lengths.n if lengths else 0
    rows = rows.where(F.size("vec") == width)

    first = Window.partitionBy("key").orderBy("vec_id")
    ids = rows.select("key", "vec_id").distinct().withColumn("nth", F.row_number().over(first))
    ids = ids.where(F.col("nth") <= nearest + 1).groupBy("key").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    distinct = rows.groupBy("key").agg(F.first("vec").alias("vec"), F.max("asked").alias("asked"))
    points = staged(distinct.join(ids, "key").withColumn("point", F.monotonically_increasing_id()))

    sample = points.orderBy(F.xxhash64("key"), "key").limit(sample_rows).select("vec").toArrow().column("vec")
    count = points.count()
    matrix = _matrix(sample.combine_chunks()) if len(sample) else np.zeros((0, width))
    # Leaves hold so many of all vectors, but at least 16 of the sample's.
    tree = grow(matrix, max(16, leaf_rows * len(matrix) // max(count, 1)))
    placed = staged(_assigned(points.select("point", "asked", "ids", "vec"), tree))
    visits = _visits_needed(placed, tree, nearest, target, CALIBRATION_QUERIES)
    found = _search(placed, tree, visits, nearest)
    rank = F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("score"), "first"))
    firsts = placed.select("point", "ids", F.col("ids")[0].alias("first"))
    best = (
        found.join(firsts, "point")
        .withColumn("nth", rank)
        .where(F.col("nth") <= nearest + 1)
        .select(F.col("asked").alias("point"), F.struct("score", "ids").alias("hit"))
        .groupBy("point")
        .agg(F.collect_list("hit").alias("hits"))
    )
    # From points to rows: each asked row takes its vector's hits, all copies of each in turn.
    queries = rows.where("asked").select(F.col("vec_id").alias("query_id"), "key").distinct()
    keyed = best.join(points.select("point", "key"), "point").select("key", "hits")
    each = queries.join(keyed, "key").select("query_id", F.inline("hits")).select(
        "query_id", "score", F.explode("ids").alias("vec_id")
    ).where("vec_id != query_id")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", place).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")
