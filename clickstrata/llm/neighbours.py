"""Nearest neighbours with vantage-point trees, one per shard.

The vectors are dealt to shards by a hash of their id. A shard's tree splits its vectors again
and again by their distance to one of them: the nearer half and the farther half, each with the
range of its distances. A query skips a half whose range is farther from the query's own
distance than its tenth-nearest vector so far (triangle inequality). The difference is first
multiplied by a factor: at one the search is exact, above it more is skipped.

Every query meets every shard: queries in blocks, shards as stored rows. The best of all shards
are ranked by Spark.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickstrata.llm.common import Workspace, workspace

#: Vectors of a shard and queries of a block, about.
SHARD_ROWS = 8192
BLOCK_ROWS = 1024

#: Vectors that are compared one by one instead of being split further.
LEAF_ROWS = 48

#: How far pruning goes beyond the triangle inequality; 1 is exact.
FACTOR = 1.15


class Tree:
    """A vantage-point tree over ``vectors``; halves are split by rank, so equal vectors do no
    harm. ``nodes``: (vantage row, rows of a leaf | (nearest, farthest, child) twice)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.nodes: list[tuple] = []
        if len(ids):
            self._split(np.argsort(ids, kind="stable"))

    def _split(self, rows: np.ndarray) -> int:
        number = len(self.nodes)
        self.nodes.append(())
        if len(rows) <= LEAF_ROWS:
            self.nodes[number] = (rows,)
            return number
        vantage, rest = rows[0], rows[1:]
        away = distances(self.vectors[rest], self.vectors[vantage])
        order = np.argsort(away, kind="stable")
        rest, away, half = rest[order], away[order], len(order) // 2
        near = (away[0], away[half - 1], self._split(rest[:half]))
        far = (away[half], away[-1], self._split(rest[half:]))
        self.nodes[number] = (vantage, near, far)
        return number


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(a - b).sum(axis=-1))


def exact_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same, added component by component: the same number in any engine."""
    return np.sqrt(np.cumsum(np.square(a - b), axis=-1)[..., -1])


class Search:
    """The ``k`` nearest of one tree for a block of queries together."""

    def __init__(self, tree: Tree, ids: np.ndarray, queries: np.ndarray, k: int, factor: float):
        self.tree, self.own, self.queries = tree, ids, queries
        self.factor = factor
        self.best = np.full((len(ids), k), np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        if tree.nodes:
            self._visit(0, np.arange(len(ids)))

    def _visit(self, number: int, who: np.ndarray) -> None:
        if not len(who):
            return
        node = self.tree.nodes[number]
        if len(node) == 1:
            for part in np.array_split(who, len(who) // 256 + 1):
                self._offer(part, node[0])
            return
        vantage, near, far = node
        away = self._offer(who, np.array([vantage]))[:, 0]
        inner = away - near[1] <= far[0] - away
        for mine, order in ((inner, (near, far)), (~inner, (far, near))):
            asking, at = who[mine], away[mine]
            for low, high, child in order:
                gap = np.maximum(np.maximum(low - at, at - high), 0.0) * self.factor
                self._visit(child, asking[gap <= self.best[asking, -1] * (1 + 1e-12)])

    def _offer(self, who: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Compare queries with vectors and keep the nearest, ties to the smaller id."""
        away = distances(self.queries[who][:, None, :], self.tree.vectors[rows][None, :, :])
        ids = np.broadcast_to(self.tree.ids[rows], away.shape)
        other = np.where(ids == self.own[who][:, None], np.inf, away)
        use = np.flatnonzero((other <= self.best[who, -1:]).any(axis=1))
        if len(use):
            rows_of = who[use]
            every = np.concatenate([self.best[rows_of], other[use]], axis=1)
            named = np.concatenate([self.found[rows_of], ids[use]], axis=1)
            order = np.lexsort((named, every), axis=-1)[:, : self.best.shape[1]]
            self.best[rows_of] = np.take_along_axis(every, order, axis=1)
            self.found[rows_of] = np.take_along_axis(named, order, axis=1)
        return away


# Spark -------------------------------------------------------------------------------------


def usable(vectors: DataFrame) -> DataFrame:
    """One row per id: ``vec_id`` and ``embedding`` as doubles.

    Rows take no part whose id or vector is null, or whose vector is empty, zero, or holds a
    null or a number that is not finite. Of several vectors of one id the smallest stays.
    """
    embedding = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint"), embedding.alias("embedding"))
    fine = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    some = F.exists("embedding", lambda x: x != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine & some)
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def _dealt(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows with the number of their part; parts hold about ``size`` vectors of one width."""
    parts = rows.count() // size + 1
    return rows.withColumn("width", F.size("embedding")).withColumn(
        name, F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    )


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("vec_id").to_numpy()
    flat = pa.concat_arrays([c.flatten() for c in table.column("embedding").chunks]).to_numpy()
    return ids, flat.reshape(len(ids), -1)


def build_index(vectors: DataFrame, work: Workspace, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard and width of vectors: the shard's tree. A table of ``work``."""

    def build(table: pa.Table) -> pa.Table:
        tree = Tree(*_arrays(table))
        return pa.table(
            {
                "shard": table.column("shard")[:1],
                "width": table.column("width")[:1],
                "tree": pa.array([pickle.dumps(tree)], pa.binary()),
            }
        )

    dealt = _dealt(vectors, shard_rows, "shard")
    trees = dealt.groupBy("shard", "width").applyInArrow(build, "shard int, width int, tree binary")
    return work.written(trees, "vantage-trees")


def search(
    index: DataFrame,
    queries: DataFrame,
    k: int = 10,
    factor: float = FACTOR,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every query but itself."""

    def pack(table: pa.Table) -> pa.Table:
        return pa.table(
            {
                "width": table.column("width")[:1],
                "block": pa.array([pickle.dumps(_arrays(table))], pa.binary()),
            }
        )

    blocks = _dealt(queries, block_rows, "number").groupBy("number", "width")
    blocks = blocks.applyInArrow(pack, "width int, block binary")

    def answer(batches):
        for batch in batches:
            for packed_tree, packed_block in zip(batch.column(0), batch.column(1), strict=True):
                ids, vectors = pickle.loads(packed_block.as_py())
                done = Search(pickle.loads(packed_tree.as_py()), ids, vectors, k, factor)
                tree, real = done.tree, np.isfinite(done.best)
                order = np.argsort(tree.ids)
                rows = order[np.searchsorted(tree.ids[order], done.found[real])]
                asked = np.broadcast_to(vectors[:, None, :], (*real.shape, vectors.shape[1]))[real]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.broadcast_to(ids[:, None], real.shape)[real]),
                        pa.array(done.found[real]),
                        pa.array(exact_distances(asked, tree.vectors[rows])),
                    ],
                    ["query_id", "vec_id", "score"],
                )

    pairs = index.join(blocks, "width").select("tree", "block").repartition(_pieces(index))
    found = pairs.mapInArrow(answer, "query_id bigint, vec_id bigint, score double")
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _pieces(index: DataFrame) -> int:
    """Tasks of a search: every tree may be searched at the same time."""
    return max(1, index.count())


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 10, factor: float = FACTOR
) -> DataFrame:
    """The ``k`` nearest by Euclidean distance of every row for which ``is_query`` holds.

    Candidates are all usable rows but the query's own, of the same width; with fewer than
    ``k``, all of them. Ties go to the smaller id. Empty tables give an empty result.
    """
    with workspace(vectors.sparkSession, "neighbours") as work:
        rows = work.written(usable(vectors), "vectors")
        return work.result(search(build_index(rows, work), rows.where(is_query), k, factor))
