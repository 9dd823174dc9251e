"""Clusters of integer vectors: nearest centroids by a tournament of bisecting planes.

Between two centroids a < b lies the plane of points as near to one as to the other. Its normal
2 (c_a - c_b) and threshold |c_a|^2 - |c_b|^2 are integers and are computed once per pair and
round. A vector x is no farther from a than from b if x . normal >= threshold, so the sign of one
linear form decides a match, and zero favours the smaller number. A vector's centroids play in
the order of their numbers: the winner so far meets the next, k - 1 tests eliminate all but one,
and only the last assignment computes a distance, that to the winner.

Everything is exact. Components that are small enough (all of them, in practice) are computed in
64-bit integers, others in integers of any length. Each task reduces its vectors to sums per
cluster and component; Spark adds these up, and no more than k rows per component come to the
driver, in limbs of 30 bits so that sums of any size add up exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstrata.llm.common import Workspace, workspace

#: Components of a vector, factor before rounding down, centroids, rounds, text before an id
#: whose hash chooses the first centroids.
DIMENSION, SCALE, CLUSTERS, ROUNDS, SEED = 64, 64, 16, 3, "1:"

#: Bits of a limb.
LIMB = 30

Centroid = tuple[int, ...]


# Vectors -----------------------------------------------------------------------------------


def _whole(vector: Column, dimension: int) -> Column:
    """Exactly ``dimension`` components, none of them null, infinite or not a number."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce((F.size(vector) == dimension) & finite, F.lit(False))


def _limit(dimension: int) -> int:
    """Components below it leave room in 64 bits for every form and distance."""
    return 1 << ((62 - int(dimension).bit_length()) // 2 - 2)


def integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles; as Python integers if some do not fit the fast path."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors * scale)
    if not vectors.size or np.abs(scaled).max() < _limit(vectors.shape[1]):
        return scaled.astype(np.int64)
    # a double from 2^52 on is an integer itself
    exact = [
        int(np.floor(x * scale)) if abs(x) < 2**52 else int(x) * scale
        for x in vectors.ravel().tolist()
    ]
    return np.array(exact, dtype=object).reshape(vectors.shape)


def _blocks(batch: pa.RecordBatch, dimension: int, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and integer vectors of a batch, wide ones apart, so that they slow no others."""
    values = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    vectors = values.reshape(-1, dimension)
    narrow = np.abs(vectors).max(axis=1, initial=0) < _limit(dimension) // scale
    for rows in (np.flatnonzero(narrow), np.flatnonzero(~narrow)):
        if len(rows):
            yield rows, integers(vectors[rows], scale)


# Tournament --------------------------------------------------------------------------------


class Bisectors:
    """Normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids: list[Centroid]):
        dimension = len(centroids[0])
        self.centroids = np.array(centroids, dtype=object).reshape(-1, dimension)
        self.limit = _limit(dimension)
        wide = np.array([max(map(abs, c)) >= self.limit for c in centroids])
        self.rounds = []
        for b in range(1, len(centroids)):
            normals = 2 * (self.centroids[:b] - self.centroids[b])
            squares = (self.centroids[: b + 1] ** 2).sum(axis=1)
            thresholds = squares[:b] - squares[b]
            if not wide[: b + 1].any():
                normals, thresholds = normals.astype(np.int64), thresholds.astype(np.int64)
            self.rounds.append((normals, thresholds))

    def winners(self, vectors: np.ndarray) -> np.ndarray:
        """Number of each vector's nearest centroid; the smallest of several."""
        best = np.zeros(len(vectors), np.int64)
        for b, (normals, thresholds) in enumerate(self.rounds, 1):
            # one operand of Python integers makes the whole form exact in these
            form = (vectors * normals[best]).sum(axis=1) - thresholds[best]
            best[(form < 0).astype(bool)] = b
        return best

    def distances(self, vectors: np.ndarray, winners: np.ndarray) -> np.ndarray:
        """Squared distances to the winners."""
        centres = self.centroids[winners]
        if vectors.dtype != object and np.abs(self.centroids).max() < self.limit:
            centres = centres.astype(np.int64)
        return ((vectors - centres) ** 2).sum(axis=1)


# Rounds ------------------------------------------------------------------------------------


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, digit) pairs with ``value == sum(digit << LIMB * place)``."""
    place = 0
    while not -(1 << LIMB) <= value < 1 << LIMB:
        yield place, value & ((1 << LIMB) - 1)
        value >>= LIMB
        place += 1
    yield place, value


def _partial_sums(centroids: list[Centroid], scale: int):
    """A task's sums: (cluster, component, limb, digit); component ``dimension`` is the count."""
    dimension = len(centroids[0])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors = Bisectors(centroids)
        sums = np.zeros((len(centroids), dimension + 1), dtype=object)
        for batch in batches:
            for _, vectors in _blocks(batch, dimension, scale):
                winners = bisectors.winners(vectors)
                for cluster in np.unique(winners).tolist():
                    members = vectors[winners == cluster]
                    sums[cluster, :dimension] += members.sum(axis=0).astype(object)
                    sums[cluster, dimension] += len(members)
        rows = [
            (cluster, component, *limb)
            for cluster in range(len(centroids))
            if sums[cluster, dimension]
            for component in range(dimension + 1)
            for limb in _limbs(int(sums[cluster, component]))
        ]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["cluster", "component", "place", "digit"]
        )

    return run


def _moved(kept: DataFrame, centroids: list[Centroid], scale: int) -> list[Centroid]:
    """Centroids after a round: the floor of each component's mean; without vectors, as before."""
    sums = kept.select("vector").mapInArrow(
        _partial_sums(centroids, scale),
        "cluster bigint, component bigint, place bigint, digit bigint",
    )
    totals = sums.groupBy("cluster", "component", "place").agg(F.sum("digit").alias("digits"))
    dimension, values = len(centroids[0]), {}
    for row in totals.collect():  # at most k x (dimension + 1) x limbs of the widest double
        key = row.cluster, row.component
        values[key] = values.get(key, 0) + (row.digits << LIMB * row.place)
    return [
        tuple(values[c, i] // values[c, dimension] for i in range(dimension))
        if (c, dimension) in values
        else centroids[c]
        for c in range(len(centroids))
    ]


def kept_vectors(vectors: DataFrame, work: Workspace, dimension: int = DIMENSION) -> DataFrame:
    """Id and components (as ``vector``, doubles) of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    return work.written(
        vectors.select("vec_id", vector.alias("vector")).where(_whole(F.col("vector"), dimension)),
        "kept",
    )


def first_centroids(
    kept: DataFrame, k: int = CLUSTERS, scale: int = SCALE, seed: str = SEED
) -> list[Centroid]:
    """The vectors whose ids have the k smallest hashes, in the order of these."""
    rows = (
        kept.where("vec_id IS NOT NULL")
        .select(F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256).alias("hash"), "vector")
        .orderBy("hash", "vector")
        .limit(k)
        .collect()
    )
    return [
        tuple(int(x) for x in integers(np.array([row.vector], np.float64), scale)[0]) for row in rows
    ]


def fit_centroids(
    kept: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: str = SEED,
) -> list[Centroid]:
    """Centroids after all rounds; none if no kept row has an id."""
    centroids = first_centroids(kept, k, scale, seed)
    for _ in range(rounds if centroids else 0):
        centroids = _moved(kept, centroids, scale)
    return centroids


def assign(kept: DataFrame, centroids: list[Centroid], scale: int = SCALE) -> DataFrame:
    """Each kept vector with its ``cluster`` and squared ``distance`` (null beyond 64 bits)."""
    id_type, dimension = kept.schema["vec_id"].dataType.simpleString(), len(centroids[0])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors = Bisectors(centroids)
        for batch in batches:
            clusters = np.zeros(batch.num_rows, np.int32)
            distances = np.zeros(batch.num_rows, dtype=object)
            for rows, vectors in _blocks(batch, dimension, scale):
                clusters[rows] = winners = bisectors.winners(vectors)
                distances[rows] = bisectors.distances(vectors, winners)
            fits = [d if d < 1 << 63 else None for d in distances.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(clusters), pa.array(fits, pa.int64())],
                ["vec_id", "cluster", "distance"],
            )

    return kept.select("vec_id", "vector").mapInArrow(
        run, f"vec_id {id_type}, cluster int, distance bigint"
    )


def _fitting(total: int | None) -> int | None:
    return total if total is not None and total < 1 << 63 else None


def _inertia(assigned: DataFrame) -> dict[int, int | None]:
    """Summed distances of each cluster that has vectors, at most k; null if a distance is."""
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    whole = F.count("distance") == F.count(F.lit(1))
    rows = assigned.groupBy("cluster").agg(F.when(whole, total).alias("total")).collect()
    return {r.cluster: None if r.total is None else int(r.total) for r in rows}


def cluster_vectors(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimension: int = DIMENSION,
    scale: int = SCALE,
    seed: str = SEED,
) -> DataFrame:
    """One row per row of ``vectors`` (``vec_id``, ``embedding``) whose vector takes part.

    Vectors that are null, of another length, or hold null or non-finite components take no part.
    ``cluster``, ``distance`` (squared, of the integer vectors), ``cluster_inertia`` and
    ``inertia`` (its sums) and ``centroid_sha256`` follow; a distance or sum beyond 64 bits is
    null. Rows that share an id or a vector are rows of their own; equal hashes order by vector.
    Rows without id are assigned like all others but start no centroid; if no row has an id, or
    the table is empty, the result is empty. Fewer than k rows make fewer centroids, equal ones
    leave all vectors to the one with the smallest number. Other columns are ignored.
    """
    spark = vectors.sparkSession
    with workspace(spark, "bisectors") as work:
        kept = kept_vectors(vectors, work, dimension)
        centroids = fit_centroids(kept, k, rounds, scale, seed)
        if not centroids:
            kept = kept.limit(0)  # a result with the same columns and no rows
            centroids = [(0,) * dimension]
        assigned = work.written(assign(kept, centroids, scale), "assigned")
        inertia = _inertia(assigned)
        known = None not in inertia.values()
        clusters = spark.createDataFrame(
            [
                (
                    number,
                    _fitting(inertia.get(number)),
                    _fitting(sum(inertia.values())) if known else None,
                    hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest(),
                )
                for number, centroid in enumerate(centroids)
            ],
            "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
        )
        return work.result(
            assigned.join(F.broadcast(clusters), "cluster").select(  # k rows
                "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
            )
        )
