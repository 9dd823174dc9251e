"""Clusters against plain loops over Python integers."""

import hashlib
import math
import random

import numpy as np

from clickstrata.llm import bisectors


def brute(rows, k=16, rounds=3, dimension=64):
    kept = []
    for vec_id, vector in rows:
        if vector is None or len(vector) != dimension:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, [int(x) * 64 if abs(x) >= 2**52 else math.floor(64 * x) for x in vector], vector))
    order = sorted(
        (hashlib.sha256(f"1:{i}".encode()).hexdigest(), doubles, v) for i, v, doubles in kept if i is not None
    )
    centroids = [v for _, _, v in order[:k]]
    if not centroids:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, v, _ in kept:
            members[nearest(v)[1]].append(v)
        centroids = [
            [sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(members, centroids)
        ]
    found = [(i, *nearest(v)) for i, v, _ in kept]
    inertia = [sum(d for _, d, c in found if c == n) for n in range(len(centroids))]

    def fits(x):
        return x if x < 2**63 else None

    return [
        (
            i, n, fits(d),
            None if any(fits(e) is None for _, e, m in found if m == n) else fits(inertia[n]),
            None if any(fits(e) is None for _, e, _ in found) else fits(sum(inertia)),
            hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest(),
        )
        for i, d, n in found
    ]


def found(spark, rows, **options):
    names = "vec_id bigint, embedding array<double>, cluster string, vector int, distance string"
    table = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], names)
    return [tuple(r) for r in bisectors.cluster_vectors(table, **options).collect()]


def same(left, right):
    return sorted(left, key=repr) == sorted(right, key=repr)


def vectors(n, seed=1, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, spread) for _ in range(64)]) for i in range(n)]


def test_clusters_match_plain_loops(spark):
    rows = vectors(400)
    rows += [(i, rows[3][1]) for i in range(1000, 1100)]  # a hot vector
    rows += [(7, rows[8][1]), (7, rows[7][1]), (7, rows[7][1]), (None, rows[9][1])]
    rows += [(2000, None), (2001, [1.0] * 63), (2002, [1.0] * 65), (2003, [])]
    rows += [(2004 + j, [0.5] * 63 + [x]) for j, x in enumerate([None, math.nan, math.inf, -math.inf])]
    result = found(spark, rows)
    assert len(result) == 504
    assert same(result, brute(rows))


def test_ties_and_few_rows(spark):
    rows = [(i, [float(i % 2)] * 64) for i in range(10)]
    assert same(found(spark, rows), brute(rows))
    assert {r[1] for r in found(spark, [(i, [0.25] * 64) for i in range(50)])} == {0}
    assert found(spark, []) == []
    assert found(spark, [(None, [0.0] * 64), (1, None)]) == []


def test_huge_components(spark):
    rows = vectors(60)
    rows += [(100, [1e300] + [0.0] * 63), (101, [-1.7e308] * 64), (102, [3e9] * 64), (103, [2.0**52 + 1] * 64)]
    rows += [(104 + i, [1e9 + i] * 64) for i in range(30)]
    assert same(found(spark, rows), brute(rows))


def test_other_settings(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-3, 3) for _ in range(3)]) for i in range(80)]
    result = found(spark, rows, k=4, rounds=2, dimension=3)
    assert same(result, brute(rows, k=4, rounds=2, dimension=3))


def test_tournament_agrees_with_distances():
    rng = np.random.default_rng(2)
    centroids = [tuple(int(x) for x in c) for c in rng.integers(-3, 4, (16, 5))]
    points = rng.integers(-4, 5, (3000, 5))
    squares = ((points[:, None, :] - np.array(centroids)[None]) ** 2).sum(axis=2)
    table = bisectors.Bisectors(centroids)
    winners = table.winners(points)
    assert (winners == squares.argmin(axis=1)).all()  # the first of equal distances
    assert (table.distances(points, winners) == squares.min(axis=1)).all()


def test_limbs_add_up():
    for value in (0, 1, -1, 2**30, -(2**30) - 1, 3**400, -(5**300)):
        assert sum(digit << 30 * place for place, digit in bisectors._limbs(value)) == value
        assert all(-(2**30) <= digit <= 2**30 for _, digit in bisectors._limbs(value))
