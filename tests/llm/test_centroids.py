"""Centroid clustering against plain Python with unbounded integers."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tamarind.llm import centroids as C


def brute(rows, k, dim, rounds, scale=1024, seed="3"):
    kept = [(i, [math.floor(c * scale) for c in v]) for i, v in rows
            if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    cent = [x for _, x in order[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(cent))

    for _ in range(rounds):
        group = {}
        for _, x in kept:
            group.setdefault(nearest(x)[1], []).append(x)
        cent = [[sum(col) // len(group[j]) for col in zip(*group[j])] if j in group else c for j, c in enumerate(cent)]
    near = [(i, *nearest(x)) for i, x in kept]
    total = {}
    for _, d, j in near:
        total[j] = total.get(j, 0) + d
    return sorted(((i, j, d, total[j], sum(total.values()), tuple(cent[j])) for i, d, j in near), key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(r.centroid)) for r in C.cluster(df, **kw).collect()), key=str)


@pytest.mark.parametrize("rounds", [0, 1, 10])
def test_equals_brute_force(spark, rounds):
    rng = random.Random(rounds)
    rows = [(i, [rng.gauss(i % 5, 0.7) for _ in range(6)]) for i in range(300)]
    assert run(spark, rows, k=5, dim=6, rounds=rounds) == brute(rows, 5, 6, rounds)


def test_ties_repeats_and_odd_vectors(spark):
    rng = random.Random(4)
    rows = [(i, [float(rng.randint(-2, 2)), float(rng.randint(-2, 2))]) for i in range(60)]
    rows += rows[:20] + [(7, [0.5, -0.5]), (None, [1.0, 1.0]), (70, None), (71, [1.0]), (72, [None, 1.0]), (73, [float("nan"), 0.0]),
                         (74, [float("inf"), 0.0]), (75, [1.0, 2.0, 3.0]), (76, [-0.0004, 0.0004]), (77, [])]
    assert run(spark, rows, k=4, dim=2, rounds=10) == brute(rows, 4, 2, 10)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [1.0, 2.0]), (2, [3.0, -4.0])]
    assert run(spark, rows, k=8, dim=2, rounds=3) == brute(rows, 8, 2, 3)
    assert run(spark, [], k=8, dim=2, rounds=3) == [] == run(spark, [(1, None)], k=8, dim=2, rounds=3)


def test_equal_vectors_leave_centroids_empty(spark):
    rows = [(i, [1.0, 1.0]) for i in range(40)] + [(100, [9.0, 9.0])]
    got = run(spark, rows, k=3, dim=2, rounds=10)
    assert got == brute(rows, 3, 2, 10) and len({r[1] for r in got}) < 3


def test_a_component_beyond_the_range_is_an_error(spark):
    with pytest.raises(Exception, match="do not fit 64 bits"):
        run(spark, [(1, [1e300, 0.0]), (2, [0.0, 0.0])], k=1, dim=2, rounds=1)


def test_names_of_other_columns_do_not_matter(spark):
    rows = [(i, [float(i % 3), 1.0]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select(
        "*", *[F.lit("mine").alias(c) for c in ("x", "id", "dots", "cluster", "distance", "centroid")])
    got = C.cluster(df, k=2, dim=2)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"] and got.count() == 9


def test_only_moved_components_are_multiplied(spark):
    """The dot products after a move equal those computed from nothing."""
    import numpy as np
    rng = np.random.default_rng(2)
    x = rng.integers(-50, 50, (40, 4))
    state = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<int>")
    a, b = rng.integers(-50, 50, (3, 4)), None
    b = a.copy()
    b[1, 2] += 5
    moved = {r.id: r.dots for r in C.reassign(C.reassign(state, np.zeros_like(a), a), a, b).collect()}
    assert all(moved[i] == (b @ x[i]).tolist() for i in range(40))
