"""Nearest neighbours against brute force; ties, odd vectors and blocks."""

import numpy as np
import pytest

from tamarind.llm import ann as A


def brute(ids, x, k):
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for i in np.flatnonzero(ids % 10 == 0):
        s = (x * x[i]).sum(axis=1) / (norm * norm[i])
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_on_clusters_and_on_noise(spark):
    rng = np.random.default_rng(1)
    noise = rng.normal(size=(1200, 16))
    near = rng.normal(size=(24, 16)).repeat(50, axis=0) + 0.15 * rng.normal(size=(1200, 16))
    for x in (noise, near):
        x = x.astype(np.float32).astype(np.float64)
        ids = rng.permutation(1200)
        expected = brute(ids, x, 5)
        got = found(A.search(frame(spark, ids, x), lambda i: i % 10 == 0, parts=8, sample=600, block=100))
        hits = sum(len({a for a, _ in got[q]} & {a for a, _ in e}) for q, e in expected.items())
        assert got.keys() == expected.keys() and hits >= 0.9 * 5 * len(expected)
        scores = {(q, a): s for q, e in brute(ids, x, 1200).items() for a, s in e}
        assert all(abs(scores[q, a] - s) < 1e-12 for q, rows in got.items() for a, s in rows)


def test_few_parts_are_probed_where_vectors_cluster():
    rng = np.random.default_rng(2)
    near = rng.normal(size=(16, 32)).repeat(60, axis=0) + 0.1 * rng.normal(size=(960, 32))
    _, probes = A.fit(near, 8, 5)
    assert probes <= 3


def test_parts_are_balanced():
    x = A.unit_rows(np.random.default_rng(3).normal(size=(800, 8)))
    size = np.bincount(A.balanced_partition(A.neighbour_graph(x, 8), 8), minlength=8)
    assert size.min() >= 99 and size.max() <= 101


def test_ties_go_to_the_smaller_id(spark):
    x = np.tile([[1.0, 2.0, 3.0]], (40, 1))
    got = found(A.search(frame(spark, np.arange(40), x), lambda i: i % 10 == 0, block=7))
    assert [a for a, _ in got[0]] == [1, 2, 3, 4, 5] and [a for a, _ in got[10]] == [0, 1, 2, 3, 4]


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (8, [1.0, 0.1]), (None, [1.0, 0.0]), (9, [1.0, 2.0, 3.0]), (8, [1.0, 0.1]), (10, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS part", "2 AS block", "3 AS id", "4 AS v", "5 AS rank")
    got = found(A.search(df, lambda i: i % 10 == 0))
    assert {q: [a for a, _ in r] for q, r in got.items()} == {0: [8, 1, 10], 10: [1, 8, 0]}
    empty = A.search(df.limit(0), lambda i: i % 10 == 0)
    assert empty.collect() == [] and empty.columns == ["query_id", "rank", "vec_id", "score"]


def test_a_single_vector_has_no_neighbour(spark):
    assert A.search(frame(spark, [0], np.ones((1, 3))), lambda i: i % 10 == 0).collect() == []


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_keeps_k(k):
    x = np.random.default_rng(4).normal(size=(50, 4))
    q, i, s = A.nearest(np.array([0, 1]), x[:2], np.arange(50), x, k)
    assert np.bincount(q).tolist() == [k, k] and not (q == i).any() and (np.abs(s) <= 1 + 1e-12).all()


def by_id(ids, x, q, k):
    """Brute force: the best row of each other id, then the k best ids."""
    s = (x * x[q]).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (x[q] * x[q]).sum())
    best = {i: s[ids == i].max() for i in set(ids.tolist()) - {int(ids[q])}}
    return sorted(best, key=lambda i: (-best[i], i))[:k]


def test_a_repeated_id_takes_one_place(spark):
    """Id 1 repeats 12 times next to query 0, in equal and in other vectors; ids 2 to 5 repeat too."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(30, 4))
    near = x[0] + 0.01 * rng.normal(size=(6, 4))
    ids = np.concatenate([np.arange(30), np.full(12, 1), [2, 2, 3, 4, 5]])
    x = np.concatenate([x, near, near, x[2:4], x[3:6]]).astype(np.float32).astype(np.float64)
    got = found(A.search(frame(spark, ids, x), lambda i: i % 10 == 0, parts=1))
    assert {q: [a for a, _ in r] for q, r in got.items()} == {q: by_id(ids, x, q, 5) for q in (0, 10, 20)}
    assert got[0][0][0] == 1 and len(got[0]) == 5


def test_all_ids_where_fewer_than_k(spark):
    ids = np.array([0] + [1] * 9 + [2] * 7 + [3])
    x = np.random.default_rng(7).normal(size=(len(ids), 3)).astype(np.float32).astype(np.float64)
    got = found(A.search(frame(spark, ids, x), lambda i: i == 0))
    assert [a for a, _ in got[0]] == by_id(ids, x, 0, 5) and len(got[0]) == 3


def test_both_sides_of_a_group_are_bounded(spark):
    """400 queries and 900 candidates of one part: small groups, in which each pair meets once."""
    asked = spark.range(400).selectExpr("id", "array(1D) AS v", "0 AS part")
    indexed = spark.range(900).selectExpr("id", "array(1D) AS v", "0 AS part")
    sides = A._dealt(asked, indexed, 50)
    for side in sides:
        assert max(r["count"] for r in side.groupBy(*A._KEYS).count().collect()) < 100
    left, right = (d.withColumnRenamed("id", n) for d, n in zip(sides, ("q", "c")))
    pairs = left.drop("v").join(right.drop("v"), list(A._KEYS))
    assert pairs.count() == pairs.select("q", "c").distinct().count() == 400 * 900
