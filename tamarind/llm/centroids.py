"""Centroid clustering (operator 12): exact integer k-means on an incremental distance matrix.

Every vector keeps its exact integer dot product with every centroid. After a round only the
components of a centroid that changed are looked at: the dot products move by (change x
component), and the nearest centroid is read off anew from ``|c|^2 - 2 x.c``. A round reads
and writes the state table once (the written table cuts lineage, so a lost executor costs one
round at most); sums per cluster are added up in each task before their shuffle, so a cluster
that holds most vectors costs a few numbers per task. What reaches the driver are the k
centroids.

Rows: a vector that is null, has another number of components, or holds a null or non-finite
one takes no part; repeated rows count as often as they stand there; a null id comes after all
others in the choice of the first centroids, and rows with one id are told apart by their
components. Fewer vectors than centroids: as many centroids as vectors. Components beyond
+-131,072 are an error, since squared distances would no longer fit 64 bits. Other columns of
the input are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tamarind.llm.common import Workspace

CENTROIDS = 8
DIM = 64
ROUNDS = 10
SCALE = 1024
SEED = "3"
#: Largest integer component: the squared distance of two vectors then fits 64 bits.
LARGEST = 1 << 27


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """(id, x): the vectors that take part, each component as floor(scale * value)."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    usable = (F.size(v) == dim) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    # a vector beyond the range becomes one that the first round reports
    whole = F.transform(v, lambda c: F.greatest(F.least(F.floor(c * float(scale)), F.lit(LARGEST + 1)), F.lit(-LARGEST - 1)).cast("int"))
    return vectors.where(F.coalesce(usable, F.lit(False))).select(F.col(f"`{id_col}`").alias("id"), whole.alias("x"))


def first_centroids(kept: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The k vectors with the smallest sha256 of ``seed:id``."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    return [list(r.x) for r in kept.select("x", h.alias("h")).orderBy(F.col("h").asc_nulls_last(), "x").limit(k).collect()]


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    return np.asarray(col.flatten()).astype(np.int64).reshape(len(col), width)


def _rows(m: np.ndarray, kind: pa.DataType) -> pa.Array:
    off = pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1])
    return pa.ListArray.from_arrays(off, pa.array(np.ascontiguousarray(m).reshape(-1), kind))


def reassign(state: DataFrame, before: np.ndarray, now: np.ndarray) -> DataFrame:
    """The state after the centroids moved from ``before`` to ``now``: dot products changed by
    the components that moved, then the nearest centroid (ties: the smaller number)."""
    k, dim = now.shape
    fresh = "dots" not in state.columns
    change = now - before
    moved = [(c, np.flatnonzero(change[c])) for c in range(k)]
    norm = (now * now).sum(axis=1)
    schema = StructType([state.schema["id"], state.schema["x"], StructField("dots", ArrayType(LongType())),
                         StructField("cluster", IntegerType()), StructField("distance", LongType())])

    def run(batches):
        for b in batches:
            x = _matrix(b.column("x"), dim)
            if fresh and len(x) and np.abs(x).max() > LARGEST:
                raise ValueError(f"a component lies beyond +-{LARGEST}: its distances do not fit 64 bits")
            dots = np.zeros((len(x), k), np.int64) if fresh else _matrix(b.column("dots"), k).copy()
            for c, places in moved:
                if len(places):
                    dots[:, c] += x[:, places] @ change[c, places]
            far = norm - 2 * dots
            cluster = far.argmin(axis=1)
            distance = far[np.arange(len(x)), cluster] + (x * x).sum(axis=1)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("x"), _rows(dots, pa.int64()), pa.array(cluster, pa.int32()),
                                              pa.array(distance, pa.int64())], schema.names)

    return state.mapInArrow(run, schema)


def means(state: DataFrame, now: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count) of each cluster; an empty one keeps its centroid."""
    k, dim = now.shape

    def run(batches):
        total = np.zeros((k, dim + 1), np.int64)
        for b in batches:
            x, cluster = _matrix(b.column("x"), dim), np.asarray(b.column("cluster"))
            for c in range(k):
                own = x[cluster == c]
                total[c, :dim] += own.sum(axis=0)
                total[c, dim] += len(own)
        c, place = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(place, pa.int32()), pa.array(total[c, place], pa.int64())],
                                         ["cluster", "place", "total"])

    parts = state.select("x", "cluster").mapInArrow(run, "cluster int, place int, total long")
    total = [[0] * (dim + 1) for _ in range(k)]
    for r in parts.groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect():
        total[r.cluster][r.place] = r.total
    return np.array([[s // row[dim] for s in row[:dim]] if row[dim] else now[c] for c, row in enumerate(total)], np.int64)


def cluster(vectors: DataFrame, k: int = CENTROIDS, dim: int = DIM, rounds: int = ROUNDS, scale: int = SCALE, seed: str = SEED,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) of every vector that takes
    part, after ``rounds`` rounds and a last assignment. A round that moves no centroid is the
    last one needed: all later ones would assign alike."""
    spark = vectors.sparkSession
    ws = Workspace(spark, "centroids")
    state = ws.write(integer_vectors(vectors, id_col, vector_col, dim, scale), "vectors")
    first = first_centroids(state, k, seed)
    columns = (f"`{id_col}` {state.schema['id'].dataType.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, "
               "centroid array<long>")
    if not first:
        return spark.createDataFrame([], columns)
    now = np.array(first, np.int64)
    before = np.zeros_like(now)
    for r in range(rounds + 1):
        state = ws.write(reassign(state, before, now), f"round{r}")
        ws.drop(f"round{r - 1}" if r else "vectors")
        before, now = now, means(state, now) if r < rounds else now
        if (now == before).all():
            break
    inertia = {r.cluster: r.s for r in state.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    final = spark.createDataFrame([(c, inertia[c], sum(inertia.values()), now[c].tolist()) for c in inertia],
                                  "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return (state.select(F.col("id").alias(id_col), "cluster", "distance").join(F.broadcast(final), "cluster")
            .select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid"))
