"""Approximate nearest neighbours by learned partitions (operator 7).

On a bounded sample: a graph of nearest neighbours, cut into balanced parts (recursive
bisection at the median of a smooth vector on the graph, then swaps that keep the balance
and cut fewer edges), and a small classifier that learns the part of a vector. Every
vector is indexed in its likeliest part; a query goes to its most probable parts, as many
as the sample needs for the wanted recall, and their vectors are ranked exactly.

A part's vectors and its queries are dealt into blocks of bounded size, so that neither a
large part nor one common vector meets in one task; each block returns its own nearest, and a window over at most
k rows per query and block keeps the best.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from tamarind.llm.common import Shared, Workspace, add_columns, unit_hash

#: Vectors that partition and classifier are fitted on, at most.
SAMPLE = 4096
GRAPH_DEGREE = 10
#: Recall on the sample that the number of probed parts must reach.
TARGET = 0.95
#: Candidates, or queries, in a block.
BLOCK = 8192
_SLACK = 1e-11
_KEYS = ("part", "block", "query_block")


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """(n, k) nearest other rows by cosine."""
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 512):
        s = x[a:a + 512] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -2.0
        out[a:a + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_partition(graph: np.ndarray, parts: int, rounds: int = 8) -> np.ndarray:
    """Part of each node; the sizes differ by one at most when ``parts`` is a power of two."""
    n, k = graph.shape
    u, v = np.repeat(np.arange(n), k), graph.ravel()
    u, v = np.concatenate([u, v]), np.concatenate([v, u])
    part = np.zeros(n, np.int64)
    rng = np.random.default_rng(11)
    for _ in range(int(math.log2(parts))):
        # a smooth vector within each part: repeated averaging over neighbours, less the mean
        same = part[u] == part[v]
        a, b = u[same], v[same]
        degree = np.bincount(a, minlength=n).clip(1)
        f = rng.normal(size=n)
        size = np.bincount(part)
        for _ in range(60):
            f = 0.5 * f + 0.5 * np.bincount(a, f[b], minlength=n) / degree
            f -= (np.bincount(part, f) / size)[part]
            f /= np.sqrt(np.bincount(part, f * f) / size).clip(1e-12)[part]
        order = np.lexsort((f, part))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
        part = 2 * part + (place >= size[part] // 2)
    for _ in range(rounds):  # swap nodes that would rather be in each other's part
        votes = np.zeros((n, parts))
        np.add.at(votes, (u, part[v]), 1.0)
        gain = votes - votes[np.arange(n), part][:, None]
        wish = gain.argmax(axis=1)
        eager = gain[np.arange(n), wish]
        moved = 0
        for p in range(parts):
            for q in range(p + 1, parts):
                one = np.flatnonzero((part == p) & (wish == q) & (eager > 0))
                two = np.flatnonzero((part == q) & (wish == p) & (eager > 0))
                m = min(len(one), len(two))
                one, two = one[np.argsort(-eager[one], kind="stable")[:m]], two[np.argsort(-eager[two], kind="stable")[:m]]
                part[one], part[two] = q, p
                eager[one] = eager[two] = 0
                moved += m
        if not moved:
            break
    return part


class Router:
    """Multinomial logistic regression from a unit vector to its part."""

    def __init__(self, x: np.ndarray, part: np.ndarray, parts: int, steps: int = 300):
        self.w, self.b = np.zeros((x.shape[1], parts)), np.zeros(parts)
        y = np.eye(parts)[part]
        mw, vw, mb, vb = np.zeros_like(self.w), np.zeros_like(self.w), np.zeros(parts), np.zeros(parts)
        for t in range(1, steps + 1):
            g = (self.probabilities(x) - y) / len(x)
            gw, gb = x.T @ g + 1e-5 * self.w, g.sum(axis=0)
            mw, vw = 0.9 * mw + 0.1 * gw, 0.99 * vw + 0.01 * gw * gw
            mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
            rate = 0.3 / (1 - 0.9**t)
            self.w -= rate * mw / (np.sqrt(vw / (1 - 0.99**t)) + 1e-8)
            self.b -= rate * mb / (np.sqrt(vb / (1 - 0.99**t)) + 1e-8)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.w + self.b
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def fit(sample: np.ndarray, parts: int, k: int, target: float = TARGET) -> tuple[Router, int]:
    """A router and the number of parts a query has to probe: the fewest whose vectors hold
    ``target`` of the sample's own ``k`` nearest."""
    x = unit_rows(sample)
    if parts < 2 or len(x) < 4 * parts:
        return Router(x[:1], np.zeros(len(x[:1]), np.int64), 1, steps=0), 1
    graph = neighbour_graph(x, min(GRAPH_DEGREE, len(x) - 1))
    router = Router(x, balanced_partition(graph, parts), parts)
    p = router.probabilities(x)
    home = p.argmax(axis=1)
    order = np.argsort(np.argsort(-p, axis=1, kind="stable"), axis=1)
    near = neighbour_graph(x, min(k, len(x) - 1))
    rank = order[np.arange(len(x))[:, None], home[near]]  # when the neighbour's part is probed
    held = np.cumsum(np.bincount(rank.ravel(), minlength=parts)) / rank.size
    return router, int(np.searchsorted(held, target) + 1)


def _vectors(col: pa.Array) -> np.ndarray:
    size = np.asarray(col.value_lengths())
    return np.asarray(col.flatten(), np.float64).reshape(len(size), -1) if len(size) else np.zeros((0, 1))


def _routed(df: DataFrame, shared, probes: int, name: str) -> DataFrame:
    def make():
        router = shared.value

        def fn(batch):
            if not batch.num_rows:
                return [pa.array([], pa.list_(pa.int32()))]
            p = router.probabilities(unit_rows(_vectors(batch.column("v"))))
            best = np.argsort(-p, axis=1, kind="stable")[:, :probes]
            return [pa.array(best.astype(np.int32).tolist(), pa.list_(pa.int32()))]

        return fn

    return add_columns(df, ["v"], [StructField(name, ArrayType(IntegerType()))], make)


def _distinct_rows(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows ordered by id; of rows with equal id and vector only one."""
    order = np.lexsort((*vectors.T[::-1], ids)) if len(np.unique(ids)) < len(ids) else np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    again = np.zeros(len(ids), bool)
    again[1:] = (ids[1:] == ids[:-1]) & (vectors[1:] == vectors[:-1]).all(axis=1)
    return ids[~again], vectors[~again]


def nearest(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
    """(query, id, score) of each query's k best ids, other than its own, in blocks. An id
    takes one place, with the best of its rows.

    A product of matrices finds the rows that can be among the best; their scores are then
    summed row by row, so equal vectors have equal scores and ties go to the smaller id.
    """
    ids, vectors = _distinct_rows(ids, vectors)
    begin = np.flatnonzero(np.diff(ids, prepend=ids[:1] - 1))  # first row of each id
    q_norm, v_norm = np.sqrt((queries * queries).sum(axis=1)), np.sqrt((vectors * vectors).sum(axis=1))
    unit = vectors / v_norm[:, None]
    out = [], [], []
    for a in range(0, len(queries), 256):
        part = queries[a:a + 256] / q_norm[a:a + 256, None]
        s = part @ unit.T
        s[query_ids[a:a + 256, None] == ids[None, :]] = -np.inf
        by_id = s if len(begin) == len(ids) else np.maximum.reduceat(s, begin, axis=1)
        m = min(k, by_id.shape[1])
        edge = -np.partition(-by_id, m - 1, axis=1)[:, m - 1]
        row, col = np.nonzero((s >= edge[:, None] - _SLACK) & (s > -2.0))
        exact = (queries[a + row] * vectors[col]).sum(axis=1) / (q_norm[a + row] * v_norm[col])
        order = np.lexsort((ids[col], -exact, row))
        row, col, exact = row[order], col[order], exact[order]
        if by_id is not s:
            _, once = np.unique(row * len(ids) + np.searchsorted(ids, ids[col]), return_index=True)
            once.sort()  # the best row of each id, in the order of rank
            row, col, exact = row[once], col[once], exact[once]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < k
        out[0].append(query_ids[a + row[best]])
        out[1].append(ids[col[best]])
        out[2].append(exact[best])
    return [np.concatenate(c) if c else np.zeros(0) for c in out]


def _dealt(asked: DataFrame, indexed: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Queries and candidates of each part in groups (``_KEYS``) of about ``block`` rows a side at
    most; every query of a part meets every candidate of it in one group."""
    def blocks(df):
        return {r[0]: -(-r[1] // block) for r in df.groupBy("part").count().collect()}  # a row per part

    def number(of):
        return F.element_at(F.create_map(*[F.lit(x) for p, n in of.items() for x in (p, n)]), F.col("part"))

    def own(of):  # by id and vector: the vectors of one much repeated id are dealt over all blocks
        return F.pmod(F.xxhash64("id", "v"), number(of).cast("long")).cast("int")

    def every(of):
        return F.explode(F.sequence(F.lit(0), number(of) - 1))

    held = blocks(indexed)
    asked = asked.where(F.col("part").isin(*held))
    wanted = blocks(asked)
    if not wanted:  # no query
        wanted = {p: 1 for p in held}
    indexed = indexed.where(F.col("part").isin(*wanted))
    return (asked.withColumn("block", every(held)).withColumn("query_block", own(wanted)),
            indexed.withColumn("block", own(held)).withColumn("query_block", every(wanted)))


def search(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
           parts: int | None = None, sample: int = SAMPLE, target: float = TARGET, block: int = BLOCK) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's ``k`` nearest found by
    cosine in double precision, ties to the smaller id.

    Queries are the rows where ``is_query`` (a condition on the id) holds, candidates all rows
    of another id. Rows with a null id, and vectors that are null, empty, zero, of another length than
    most of the sample's or hold null or non-finite components take no part. An id that
    repeats is one query (its smallest vector) and at most one result (its best vector).
    ``parts`` is a power of two,
    an eighth of the square root of the rows but 8 to 64, unless given. Other columns are not read.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    usable = (vectors.select(F.col(id_col).alias("id"), v.alias("v")).where("id IS NOT NULL AND size(v) > 0")
              .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)))
    if usable.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    drawn = usable.orderBy(unit_hash(F.col("id"), "sample"), "id").limit(sample).toArrow()["v"].to_pylist()
    schema = StructType([StructField("query_id", LongType()), StructField("vec_id", LongType()), StructField("score", DoubleType())])
    lengths = [len(x) for x in drawn]
    dim = max(set(lengths), key=lambda n: (lengths.count(n), n))
    usable = usable.where(F.size("v") == dim).distinct()  # equal rows of a repeated id are one
    if parts is None:
        parts = 1 << max(3, min(6, round(math.log2(math.sqrt(usable.count()) / 8))))
    router, probes = fit(np.array([x for x in drawn if len(x) == dim]), parts, k, target)
    shared = Shared(spark, router)

    # written once: the router's work is not repeated by the counts and the search that read it
    ws = Workspace(spark, "nearest")
    indexed = ws.write(_routed(usable, shared, 1, "parts").select("id", "v", F.col("parts")[0].alias("part")), "indexed")
    asked = usable.where(is_query(F.col("id"))).groupBy("id").agg(F.min("v").alias("v"))
    asked = ws.write(_routed(asked, shared, probes, "parts").select("id", "v", F.explode("parts").alias("part")), "asked")
    asked, spread = _dealt(asked, indexed, block)

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema_arrow.empty_table()
        found = nearest(*(f(t) for t in (left, right) for f in (_ids, _matrix)), k)
        return pa.Table.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())],
                                    schema=schema_arrow)

    schema_arrow = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    found = asked.groupBy(*_KEYS).cogroup(spread.groupBy(*_KEYS)).applyInArrow(best, schema)
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _ids(t: pa.Table) -> np.ndarray:
    return np.asarray(t["id"].combine_chunks(), np.int64)


def _matrix(t: pa.Table) -> np.ndarray:
    return _vectors(t["v"].combine_chunks())
