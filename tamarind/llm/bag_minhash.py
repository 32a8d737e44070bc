"""Near-duplicate detection by BagMinHash (operator 1).

A document is the multiset of its runs of five words. Its signature comes from
hierarchical Poisson processes over the discretised weights: the weight axis of a shingle
is cut into dyadic levels (0, 1], (1, 2], (2, 4], (4, 8] ..., each level carries a Poisson
process whose rate is its length, and a level that the weight only reaches in part is
thinned by the position of each point. Every point falls on a random slot, which keeps
its earliest point, so two documents agree on a slot with probability equal to their
weighted Jaccard similarity (sum of minima over sum of maxima of the counts).

Slots are banded. Documents that share a band are compared exactly, on multisets of
64-bit shingle hashes, but never all pairs of a bucket:

1. each text is compared with one leader (the smallest of its buckets' smallest texts);
2. where a bucket still holds several groups, members are compared with one pivot, another
   in each band;
3. where it still does, members outside the bucket's largest group are compared with all
   members of other groups.

The joins of 2 and 3 rule out most pairs themselves, by one-bit sketches; in 3 also by a
consistent sample of shingles, which for up to 1024 shingles is all of them, and a pair
comes only in the first band it shares.

So every pair that shares a band is compared unless both ends are in one group already or
a sketch or sample differs by more than 4.5 standard deviations from the threshold. Equal
texts are one node throughout and are never compared.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField

from tamarind.llm.common import Norm, Workspace, add_columns, list_array, mix64, shingles, text_buffers

SHINGLE = 5
BANDS = 26
ROWS = 6
SLOTS = BANDS * ROWS
THRESHOLD = 0.8
SKETCH_LONGS = -(-SLOTS // 64)
SAMPLE_SIZE = 1024

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.uint64(0xD1B54A32D192ED03)
_LOG_CELLS = 4096
#: -ln of the middle of each cell of [0.5, 1); rounded, so that every machine has the same.
_LOG = np.array([round(-math.log(0.5 + (i + 0.5) / (2 * _LOG_CELLS)), 12) for i in range(_LOG_CELLS)])
_LN2 = 0.693147180560


def waiting_time(bits: np.ndarray) -> np.ndarray:
    """Standard exponential times from random bits, by basic arithmetic only: the logarithm
    of numpy may differ in its last place between machines, and slots compare exactly."""
    u = ((bits >> np.uint64(12)).astype(np.float64) + 0.5) / float(1 << 52)
    m, e = np.frexp(u)
    x = (m - 0.5) * (2 * _LOG_CELLS)
    cell = np.minimum(x.astype(np.int64), _LOG_CELLS - 1)
    middle = 0.5 + (cell + 0.5) / (2 * _LOG_CELLS)
    return _LOG[cell] - (m - middle) / middle - e * _LN2


def counted(doc: np.ndarray, h: np.ndarray):
    """Distinct (document, hash) with their counts, ordered by document."""
    order = np.argsort(mix64(h ^ (doc.astype(np.uint64) * _SALT)))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.concatenate([at, [len(h)]]))
    doc, h = doc[at], h[at]
    order = np.argsort(doc, kind="stable")
    return doc[order], h[order], count[order]


def _levels(doc, h, count):
    """The dyadic levels of each weight: document, seed, level start, rate, weight."""
    out = [(doc, mix64(h), np.zeros(len(h)), np.ones(len(h)), count.astype(np.float64))]
    k, start, length = 1, 1, 1
    while True:
        more = count > start
        if not more.any():
            return [np.concatenate(c) for c in zip(*out)]
        doc, h, count = doc[more], h[more], count[more]
        n = len(h)
        out.append((doc, mix64(h + np.uint64(k * int(_STEP) % (1 << 64))), np.full(n, float(start)), np.full(n, float(length)),
                    count.astype(np.float64)))
        k, start, length = k + 1, start + length, start + length


def signatures(doc: np.ndarray, h: np.ndarray, n_docs: int, slots: int = SLOTS) -> np.ndarray:
    """(n_docs, slots) earliest point on each slot; infinite for a document without shingles."""
    sig = np.full(n_docs * slots, np.inf)
    if not len(h):
        return sig.reshape(n_docs, slots)
    owner, seed, start, rate, weight = _levels(*counted(doc, h))
    # points a document needs until every slot has one, dealt over its processes' rates
    need = slots * (math.log(slots) + 1.0)
    per_unit = need / np.bincount(owner, np.minimum(rate, weight - start), minlength=n_docs).clip(1)
    width = np.exp2(np.ceil(np.log2((per_unit[owner] * rate).clip(1, need)))).astype(np.int64)
    time = np.zeros(len(seed))
    step = np.zeros(len(seed), np.uint64)
    active = np.arange(len(seed))
    while len(active):
        for w in np.unique(width[active]).tolist():
            group = active[width[active] == w]
            for part in np.array_split(group, max(1, len(group) * w // 400_000)):
                bits = mix64(seed[part, None] + (step[part, None] + np.arange(1, w + 1, dtype=np.uint64)) * _STEP)
                t = np.cumsum(waiting_time(bits) / rate[part, None], axis=1) + time[part, None]
                other = mix64(bits ^ _SALT)
                slot = ((other >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)
                place = start[part, None] + (other & np.uint64(0xFFFFFFFF)).astype(np.float64) / 2.0**32 * rate[part, None]
                hit = place < weight[part, None]
                where = owner[part, None] * slots + slot.astype(np.int64)
                np.minimum.at(sig, where[hit], t[hit])
                time[part] = t[:, -1]
                step[part] += np.uint64(w)
        latest = sig.reshape(n_docs, slots).max(axis=1)
        active = active[time[active] < latest[owner[active]]]
    return sig.reshape(n_docs, slots)


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """(documents, bands) 64-bit keys; the band number is part of the key."""
    n, slots = sig.shape
    bands = slots // rows
    bits = sig.view(np.uint64).reshape(n, bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) * _STEP, (n, bands))
    for r in range(rows):
        key = mix64((key ^ bits[:, :, r]) * _SALT + np.uint64(r + 1))
    return key


def sketches(sig: np.ndarray) -> np.ndarray:
    """(documents, SKETCH_LONGS): one bit of each slot's hash."""
    n, slots = sig.shape
    bit = np.zeros((n, SKETCH_LONGS * 64), np.uint8)
    bit[:, :slots] = mix64(sig.view(np.uint64)) & np.uint64(1)
    return np.packbits(bit, axis=1).view(np.int64)


def _signed(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(h, doc_id, n, bands, s0, s1, ...) of (h, doc_id, text) rows: shingle count, band keys, sketch."""
    fields = [StructField("n", LongType()), StructField("bands", ArrayType(LongType()))]
    fields += [StructField(f"s{i}", LongType()) for i in range(SKETCH_LONGS)]

    def make():
        def fn(batch):
            doc, h = shingles(Norm(*text_buffers(batch.column("text"))), SHINGLE)
            n = batch.num_rows
            size = np.bincount(doc, minlength=n)
            sig = signatures(doc, h, n, bands * rows)
            sketch, keys = sketches(sig), band_keys(sig, rows).view(np.int64)
            some = size > 0
            return [pa.array(size, pa.int64()), list_array(keys[some].ravel(), np.where(some, bands, 0), pa.int64()),
                    *(pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(SKETCH_LONGS))]

        return fn

    return add_columns(docs, ["text"], fields, make, keep=["h", "doc_id"])


def overlap(text_a: pa.Array, text_b: pa.Array) -> np.ndarray:
    """Exact weighted Jaccard similarity of the shingle multisets of each pair of texts."""
    n = len(text_a)
    owner, h, count, side = [], [], [], []
    for s, col in enumerate((text_a, text_b)):
        d, x, c = counted(*shingles(Norm(*text_buffers(col)), SHINGLE))
        owner.append(d)
        h.append(x)
        count.append(c)
        side.append(np.full(len(d), s))
    owner, h, count, side = map(np.concatenate, (owner, h, count, side))
    order = np.lexsort((side, h, owner))
    owner, h, count = owner[order], h[order], count[order]
    both = np.flatnonzero((owner[1:] == owner[:-1]) & (h[1:] == h[:-1])) if len(h) else np.zeros(0, np.int64)
    low = np.bincount(owner[both], np.minimum(count[both], count[both + 1]), minlength=n) if len(both) else np.zeros(n)
    total = np.bincount(owner, count, minlength=n)
    return np.divide(low, total - low, out=np.zeros(n), where=total > low)


def _verified(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The links among (a, b, ...) pairs: exact similarity of at least ``threshold``."""
    texts = nodes.select("h", "text")
    wide = (pairs.join(texts.select(F.col("h").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("h").alias("b"), F.col("text").alias("text_b")), "b"))

    def make():
        return lambda batch: [pa.array(overlap(batch.column("text_a"), batch.column("text_b")))]

    out = add_columns(wide, ["text_a", "text_b"], [StructField("similarity", DoubleType())], make, keep=pairs.columns)
    return out.where(F.col("similarity") >= F.lit(threshold - 1e-12))


def connected_components(ws: Workspace, links: DataFrame, name: str) -> DataFrame:
    """(h, comp): the smallest node that each linked node is connected to.

    Alternating star contraction: every node hands its larger neighbours to its smallest
    one, then its smaller ones, until every node has one smaller neighbour and that has
    none. Each round is one table in the shared folder, and its edges are never more than
    before.
    """
    edges = ws.write(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}0")
    k = 0
    while True:
        ends = edges.select(F.col("u").alias("h"), F.lit(1).alias("k")).unionByName(edges.select(F.col("v").alias("h"), F.lit(0).alias("k")))
        roles = ends.groupBy("h").agg(F.sum("k").alias("smaller"), F.min("k").alias("least"))
        if roles.where("smaller > 1 OR (smaller = 1 AND least = 0)").isEmpty():
            return edges.select(F.col("u").alias("h"), F.col("v").alias("comp")).unionByName(
                edges.select(F.col("v").alias("h"), F.col("v").alias("comp")).distinct())
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").unionByName(
            least.select("u", F.col("m").alias("v"))).distinct()
        k += 1
        edges = ws.write(small, f"{name}{k}")
        ws.drop(f"{name}{k - 1}")


def _flips(threshold: float, slots: int) -> int:
    """Differing sketch bits beyond which a similarity of ``threshold`` is ruled out."""
    p = (1 - threshold) / 2
    return math.ceil(slots * p + 4.5 * math.sqrt(slots * p * (1 - p)))


def _near(threshold: float, slots: int, left: str, right: str):
    """Whether counts and sketches of two sides of a join leave ``threshold`` possible."""
    flips = sum((F.bit_count(F.col(f"{left}.s{i}").bitwiseXOR(F.col(f"{right}.s{i}"))) for i in range(1, -(-slots // 64))),
                F.bit_count(F.col(f"{left}.s0").bitwiseXOR(F.col(f"{right}.s0"))))
    small, large = F.least(f"{left}.n", f"{right}.n"), F.greatest(f"{left}.n", f"{right}.n")
    return (small >= large * threshold - 1e-9) & (flips <= _flips(threshold, slots))


def _sampled(nodes: DataFrame) -> DataFrame:
    """(h, level, sample) of (h, text): numbered shingles below 2 ** (31 - level) of 31-bit
    hashes, where the level keeps at most about ``SAMPLE_SIZE`` of them."""
    fields = [StructField("level", IntegerType()), StructField("sample", ArrayType(IntegerType()))]

    def make():
        def fn(batch):
            doc, h, count = counted(*shingles(Norm(*text_buffers(batch.column("text"))), SHINGLE))
            total = np.bincount(doc, count, minlength=batch.num_rows)
            level = np.ceil(np.log2(np.maximum(total / SAMPLE_SIZE, 1.0))).astype(np.int64)
            copy = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            doc, h = np.repeat(doc, count), np.repeat(h, count)
            value = (mix64(h + copy.astype(np.uint64) * _STEP) >> np.uint64(33)).astype(np.int64)
            kept = value >> (31 - level[doc]) == 0
            size = np.bincount(doc[kept], minlength=batch.num_rows)
            return [pa.array(level, pa.int32()), list_array(value[kept].astype(np.int32), size, pa.int32())]

        return fn

    return add_columns(nodes, ["text"], fields, make, keep=["h"])


def _overlapping(threshold: float):
    """Whether the samples of x and y leave ``threshold`` possible; exact where both are whole,
    but for one shingle, since two of 1024 hashes of 31 bits may collide."""
    level = F.greatest("x.level", "y.level")
    limit = F.pow(F.lit(2.0), 31 - level)
    a, b = (F.when(F.col(f"{side}.level") == level, F.col(f"{side}.sample"))
            .otherwise(F.filter(f"{side}.sample", lambda v: v < limit)) for side in ("x", "y"))
    size = F.size(a) + F.size(b)  # 1 + threshold times the union, at the threshold
    spread = F.lit((1 + threshold) * threshold * (1 - threshold)) / F.greatest(size, F.lit(1))
    doubt = F.when(level > 0, 4.5 * F.sqrt(spread)).otherwise(0.0)
    least = F.greatest(F.lit(threshold) - doubt, F.lit(0.0))
    return F.size(F.array_intersect(a, b)) + 1 >= size * least / (1 + least)


def _pair() -> list:
    """(a, b, comp_a, comp_b) of the sides x and y of a join: the smaller node first, each with its group."""
    turned = F.col("x.h") > F.col("y.h")
    groups = F.when(turned, F.col("y.comp")).otherwise(F.col("x.comp")), F.when(turned, F.col("x.comp")).otherwise(F.col("y.comp"))
    return [F.least("x.h", "y.h").alias("a"), F.greatest("x.h", "y.h").alias("b"), groups[0].alias("comp_a"), groups[1].alias("comp_b")]


def _between(links: DataFrame) -> DataFrame:
    """The links of (a, b, comp_a, comp_b) rows as links between the groups."""
    return links.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")).distinct()


def _open_buckets(bucket: DataFrame, comps: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several groups, with ``comp`` and the bucket's largest group."""
    grouped = bucket.join(comps, "h", "left").withColumn("comp", F.coalesce("comp", "h"))
    sizes = grouped.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("k"))
    open_ = sizes.groupBy("band").agg(F.max(F.struct("k", "comp")).alias("top"), F.count(F.lit(1)).alias("groups"))
    return grouped.join(open_.where("groups > 1").select("band", F.col("top.comp").alias("largest")), "band")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id``, ``class_key`` and ``text_hash``.

    Documents are linked when their texts are equal, or when they share a band and the
    weighted Jaccard similarity of their five-word shingles is at least ``threshold``.
    ``class_id`` is the smallest id of the connected class, ``class_key`` the smallest text
    hash (md5) in it. A text of one to four words is one shingle; texts without words are
    linked only when equal; a document with a null text is a class of its own (null key and
    hash). Repeated ids keep their rows; rows with a null id take part, and a class of null
    ids only has a null ``class_id``. Other columns are not read.
    """
    ws = Workspace(docs.sparkSession, "near-duplicates")
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                         F.unhex(F.md5(F.col(text_col).cast("binary"))).alias("h"))
    sketch = [f"s{i}" for i in range(-(-bands * rows // 64))]
    signed = ws.write(_signed(source.where("h IS NOT NULL"), bands, rows), "signed")
    # the copies of one text are one node from here on
    texts = ws.write(signed.groupBy("h").agg(F.min("doc_id").alias("doc_id"),
                                             F.any_value(F.struct("n", "bands", *sketch)).alias("x"))
                     .select("h", "doc_id", "x.*"), "texts")
    member = texts.select("h", F.posexplode("bands").alias("place", "band"))
    leaders = member.groupBy("band").agg(F.min("h").alias("leader"), F.count(F.lit(1)).alias("k")).where("k > 1")
    shared = member.join(leaders.select("band", "leader"), "band")
    bucket = ws.write(shared.join(texts.select("h", "n", *sketch), "h"), "bucket")

    first = bucket.groupBy("h").agg(F.min("leader").alias("a")).where("a < h").select("a", F.col("h").alias("b"))
    first = ws.write(first, "first")
    wanted = bucket.select("h").distinct().join(texts.select("h", "doc_id"), "h")
    nodes = ws.write(source.alias("s").join(wanted.alias("w"), (F.col("s.h") == F.col("w.h"))
                                            & F.col("s.doc_id").eqNullSafe(F.col("w.doc_id")))
                     .groupBy("s.h").agg(F.any_value("text").alias("text")), "nodes")
    links = ws.write(_verified(first, nodes, threshold).select("a", "b"), "links1")
    # groups so far: each node's leader, followed for two more steps
    up = links.select(F.col("b").alias("h"), F.col("a").alias("comp"))
    comps = up
    for _ in range(2):
        step = up.select(F.col("h").alias("comp"), F.col("comp").alias("next"))
        comps = comps.join(step, "comp", "left").select("h", F.coalesce("next", "comp").alias("comp"))

    # members against one member of each of their buckets, another one in each band
    opened = ws.write(_open_buckets(bucket, comps), "open2")
    pivots = opened.groupBy("band").agg(F.min_by("h", F.xxhash64("h", "band")).alias("h"))
    pivots = opened.join(pivots, ["band", "h"]).alias("x")
    second = (pivots.join(opened.alias("y"), F.col("x.band") == F.col("y.band"))
              .where(F.expr("x.comp <> y.comp") & _near(threshold, bands * rows, "x", "y"))
              .select(*_pair()).distinct())
    more = ws.write(_between(_verified(second, nodes, threshold)), "links2")
    # links between groups stand for those between their members: the graph shrinks to the groups
    comps = connected_components(ws, links.unionByName(more), "c2-")

    # members outside the largest group of their bucket against all other groups
    still = ws.write(_open_buckets(opened.drop("comp", "largest"), comps), "open3")
    extra = _sampled(nodes.join(still.select("h").distinct(), "h")).join(texts.select("h", "bands"), "h")
    still = still.join(ws.write(extra, "extra"), "h")
    # a pair comes once: in the first band it shares
    earlier = [(F.col("x.place") > j) & (F.col("x.bands")[j] == F.col("y.bands")[j]) for j in range(bands - 1)]
    in_first = ~reduce(or_, earlier, F.lit(False))
    third = (still.where("comp <> largest").alias("x").join(still.alias("y"), F.col("x.band") == F.col("y.band"))
             .where((F.expr("x.comp <> y.comp AND (y.comp = y.largest OR x.h < y.h)") & _near(threshold, bands * rows, "x", "y"))
                    & in_first & _overlapping(threshold))
             .select(*_pair()).distinct())
    more = ws.write(_between(_verified(third, nodes, threshold)), "links3")
    known = texts.select("h", "doc_id").join(comps, "h", "left").withColumn("comp", F.coalesce("comp", "h"))
    if not more.isEmpty():
        joined = connected_components(ws, more, "c3-").select(F.col("h").alias("comp"), F.col("comp").alias("whole"))
        known = known.join(joined, "comp", "left").select("h", "doc_id", F.coalesce("whole", "comp").alias("comp"))
    smallest = known.groupBy("comp").agg(F.min("doc_id").alias("class_id"))
    classes = ws.write(known.join(smallest, "comp").select("h", "class_id", F.col("comp").alias("class_key")), "classes")
    ws.drop("texts", "bucket", "first", "nodes", "links1", "links2", "links3", "open2", "open3", "extra")
    out = source.select("doc_id", F.col("h")).join(classes, "h", "left")
    return out.select("doc_id", F.when(F.col("h").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      "class_key", F.col("h").alias("text_hash"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each near-duplicate class: the smallest id, then the
    smallest text hash. Rows that repeat id and text of it are one; null texts all stay."""
    classes = near_duplicates(docs, **options)
    kept = (classes.where("class_key IS NOT NULL").groupBy("class_key")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("k"))
            .select(F.col("k.doc_id").alias("_id"), F.col("k.text_hash").alias("_hash")))
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    hashed = docs.withColumn("_h", F.unhex(F.md5(F.col(text_col).cast("binary"))))
    one = (hashed.join(kept, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_hash")), "left_semi")
           .dropDuplicates([id_col, "_h"]))
    return one.unionByName(hashed.where("_h IS NULL")).drop("_h")
