"""Lookup joins.

Broadcast is used only behind a size check: the optimizer's size estimate of the
lookup side must be below ``max_bytes``.  Beyond it the plain join stays, so Spark
chooses a shuffle join (and AQE may still turn it into a broadcast join from
run-time sizes, or split skewed partitions).  The estimate counts compressed file
bytes, so the limit is kept well below what an executor could hold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

DEFAULT_BROADCAST_BYTES = 16 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan, in bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def maybe_broadcast(df: DataFrame, max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the estimated size is within ``max_bytes``."""
    if max_bytes is None:
        return df
    return F.broadcast(df) if estimated_bytes(df) <= max_bytes else df


def lookup_join(left: DataFrame, right: DataFrame, left_on, right_on, how: str = "left",
                null_safe: bool = False, small: bool = False,
                max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Equi-join on one or more (possibly computed) keys.

    ``left_on``/``right_on`` are names or Columns (J4: normalised keys are computed
    first, so the join stays a hash/broadcast equi-join).  ``null_safe`` matches null
    with null (``<=>``), still an equi-join, never a nested loop.  ``small`` asks for a
    broadcast of ``right``, granted only within ``max_bytes``.
    """
    lk = [left_on] if isinstance(left_on, (str, Column)) else list(left_on)
    rk = [right_on] if isinstance(right_on, (str, Column)) else list(right_on)
    if small:
        right = maybe_broadcast(right, max_bytes)
    cond = None
    for a, b in zip(lk, rk):
        ca = left[a] if isinstance(a, str) else a
        cb = right[b] if isinstance(b, str) else b
        c = ca.eqNullSafe(cb) if null_safe else (ca == cb)
        cond = c if cond is None else cond & c
    return left.join(right, cond, how)


#: A lookup side of at most so many estimated bytes is broadcast; that is some 400,000 packed keys.
STREAMED_BROADCAST_BYTES = 1 << 20


def streamed_join(left: DataFrame, right: DataFrame, left_on, right_on,
                  max_bytes: int = STREAMED_BROADCAST_BYTES) -> DataFrame:
    """Left ``lookup_join`` to a side of one row per key (J1) that keeps no left rows in memory:
    they stream past the hashed right rows, all of them within ``max_bytes``, beyond it the
    task's share of them. A sort-merge join sorts the left rows of a task, and those of one key
    or without any may be a large part of the table; AQE still splits such tasks."""
    right = F.broadcast(right) if estimated_bytes(right) <= max_bytes else right.hint("shuffle_hash")
    return lookup_join(left, right, left_on, right_on, "left")


#: Column of a placed join: equal rows of the result have the same value of it, and lie in one task.
PLACE = "_place"
#: Groups of keys whose left rows a placed join counts: so many for each task, and at most.
KEY_GROUPS, MOST_GROUPS = 8, 1 << 16
#: Left rows of fewer estimated bytes are not counted: one task can take them all.
WORTH_COUNTING = 16 << 20


def _heavy_groups(groups: DataFrame, tasks: int) -> DataFrame:
    """(_group, _pieces): the groups that hold more than a task's share of the rows, and into how
    many pieces they go, two for each share. At most ``MOST_GROUPS`` counts are collected."""
    counts = groups.groupBy("_group").agg(F.count(F.lit(1)).alias("_n")).collect()
    total = sum(r._n for r in counts)
    heavy = [(r._group, -(-2 * tasks * r._n // total)) for r in counts if r._n * tasks > total]
    return groups.sparkSession.createDataFrame(heavy, "_group long, _pieces long")


def placed_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, same: str, right_same: str, tasks: int = 0,
                max_bytes: int = STREAMED_BROADCAST_BYTES) -> DataFrame:
    """Left ``lookup_join``, null matching null, for a distinct over all columns but ``left_on`` and
    ``right_on``: with ``PLACE`` among its columns it needs no other shuffle. So the left rows go
    through one shuffle, before they get the columns of ``right``.

    ``same`` and ``right_same`` are columns that follow from the keys, equal for equal keys. Left
    rows that are equal but for the key, and the right rows that they may meet, are sent to one of
    ``tasks`` (by the session's setting when 0) by ``same``. Groups of its values that hold more
    than a task's share of the left rows are dealt over pieces by the whole row, their right rows
    repeated for each piece. Right rows are broadcast within ``max_bytes``; then only the rows count.
    """
    row = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns if c != left_on])

    def sent(df: DataFrame, by: str) -> DataFrame:
        return df.repartition(tasks, by) if tasks else df.repartition(by)

    if estimated_bytes(right) <= max_bytes:
        left = sent(left.withColumn(PLACE, row), PLACE)
        return left.join(F.broadcast(right), left[left_on].eqNullSafe(right[right_on]), "left")
    n = tasks or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = None
    if estimated_bytes(left) > WORTH_COUNTING:
        group = {c: F.pmod(F.xxhash64(F.col(f"`{c}`")), F.lit(min(KEY_GROUPS * n, MOST_GROUPS))) for c in (same, right_same)}
        heavy = F.broadcast(_heavy_groups(left.select(group[same].alias("_group")), n))

    def pieces(df: DataFrame, c: str) -> DataFrame:
        if heavy is None:
            return df.withColumn("_pieces", F.lit(1).cast("bigint"))
        of = df.withColumn("_of", group[c])
        return of.join(heavy, of["_of"] == heavy["_group"], "left").select(*[of[f"`{c}`"] for c in df.columns], F.coalesce("_pieces", F.lit(1)).alias("_pieces"))

    left = pieces(left, same).withColumn(PLACE, F.hash(F.col(f"`{same}`"), F.pmod(row, F.col("_pieces")))).drop("_pieces")
    right = pieces(right, right_same).withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pieces") - 1)))
    right = right.withColumn("_at", F.hash(F.col(f"`{right_same}`"), F.col("_piece"))).drop("_pieces", "_piece")
    left, right = sent(left, PLACE), sent(right, "_at")
    a, b = left[left_on], right[right_on]
    # not as a <=> b: that would become a part of the join's key, by which the rows do not lie
    matched = F.when(a.isNull(), b.isNull()).otherwise(a == b)
    return left.join(right.hint("shuffle_hash"), (left[PLACE] == right["_at"]) & matched, "left").drop("_at")


#: A key with more than this share of the left rows is split; at most 1 / share keys are.
HEAVY_SHARE = 0.01
#: Rows of a heavy key that stay together, as a share of the rows of an even shuffle partition.
PIECE = 0.25


def heavy_keys(df: DataFrame, keys: list[str], pieces: int, share: float = HEAVY_SHARE) -> DataFrame:
    """(keys..., _pieces): the keys, null ones included, that hold more than ``share`` of the
    rows, and into how many pieces each goes so that a piece is about one ``pieces``-th of all
    rows. One partial count per key in each task; what is collected is at most 1 / share rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    rows = counts.where(F.col("_n") > share * total).collect()
    schema = StructType([*counts.drop("_n").schema.fields, StructField("_pieces", IntegerType())])
    return df.sparkSession.createDataFrame([(*r[:-1], max(1, -(-r._n * pieces // total))) for r in rows], schema)


def split_join(left: DataFrame, right: DataFrame, left_on, right_on, how: str = "left", null_safe: bool = False,
               share: float = HEAVY_SHARE) -> DataFrame:
    """``lookup_join`` (inner, left, left_semi, left_anti) for keys of any weight.

    The left rows of a heavy key are dealt over pieces and the right rows of that key are
    repeated for each piece; all other keys have one piece. So no task gets more than a piece of
    a heavy key, whatever AQE can split, and what is repeated are the right rows of at most
    1 / ``share`` keys. The heavy keys are counted first (one pass over the left key columns).
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot split a {how} join: a right row would stand for several pieces")
    lk = [left_on] if isinstance(left_on, (str, Column)) else list(left_on)
    rk = [right_on] if isinstance(right_on, (str, Column)) else list(right_on)
    lc, rc = [left[k] if isinstance(k, str) else k for k in lk], [right[k] if isinstance(k, str) else k for k in rk]
    names = [f"_k{i}" for i in range(len(lk))]
    own = left.withColumns({n: c for n, c in zip(names, lc)})
    other = right.withColumns({f"{n}_r": c for n, c in zip(names, rc)})
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = F.broadcast(heavy_keys(own.select(*names), names, max(1, round(partitions / PIECE)), share))  # at most 1 / share rows

    def pieces(df: DataFrame, columns: list[str]) -> DataFrame:
        same = reduce(lambda a, b: a & b, (df[c].eqNullSafe(heavy[n]) for c, n in zip(columns, names)))
        return df.join(heavy, same, "left").select(*[df[f"`{c}`"] for c in df.columns], F.coalesce(heavy["_pieces"], F.lit(1)).alias("_pieces"))

    own = pieces(own, names).withColumn("_piece", F.pmod(F.monotonically_increasing_id(), F.col("_pieces")).cast("int")).drop("_pieces")
    rnames = [f"{n}_r" for n in names]
    other = pieces(other, rnames).withColumn("_piece_r", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))).drop("_pieces")
    cond = own["_piece"] == other["_piece_r"]
    for a, b in zip(names, rnames):
        cond = cond & (own[a].eqNullSafe(other[b]) if null_safe else own[a] == other[b])
    out = own.join(other, cond, how)
    return out.drop(*[own[c] for c in (*names, "_piece")], *([] if how in ("left_semi", "left_anti") else [other[c] for c in (*rnames, "_piece_r")]))


def fanout_join(left: DataFrame, right: DataFrame, left_on, right_on, how: str = "left", null_safe: bool = False,
                max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """J7 on a key of few values: every row meets several rows of its key. A right side within
    ``max_bytes`` is broadcast; beyond it the heavy keys are split, since the whole left side
    would meet on them."""
    if estimated_bytes(right) <= max_bytes:
        return lookup_join(left, right, left_on, right_on, how, null_safe=null_safe, small=True, max_bytes=max_bytes)
    return split_join(left, right, left_on, right_on, how, null_safe=null_safe)
