"""Merkle manifest of a dataset (operator 13): a hash tree over rows, with proofs checked by a
recursive query.

Each row is a leaf; the leaves of a source, in id order, form a tree of runs of 16, and the
trees' tops (subroots), in the order of their sources, form one tree above them. Every level
that is built is stored as node rows linked to their parents. A Spark ``WITH RECURSIVE`` query
then climbs from the leaves: each step joins a node to its parent's run, appends the siblings
and folds the hash of the (tampered) leaf with them.

At scale:
* Leaves are ranked without a window over a source: a range sort, then one count per
  (range partition, source) gives every partition's first place.
* The up to 16 leaves of a run share all siblings above it, so they climb as one row that holds
  a folded hash for each leaf; the recursion carries a sixteenth of the rows.
* Nodes above many leaves would be hot join keys. Those are few, by a bound (``NEAR_ROOT``), and
  are joined by broadcast in a second recursion; below them a key has few climbers.
* Hashes are kept and shuffled as their 32 bytes, and become hex text where they are hashed.
* Every level and both climbs are written tables, so a lost executor repeats one step.

Rows: nulls hash as ``-``; a null id comes first in its source and counts as the empty text in
the choice of tampered rows; a null source comes first. Rows with equal source and id are
ordered by their leaf hash; repeated rows are leaves each. An empty table gives no rows. Other
columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarind.llm.common import Workspace, crc_mod
from tamarind.operators.joins import maybe_broadcast

RUN = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Node rows joined by broadcast near the root, at most.
NEAR_ROOT = 8_192


def digest(*parts: Column) -> Column:
    """sha256 (its 32 bytes) of texts, one after the other."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def node_digest(*hashes: Column) -> Column:
    """sha256 of hashes, given as bytes of one or several, one after the other as hex text."""
    return digest(F.lower(F.hex(F.concat(*hashes))))


def joined(hashes: Column) -> Column:
    """The bytes of an array of hashes."""
    return F.unhex(F.array_join(F.transform(hashes, lambda h: F.hex(h)), ""))


def others(run: Column, i: Column) -> tuple[Column, Column]:
    """The hashes of a run before and after its i-th (from 0)."""
    return F.substring(run, F.lit(1), i * 32), F.substring(run, i * 32 + 33, F.lit(32 * RUN))


def field(c: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon, the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def tampered_text(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaves(rows: DataFrame, tampered: Column) -> DataFrame:
    """(id, source, leaf, start): the leaf hash, and the hash that the row has now, with its text
    changed where ``tampered`` holds; both as bytes."""
    leaf = digest(*[field(F.col(c)) for c in COLUMNS])
    changed = digest(*[field(F.col(c)) for c in COLUMNS[:-1]], field(tampered_text(F.col("text"))))
    return rows.select(F.col("doc_id").alias("id"), "source", leaf.alias("leaf"), F.when(tampered, changed).otherwise(leaf).alias("start"))


def ranked(df: DataFrame, group: str | None, order: list[str], ws: Workspace, name: str) -> DataFrame:
    """``df`` with ``pos``, a row's place in its group by ``order``, and ``width``, the group's
    rows; without a group, in all rows. No window ever holds a group: the rows are range-sorted
    by group and order, and what is summed up is one count per range partition and group."""
    key = F.col(group) if group else F.lit(0)
    by = ([group] if group else []) + order
    # the scan's own row number last: repeated rows do not all meet in one partition
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    placed = (numbered.repartitionByRange(*by, "_row").sortWithinPartitions(*by, "_row").drop("_row")
              .withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    placed = ws.write(placed, f"{name}-sorted")
    counts = placed.groupBy(F.col("_part").alias("_p"), key.alias("_g")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    w = Window.partitionBy("_g")
    before = F.sum("_n").over(w.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    counts = ws.write(counts.withColumn("_before", F.coalesce(before, F.lit(0))).withColumn("width", F.sum("_n").over(w)), f"{name}-counts")
    found = placed.join(maybe_broadcast(counts), (F.col("_part") == F.col("_p")) & key.eqNullSafe(F.col("_g")))
    return found.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_part", "_at", "_p", "_g", "_n", "_first", "_before")


def node_name(level: int, pos: Column, source: Column | None) -> Column:
    """Name of a node: its level, its place and its tree (a source, or the one above them)."""
    tree = F.lit("^")
    if source is not None:
        short = F.when(F.octet_length(source) > 60, F.concat(F.lit("#"), F.sha2(source.cast("binary"), 256))).otherwise(F.concat(F.lit(":"), source))
        tree = F.coalesce(short, F.lit("-"))
    return F.concat_ws("/", F.lit(level).cast("string"), pos.cast("string"), tree)


def above(n: Column) -> Column:
    """Place of the node above, or the number of nodes above n of them minus one."""
    return F.floor(n / RUN).cast("long")


def next_level(nodes: DataFrame, tree: str | None) -> DataFrame:
    """The nodes above, each the hash of a run."""
    keys = [*([tree] if tree else []), F.col("parent").alias("node"), above(F.col("pos")).alias("pos"), (above(F.col("width") - 1) + 1).alias("width")]
    run = joined(F.sort_array(F.collect_list(F.struct("pos", "hash")))["hash"])
    return (nodes.groupBy(*keys).agg(node_digest(run).alias("hash"), F.sum("leaves").alias("leaves"))
            .withColumn("subroot", F.lit(None).cast("binary")))


def build_tree(first: DataFrame, tree: str | None, ws: Workspace, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Level after level on ``first`` (tree, node, pos, width, hash, leaves, subroot), for all
    trees at once: the node rows (node, parent, slot, hash, leaves, subroot) of every level, and
    the tops."""
    tables, tops, level = [], None, 1
    while True:
        top = first.where("width = 1")
        tops = top if tops is None else tops.unionByName(top)
        inner = first.where("width > 1")
        if inner.isEmpty():
            return tables, tops
        level += 1
        inner = inner.withColumn("parent", node_name(level, above(F.col("pos")), F.col(tree) if tree else None))
        tables.append(inner.select("node", "parent", (F.col("pos") % RUN).cast("int").alias("slot"), "hash", "leaves", "subroot"))
        first = ws.write(next_level(inner, tree), f"{name}-{level}")


_CLIMB = """
WITH RECURSIVE climb (node, climbing, ids, run, folds, above, subroot) AS (
  SELECT node, climbing, ids, run, folds, above, subroot FROM {start}
  UNION ALL
  SELECT n.parent, n.climbing, c.ids, c.run,
         transform(c.folds, f -> unhex(sha2(cast(lower(hex(concat(n.before, f, n.after))) AS binary), 256))),
         concat(c.above, n.before, n.after), coalesce(n.subroot, c.subroot)
  FROM climb c JOIN {steps} n ON c.node = n.node
  WHERE c.climbing)
SELECT node, ids, run, folds, above, subroot FROM climb WHERE NOT climbing"""
#: How many rows a recursion may make is a setting, lifted while ours run. Its result has as many
#: partitions as its first step, so these are not merged while they are still small.
_WHILE_CLIMBING = {"spark.sql.cteRecursionRowLimit": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def climb(start: DataFrame, steps: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """``start`` (node, climbing, ids, run, folds, above, subroot) carried up by the recursive
    query over ``steps`` (node, parent, climbing, before, after, subroot) as far as ``climbing``
    says."""
    spark = start.sparkSession
    held = {key: spark.conf.get(key) for key in _WHILE_CLIMBING}
    for key, value in _WHILE_CLIMBING.items():
        spark.conf.set(key, value)
    try:
        return ws.write(spark.sql(_CLIMB, start=start, steps=steps), name)
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)


def ascend(start: DataFrame, nodes: DataFrame, root: str, near_root: int, ws: Workspace) -> DataFrame:
    """The climbers at the root: through the many nodes above few leaves by shuffle joins, through
    the few above many leaves by broadcast joins."""
    runs = nodes.groupBy("parent").agg(joined(F.sort_array(F.collect_list(F.struct("slot", "hash")))["hash"]).alias("r"), F.sum("leaves").alias("n"))
    before, after = others(F.col("r"), F.col("slot"))
    steps = nodes.join(runs, "parent").select("node", "parent", "leaves", F.col("n").alias("parent_leaves"), before.alias("before"), after.alias("after"), "subroot")
    steps = ws.write(steps, "steps")
    size = steps.agg(F.count(F.lit(1)).alias("n"), F.max("parent_leaves").alias("total"),
                     F.count_distinct(F.substring_index("node", "/", 1), F.col("node").endswith("/^")).alias("levels")).first()
    least = 1
    if size.n > near_root:
        # of nodes above at least ``least`` leaves there are at most near_root: each level has all leaves below it
        least = min(size.total, -(-size.total * size.levels // near_root))
        low = steps.where(F.col("leaves") < least).withColumn("climbing", F.col("parent_leaves") < least)
        start = climb(start.withColumn("climbing", F.col("leaves") < least), low, ws, "climbed")
        ws.drop("start")
    high = steps.where(F.col("leaves") >= least).withColumn("climbing", F.col("parent") != root)
    return climb(start.withColumn("climbing", F.col("node") != root), F.broadcast(high), ws, "at-root")


def manifest(rows: DataFrame, tampered: Column | None = None, near_root: int = NEAR_ROOT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root, verified) of every row, hashes as hex
    text. ``proof`` is the siblings' hashes from the leaf to the root, left to right;
    ``folded_root`` is what the row's present hash gives with them: its text lower-cased where
    ``tampered`` holds."""
    spark = rows.sparkSession
    ws = Workspace(spark, "merkle")
    if tampered is None:
        tampered = crc_mod(F.col("doc_id"), 5) == 0
    base = ws.write(leaves(rows, tampered), "leaves")
    placed = ranked(base, "source", ["id", "leaf"], ws, "leaves")
    member = F.sort_array(F.collect_list(F.struct("pos", "id", "leaf", "start")))
    runs = (placed.groupBy("source", above(F.col("pos")).alias("pos"), "width").agg(member.alias("m"))
            .withColumn("run", joined(F.col("m.leaf"))).withColumn("lone", F.col("width") == 1))
    # the up to 16 leaves of a run climb together; a source of one leaf has no run: the leaf is its subroot
    fold = F.transform("m", lambda x, i: node_digest(others(F.col("run"), i)[0], x["start"], others(F.col("run"), i)[1]))
    runs = ws.write(runs.select("source", "pos", node_name(1, F.col("pos"), F.col("source")).alias("node"), (above(F.col("width") - 1) + 1).alias("width"),
                                F.size("m").cast("long").alias("leaves"), F.when(F.col("lone"), F.col("run")).otherwise(node_digest(F.col("run"))).alias("hash"),
                                F.col("m.id").alias("ids"), "run", F.when(F.col("lone"), F.col("m.start")).otherwise(fold).alias("folds")), "start")
    ws.drop("leaves", "leaves-sorted")
    if runs.isEmpty():
        id_type = rows.schema["doc_id"].dataType.simpleString()
        return spark.createDataFrame([], f"doc_id {id_type}, leaf string, subroot string, root string, proof string, folded_root string, verified boolean")

    nothing = F.lit(None).cast("binary").alias("subroot")
    tables, tops = build_tree(runs.select("source", "node", "pos", "width", "hash", "leaves", nothing), "source", ws, "tree")
    upper = ranked(ws.write(tops.select("source", "node", "hash", "leaves", F.col("hash").alias("subroot")), "subroots"), None, ["source"], ws, "subroots")
    upper_tables, top = build_tree(ws.write(upper.drop("source"), "subroots-placed"), None, ws, "top")
    root = top.first()  # the one top of the one tree above all sources
    start = runs.select("node", "leaves", "ids", "run", "folds", F.lit("").cast("binary").alias("above"), nothing)
    nodes = None
    for t in [*tables, *upper_tables]:
        nodes = t if nodes is None else nodes.unionByName(t)
    if nodes is not None:
        start = ascend(start, nodes, root.node, near_root, ws)
    text = lambda *hashes: F.lower(F.hex(F.concat(*hashes)))
    root_hash = bytes(root.hash).hex()
    out = F.transform("ids", lambda x, i: F.struct(
        x.alias("doc_id"), text(F.substring("run", i * 32 + 1, F.lit(32))).alias("leaf"), F.coalesce(text(F.col("subroot")), F.lit(root_hash)).alias("subroot"),
        F.lit(root_hash).alias("root"), text(*others(F.col("run"), i), F.col("above")).alias("proof"),
        text(F.get("folds", i)).alias("folded_root"), (text(F.get("folds", i)) == root_hash).alias("verified")))
    return start.select(F.inline(out))
