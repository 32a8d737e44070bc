"""Loads into a ``date_id``-partitioned Parquet warehouse table.

Replace-by-key (K1) without MERGE: the staged rows are written once to the shared
scratch folder, partitioned by date (this cuts lineage, survives lost executors and names
the touched dates); then the touched ``date_id`` partitions of the target are rewritten as
``(old ANTI-JOIN staged keys) UNION ALL staged`` with a *dynamic* partition overwrite: its
files replace those partitions only when the job commits, so the target may be read by the
same job, and a failed job leaves it as it was.  Only the folders of touched dates are listed.

Options of a load (``LoadRules``), all off by default: cast and order by the existing target's
schema, a side table for rows without a key, appends that a rerun does not repeat
(``sinks.ledger``), files laid out by key.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType, StructField, StructType

from tamarind.operators.joins import maybe_broadcast
from tamarind.session import child_names, create_file, path_exists, read_file, remove_path, scratch_root

PARTITION_COL = "date_id"
_NULL_DIR = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class LoadRules:
    """How a load treats what the plain rules (K1-K3) leave open."""

    target_schema: str = "spec"       # K2: "spec", or the target's own: "target", "target+add" (new nullable columns are added)
    no_key: str = "keep"              # K1a, D18: "keep" in the table, or "side": a side table that a rerun replaces
    append: str = "add"               # K3: what a repeated load of an append does: "add" again, "skip", "replace"
    cluster: tuple[str, ...] = ()     # K1: lay files out by ranges of these columns within a date


PLAIN = LoadRules()


def spread(df: DataFrame, partition_col: str, sort=(), cluster=()) -> DataFrame:
    """Shuffle so that each task writes few ``partition_col`` directories; a date with many
    rows is split over as many tasks as its size asks for (a rebalance, sized at run time).
    ``sort`` orders the rows within each file (O2), which costs no shuffle. ``cluster`` deals
    by ranges of those columns within a date instead, so that a file holds neighbouring keys
    and a look-up of few keys skips files and row groups by their statistics."""
    if cluster:
        return df.repartitionByRange(partition_col, *cluster).sortWithinPartitions(partition_col, *cluster)
    out = df.hint("rebalance", partition_col)
    return out.sortWithinPartitions(partition_col, *sort) if sort else out


def align_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """K2: columns in target order, cast to target types; extra columns dropped; a
    missing column is an error.  Fractions round half away from zero on their way into an
    integral type.  ANSI casts make bad values fail loudly."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the target schema: {missing}")
    have = dict(df.dtypes)

    def aligned(f):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, IntegralType) and (have[f.name] in ("double", "float") or have[f.name].startswith("decimal")):
            c = F.round(c)
        return c.cast(f.dataType).alias(f.name)

    return df.select(*[aligned(f) for f in schema.fields])


def touched_dates(spark: SparkSession, stage_path: str, partition_col: str = PARTITION_COL) -> list[str | None]:
    """The partition values of a staged table, from its directory names (None: the null date)."""
    names = [n.partition("=")[2] for n in child_names(spark, stage_path) if n.startswith(f"{partition_col}=")]
    return sorted((None if n == _NULL_DIR else n for n in names), key=str)


def upsert_frame(target: DataFrame | None, staged: DataFrame, pk, dates, partition_col: str = PARTITION_COL) -> DataFrame:
    """K1 as a plan: the new content of every partition in ``dates`` (those that ``staged`` touches).

    Old rows whose pk equals a staged pk are deleted (plain equality: a null pk part
    never matches, so such old rows stay — K1a); every staged row is inserted, also
    several per pk (K1b).  Rows of untouched partitions are neither read nor part of the
    result: the dates are a partition filter on the target.
    """
    if target is None:
        return staged
    known = [_dt.date.fromisoformat(d) for d in dates if d is not None]
    cond = target[partition_col].isin(known) if known else F.lit(False)
    if len(known) < len(dates):
        cond = cond | target[partition_col].isNull()
    old = target.where(cond)
    match = None
    for k in pk:
        c = old[k] == staged[k]
        match = c if match is None else match & c
    return old.join(staged, match, "left_anti").unionByName(staged.select(*target.columns))


_SCHEMA_FILE = "_schema.json"  # readers of the table pass over names that begin with an underscore


def stored_schema(spark: SparkSession, path: str, partition_col: str = PARTITION_COL) -> StructType | None:
    """The schema of an existing table: the one kept beside it, else that of its last partition."""
    if not path_exists(spark, path):
        return None
    if path_exists(spark, f"{path}/{_SCHEMA_FILE}"):
        return StructType.fromJson(json.loads(read_file(spark, f"{path}/{_SCHEMA_FILE}")))
    dates = sorted(n for n in child_names(spark, path) if n.startswith(f"{partition_col}="))
    if not dates:
        return None
    known = [d for d in dates if not d.endswith(_NULL_DIR)] or dates
    return spark.read.option("basePath", path).parquet(f"{path}/{known[-1]}").schema


def schema_of_load(spark: SparkSession, path: str, schema: StructType, rules: LoadRules, partition_col: str = PARTITION_COL) -> StructType:
    """K2: the schema that rows are cast to and ordered by. With the target's own: its names,
    types and order; a column that only the spec has is an error, or under "target+add" a new
    nullable column at the end, of which older rows hold null."""
    if rules.target_schema == "spec":
        return schema
    if rules.target_schema not in ("target", "target+add"):
        raise ValueError(f"unknown rule for the target's schema: {rules.target_schema}")
    old = stored_schema(spark, path, partition_col)
    if old is None:
        return schema
    new = [StructField(f.name, f.dataType, True) for f in schema.fields if f.name not in old.fieldNames()]
    if new and rules.target_schema == "target":
        raise ValueError(f"columns that the target does not have: {[f.name for f in new]}")
    return StructType([StructField(f.name, f.dataType, True) for f in old.fields] + new)


def keep_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    """Notes the table's schema beside it, when it is not the one that is noted."""
    text = json.dumps(schema.jsonValue())
    at = f"{path}/{_SCHEMA_FILE}"
    if path_exists(spark, at):
        if read_file(spark, at) == text:
            return
        remove_path(spark, at)
    create_file(spark, at, text)


def _any_null(pk) -> Column:
    return reduce(lambda a, b: a | b, (F.col(f"`{k}`").isNull() for k in pk))


def _write(df: DataFrame, path: str, schema: StructType, partition_col: str, mode: str, sort=(), cluster=(), extra=()) -> dict:
    """Aligned rows written partitioned by date, counted on the way (one action). ``extra``
    columns go along as they are."""
    obs = Observation("load")
    aligned = align_to_schema(df, schema) if not extra else align_to_schema(df, StructType([*schema.fields, *(df.schema[c] for c in extra)]))
    counted = aligned.observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(partition_col).isNull()).alias("null_dates"))
    spread(counted, partition_col, sort, cluster).write.mode(mode).partitionBy(partition_col).parquet(path)
    rows = int(obs.get["rows"])
    return {"rows": rows, "columns": len(schema.fields), "skipped": rows == 0, "null_dates": int(obs.get["null_dates"])}


def read_dates(spark: SparkSession, path: str, schema: StructType, dates, partition_col: str = PARTITION_COL) -> DataFrame | None:
    """The rows of some dates of a table; only their folders are listed. None when there are none."""
    folders = [f"{path}/{partition_col}={_NULL_DIR if d is None else d}" for d in dates]
    there = [f for f in folders if path_exists(spark, f)]
    return spark.read.schema(schema).option("basePath", path).parquet(*there) if there else None


def append(spark: SparkSession, df: DataFrame, target_path: str, schema: StructType,
           partition_col: str = PARTITION_COL, sort=(), cluster=()) -> dict:
    """K3 (+K2, K4, K5): append after aligning to the schema; empty input writes nothing.
    The report counts the rows without a date (D18): a rerun cannot replace those."""
    there = path_exists(spark, target_path)
    out = _write(df, target_path, schema, partition_col, "append", sort, cluster)
    if out["skipped"] and not there:
        remove_path(spark, target_path)
    return out


def last_day_only(staged: DataFrame, pk, day_col: str) -> DataFrame:
    """M2: of a key staged on several lake days the rows of its last one, as if the days had
    been loaded one after the other; rows with a null key part all stay, since none replaces
    them. Only keys of several days are joined, so what is looked up is small."""
    days = staged.groupBy(*pk).agg(F.max(day_col).alias("_last"), F.min(day_col).alias("_first")).where("_last > _first")
    days = maybe_broadcast(days.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(pk)], "_last"))
    same = reduce(lambda a, b: a & b, (staged[k] == days[f"_k{i}"] for i, k in enumerate(pk)))
    return staged.join(days, same & (staged[day_col] < days["_last"]), "left_anti").drop(day_col)


def side_path(target_path: str) -> str:
    """Where the rows of a table that have no key lie (``no_key="side"``)."""
    return f"{target_path}__no_key"


def _row_hash(schema: StructType, audit=("dwh_crtd_dttm", "dwh_updt_dttm")) -> Column:
    """Key of a row without a key: a hash of its columns but for the run's clock."""
    texts = [F.coalesce(F.col(f"`{f.name}`").cast("string"), F.lit("\0")) for f in schema.fields if f.name not in audit]
    return F.sha2(F.concat_ws("\1", *texts), 256)


def upsert(spark: SparkSession, df: DataFrame, target_path: str, pk, schema: StructType, partition_col: str = PARTITION_COL,
           strict_pk: bool = False, sort=(), rules: LoadRules = PLAIN, day_col: str | None = None) -> dict:
    """K1 + K2 + K4 + K5: stage, skip when empty, replace by key, report rows/columns.

    ``day_col``: the rows of several lake days at once, in a column that is not stored; they
    replace each other as days loaded in order do (pk must hold the partition column).
    """
    side = rules.no_key == "side"
    if not path_exists(spark, target_path) and not (strict_pk or side or day_col):
        return append(spark, df, target_path, schema, partition_col, sort, rules.cluster)  # first load: nothing to replace
    stage_path = f"{scratch_root(spark)}/stage-{uuid.uuid4().hex}"
    try:
        extra = (day_col,) if day_col else ()
        out = _write(df, stage_path, schema, partition_col, "errorifexists", extra=extra)
        if out["skipped"]:
            return out
        staged = spark.read.schema(StructType([*schema.fields, *(df.schema[c] for c in extra)])).parquet(stage_path)
        if day_col:
            staged = last_day_only(staged, pk, day_col)
        if strict_pk and not staged.groupBy(*pk).count().where("count > 1").isEmpty():
            raise ValueError(f"staged rows repeat a primary key {tuple(pk)}")
        dates = touched_dates(spark, stage_path, partition_col)
        if side:
            no_key = staged.where(_any_null(pk)).withColumn("row_hash", _row_hash(schema))
            staged = staged.where(~_any_null(pk))
            _merge(spark, no_key, side_path(target_path), ("row_hash",), StructType([*schema.fields, StructField("row_hash", StringType())]),
                   dates, partition_col, sort, ())
        _merge(spark, staged, target_path, pk, schema, dates, partition_col, sort, rules.cluster)
        return out
    finally:
        remove_path(spark, stage_path)


def _merge(spark: SparkSession, staged: DataFrame, path: str, pk, schema: StructType, dates, partition_col: str, sort, cluster) -> None:
    """Replaces the touched dates of a table by what ``upsert_frame`` gives."""
    merged = upsert_frame(read_dates(spark, path, schema, dates, partition_col), staged, pk, dates, partition_col)
    (spread(merged.select(*schema.fieldNames()), partition_col, sort, cluster).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path))


def load(spark: SparkSession, df: DataFrame, warehouse_root: str, spec, rules: LoadRules = PLAIN, load_id: str | None = None,
         day_col: str | None = None) -> dict:
    """Route a built frame to upsert or append per its spec (K6: specs may share a table).
    ``load_id`` names the load of an append whose repetition matters (table and lake day)."""
    path = f"{warehouse_root.rstrip('/')}/{spec.target}"
    schema = schema_of_load(spark, path, spec.schema, rules)
    if spec.append:
        df = df.drop(day_col) if day_col else df
        if rules.append != "add" and load_id:
            from tamarind.sinks.ledger import append_once
            out = append_once(spark, df, path, schema, load_id, rules.append, sort=spec.sort)
        else:
            out = append(spark, df, path, schema, sort=spec.sort, cluster=rules.cluster)
    else:
        out = upsert(spark, df, path, spec.pk, schema, sort=spec.sort, rules=rules, day_col=day_col)
    if rules.target_schema != "spec" and not out["skipped"]:
        keep_schema(spark, path, schema)
    return out
