"""Kept newest row per key (S10, S10b): a stored table that a run brings up to date.

``refresh`` keeps, for a declared newest-per-key source, its newest rows and the list of lake
files that went into them. A run reads only the days that hold files it has not seen, late ones
included (the newest of the kept and the new rows does not depend on the order of days), and
starts over when a file that it has seen was changed or removed, since that may bring an older
row back.

The kept rows are scanned but not shuffled while the new days' keys are few enough to be
broadcast; only rows of touched keys are ranked again. Each state is a new version; a version
counts once its marker exists, and a marker is created exclusively, so a failed run leaves the
state as it was and of two runs at once one fails.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarind.operators.joins import maybe_broadcast
from tamarind.session import child_names, create_file, path_exists, read_file, remove_path
from tamarind.sources.lake import PART_COLS, empty_frame, folder_of, latest_per_key, read_folders

#: Beyond so many new days a merge gives the scan the whole table's folder.
MOST_FOLDERS = 400


def state_folder(state_root: str, src) -> str:
    """Where the state of a source lies: one for each table, key, tie rule and column list."""
    rule = hashlib.sha256(repr((src.keys, src.tie, src.columns)).encode()).hexdigest()[:12]
    return f"{src.path(state_root)}/{'-'.join(src.keys)}-{rule}"


def lake_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, day, length, modified) of a lake table: a listing, no data is read. ``day`` is the
    date parts as one number, ``file`` the path below the table."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
             .select("path", "length", F.col("modificationTime").alias("modified")))
    part = lambda name: F.regexp_extract("path", rf"/{name}=(\d+)/", 1).try_cast("int")
    y, m, d = (part(name) for name in PART_COLS)
    rest = F.regexp_extract("path", rf"({PART_COLS[0]}=\d+/.*)$", 1)
    return found.select(rest.alias("file"), (y * 10000 + m * 100 + d).alias("day"), "length", "modified").where("day IS NOT NULL")


def last_version(spark: SparkSession, folder: str) -> tuple[int, str | None]:
    """(number, folder) of the newest finished version; (0, None) without any."""
    done = sorted(n for n in child_names(spark, folder) if n.startswith("done-")) if path_exists(spark, folder) else []
    if not done:
        return 0, None
    return int(done[-1][5:]), f"{folder}/{read_file(spark, f'{folder}/{done[-1]}')}"


def changes(now: DataFrame, known: DataFrame) -> tuple[bool, list[int]]:
    """Whether a known file is gone or another one, and the days that hold unknown files."""
    a, b = now.select("file", "day", "length", "modified"), known.select("file", F.col("length").alias("l"), F.col("modified").alias("m"), F.lit(True).alias("known"))
    both = a.join(b, "file", "full")
    other = F.col("day").isNull() | (F.col("known") & ((F.col("length") != F.col("l")) | (F.col("modified") != F.col("m"))))
    rows = both.select(F.coalesce(other, F.lit(False)).alias("other"), F.when(F.col("known").isNull(), F.col("day")).alias("new")).distinct().collect()
    return any(r.other for r in rows), sorted(r.new for r in rows if r.new is not None)


def day_folders(path: str, days: list[int]) -> list[str]:
    return [folder_of(path, d // 10000, d // 100 % 100, d % 100) for d in days]


def merged(kept: DataFrame, new: DataFrame, src) -> DataFrame:
    """The newest rows of ``kept`` and ``new`` (each with one row per key). Kept rows of keys
    that ``new`` does not hold pass through without a shuffle while those keys are few."""
    keys = maybe_broadcast(new.select(*src.keys))
    touched = kept.join(keys, list(src.keys), "left_semi").select(*kept.columns)
    again = latest_per_key(touched.unionByName(new.select(*kept.columns)), src.keys, tie=src.tie)
    return kept.join(keys, list(src.keys), "left_anti").select(*kept.columns).unionByName(again)


def _read(spark: SparkSession, src, path: str, folders: list[str] | None) -> DataFrame:
    df = spark.read.option("basePath", path).parquet(path) if folders is None else read_folders(spark, path, folders)
    if src.columns:
        df = df.select(*src.columns, *[c for c in PART_COLS if c not in src.columns])
    return df


def refresh(spark: SparkSession, src, lake_root: str, state_root: str) -> DataFrame:
    """The newest row per key of the lake table as it is now, from the kept state and the days
    that are new to it; the same rows as ``latest_per_key`` over the whole table."""
    path, folder = src.path(lake_root), state_folder(state_root, src)
    if not path_exists(spark, path):
        return empty_frame(spark, [*(src.columns or src.keys), *PART_COLS], src.schema)
    number, kept = last_version(spark, folder)
    files = lake_files(spark, path)
    rebuild, days = (True, []) if kept is None else changes(files, spark.read.parquet(f"{kept}/files"))
    if not rebuild and not days:
        return spark.read.parquet(f"{kept}/rows")
    version = f"version-{number + 1:08d}-{uuid.uuid4().hex}"
    at = f"{folder}/{version}"
    try:
        # the list is taken before the rows are read: a file that comes in between is new to the next run
        files.write.parquet(f"{at}/files")
        if rebuild:
            latest_per_key(_read(spark, src, path, None), src.keys, tie=src.tie).write.parquet(f"{at}/rows")
        else:
            rows = _read(spark, src, path, day_folders(path, days) if len(days) <= MOST_FOLDERS else None)
            if len(days) > MOST_FOLDERS:
                y, m, d = (F.col(c) for c in PART_COLS)
                rows = rows.where((y * 10000 + m * 100 + d).isin(days))
            latest_per_key(rows, src.keys, tie=src.tie).write.parquet(f"{at}/new")
            merged(spark.read.parquet(f"{kept}/rows"), spark.read.parquet(f"{at}/new"), src).write.parquet(f"{at}/rows")
            remove_path(spark, f"{at}/new")
        create_file(spark, f"{folder}/done-{number + 1:08d}", version)
    except Exception:
        remove_path(spark, at)
        raise
    _drop_older(spark, folder, number)
    return spark.read.parquet(f"{at}/rows")


def _drop_older(spark: SparkSession, folder: str, keep_from: int) -> None:
    """Removes versions before the last but one, which a running reader may still use."""
    for name in child_names(spark, folder):
        kind, _, rest = name.partition("-")
        if kind in ("done", "version") and rest[:8].isdigit() and int(rest[:8]) < keep_from:
            remove_path(spark, f"{folder}/{name}")
