"""Readers for the date-partitioned Parquet lake.

Layout: ``{lake}/{app}[/{source_type}]/{table}/calendar_year=Y/month_no=M/day_of_month=D``.
A read of a day, a month, some years or a range of days is given to Spark as the folders of just
that time (``date_folders``), so nothing else is listed: a table of ten years has thousands of
folders, and a filter on partition columns would list them all before it prunes. Partition
discovery (``basePath``) still gives the three date parts as ints.
"""

from __future__ import annotations

import calendar
import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tamarind.operators.joins import estimated_bytes
from tamarind.session import child_names, file_count, path_exists, remove_path, scratch_root

PART_COLS = ("calendar_year", "month_no", "day_of_month")
#: Scans of fewer bytes are not worth a shuffle.
SMALLEST_DEALT = 1 << 20
#: Estimated bytes of the rows that a task gets of a dealt scan; of packed files that is a tenth
#: of their true size or less.
DEALT_BYTES = 4 << 20
#: Estimates beyond this are Spark's stand-in for an unknown size, or a product of unknown ones.
UNKNOWN_BYTES = 1 << 50

#: Files that a pass of a newest-per-key read gives to Spark at once: the driver holds one or two KB
#: of each. A day's folder is not divided.
FILES_PER_PASS = 16_384
#: With this setting the driver keeps the listings of earlier reads, up to 250 MB of them.
LISTING_CACHE = "spark.sql.hive.manageFilesourcePartitions"
#: Small files that one task of such a pass reads, about.
FILES_PER_TASK = 256


def empty_frame(spark: SparkSession, columns, schema: str | None = None) -> DataFrame:
    """A typed, empty frame for a table that does not exist."""
    if schema:
        return spark.createDataFrame([], schema)
    fields = [StructField(c, IntegerType() if c in PART_COLS else StringType(), True)
              for c in (columns or [])]
    return spark.createDataFrame([], StructType(fields))


def folder_of(path: str, *parts: int) -> str:
    """The folder of a year, a month or a day of a lake table."""
    return "/".join([path.rstrip("/"), *(f"{name}={int(v)}" for name, v in zip(PART_COLS, parts))])


def date_folders(path: str, start: _dt.date, end: _dt.date) -> list[str]:
    """The fewest folders that hold exactly the days from ``start`` to ``end``: whole years, then
    whole months, then days."""
    out, day = [], start
    while day <= end:
        month_end = day.replace(day=calendar.monthrange(day.year, day.month)[1])
        if day.month == day.day == 1 and _dt.date(day.year, 12, 31) <= end:
            out.append(folder_of(path, day.year))
            day = _dt.date(day.year, 12, 31)
        elif day.day == 1 and month_end <= end:
            out.append(folder_of(path, day.year, day.month))
            day = month_end
        else:
            out.append(folder_of(path, day.year, day.month, day.day))
        if day == _dt.date.max:
            break
        day += _dt.timedelta(days=1)
    return out


def _numbered(spark: SparkSession, path: str, part: str) -> list[int]:
    """The values of a date part that have a folder under ``path``."""
    return sorted(int(n.partition("=")[2]) for n in child_names(spark, path) if n.startswith(f"{part}=") and n.partition("=")[2].isdigit())


def newest_day_folder(spark: SparkSession, path: str) -> str | None:
    """The folder of the last day of a table, found by one listing per level."""
    at, parts = path, []
    for part in PART_COLS:
        found = _numbered(spark, at, part)
        if not found:
            return None
        parts.append(found[-1])
        at = folder_of(path, *parts)
    return at


def tasks_by_rows(df: DataFrame) -> int:
    """Over how many tasks the rows of ``df`` go so that one gets the same number whatever the
    table's size, by Spark's estimate of the rows; one for each core at least. 0 when Spark has no
    estimate, as of rows that do not come from files."""
    size = estimated_bytes(df)
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-size // DEALT_BYTES)) if size < UNKNOWN_BYTES else 0


def deal_small_scan(df: DataFrame, dealt_later: bool = False) -> DataFrame:
    """A scan whose splits would give a task too much hands its rows to more tasks, by a hash of
    the row, before the row-level work that follows. A small table is often one file with one row
    group, which one task reads; and keys pack so well that a split of a larger one may hold ten
    million rows, each many times as wide once it is cleaned, of which the distinct at the end
    keeps as many in memory as it can. The tasks go by Spark's estimate of the rows, so that one
    gets the same number whatever the table's size. Rows that are ``dealt_later``, and kept by no
    task before, are dealt here only when there are fewer splits than cores."""
    spark = df.sparkSession
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    wanted = spark.sparkContext.defaultParallelism if dealt_later else tasks_by_rows(df)
    return df.repartition(wanted, *df.columns) if size > SMALLEST_DEALT and size < wanted * split else df


def read_folders(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    """The rows of some date folders of the table at ``path``, with their date parts. Folders
    that do not exist are left out; when none does, an empty frame that has the types of the
    table's last day (a folder is looked for, never the table listed)."""
    there = [f for f in folders if path_exists(spark, f)]
    reader = spark.read.option("basePath", path)
    if there:
        return reader.parquet(*there)
    newest = newest_day_folder(spark, path)
    return (reader.parquet(newest) if newest else spark.read.parquet(path)).limit(0)


def read_lake(spark: SparkSession, path: str, columns=None, year=None, month=None, day=None,
              full: bool = False, schema: str | None = None, distinct: bool = True) -> DataFrame:
    """S1-S3, S6-S9.

    * ``year/month/day``: read that day, month or year (an explicit year wins over ``full``).
    * no year and ``full``: every partition.
    * ``columns``: projection pushed to the scan; partition columns are kept only when
      asked for, except that the given date parts are attached as columns (S8).
    * exact duplicate rows of the read set are dropped (S7), before the date parts are
      attached — as in the studied system, a row repeated on two days of one month
      collapses in a month read; in a full read the date parts count only when asked for.
    """
    if year is None and not full:
        raise ValueError("read_lake needs a year (or full=True); resolve the job date first")
    if not path_exists(spark, path):
        cols = list(columns) if columns else None
        df = empty_frame(spark, cols, schema)
    else:
        parts = []
        for v in (year, month, day):
            if v is None:
                break
            parts.append(v)
        df = read_folders(spark, path, [folder_of(path, *parts)]) if parts else spark.read.option("basePath", path).parquet(path)
        if columns:
            df = df.select(*[F.col(c) for c in columns])
        else:
            df = df.select(*[c for c in df.columns if c not in PART_COLS or year is None])
    if distinct:
        df = df.distinct()
    for name, v in zip(PART_COLS, (year, month, day)):
        if v is None:
            break
        if name not in df.columns:
            df = df.withColumn(name, F.lit(int(v)))
    return df


def latest_per_key(df: DataFrame, keys, order=PART_COLS, tie=()) -> DataFrame:
    """The newest row per key.

    Newest = greatest ``order`` (the numeric date parts, D22), then greatest ``tie``
    columns, then the greatest 64-bit hash of the row (D5) so that ties never depend on
    read order.  Rows with a null key part are dropped (grouping drops them).

    Planned as ``row_number = 1``: Spark keeps the first row of each key in every map task
    (WindowGroupLimit) before the shuffle, so a key holding a third of the table costs one
    row per task on the wire, not a third of the table in one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    newest = [F.col(c).desc() for c in [*order, *tie]] + [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).desc()]
    w = Window.partitionBy(*keys).orderBy(*newest)
    return (df.dropna(subset=keys).withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def folder_passes(spark: SparkSession, path: str, level: int = 0) -> list[list[tuple[str, int]]]:
    """The folders of a lake table with their numbers of files, in passes of up to ``FILES_PER_PASS``:
    whole years, of larger ones months, of larger ones days."""
    passes, room = [], 0
    for name in sorted(n for n in child_names(spark, path) if n.startswith(f"{PART_COLS[level]}=")):  # that of no date too
        folder = f"{path.rstrip('/')}/{name}"
        files = file_count(spark, folder)
        if files > FILES_PER_PASS and level + 1 < len(PART_COLS):
            passes += folder_passes(spark, folder, level + 1)
            room = 0
            continue
        if files > room:
            passes.append([])
            room = max(FILES_PER_PASS, files)
        passes[-1].append((folder, files))
        room -= files
    return passes


def newest_in_passes(spark: SparkSession, path: str, columns, keys, tie=()) -> DataFrame:
    """The newest row per key of a table of too many files for one read: that of each pass is written
    to the scratch folder, and of those the newest is taken. The driver lists one pass at a time."""
    at, schema = f"{scratch_root(spark)}/newest-{uuid.uuid4().hex}", None
    remove_path(spark, at, on_exit=True)
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    passes = folder_passes(spark, path)
    for i, folders in enumerate(passes):
        names, reader = [f for f, _ in folders], spark.read.option("basePath", path)
        before = spark.conf.get(LISTING_CACHE)
        spark.conf.set(LISTING_CACHE, "false")
        try:
            if schema is None:
                schema = StructType([StructField(f.name, IntegerType() if f.name in PART_COLS else f.dataType) for f in reader.parquet(*names).schema])
            df = reader.schema(schema).parquet(*names)
        finally:
            spark.conf.set(LISTING_CACHE, before)
        tasks = max(spark.sparkContext.defaultParallelism, sum(n for _, n in folders) // FILES_PER_TASK, estimated_bytes(df) // split)
        df = df.select(*columns) if columns else df
        latest_per_key(df.coalesce(int(tasks)), keys, tie=tie).write.parquet(f"{at}/{i}")
    rows = spark.read.parquet(*[f"{at}/{i}" for i in range(len(passes))])
    return latest_per_key(rows, keys, tie=tie)


def read_range(spark: SparkSession, src, root: str, start: _dt.date, end: _dt.date) -> DataFrame:
    """One scan of the days from ``start`` to ``end``: what the day reads give together,
    each row with its date parts, exact duplicates within a day dropped."""
    path = src.path(root)
    columns = [c for c in src.columns if c not in PART_COLS] if src.columns else None
    if not path_exists(spark, path):
        return empty_frame(spark, [*(columns or []), *PART_COLS], src.schema)
    df = read_folders(spark, path, date_folders(path, start, end))
    return df.select(*[c for c in columns or df.columns if c not in PART_COLS], *PART_COLS).distinct()


def read_history(spark: SparkSession, path: str, start_year: int, years: int = 10, columns=None,
                 schema: str | None = None, distinct: bool = True) -> DataFrame:
    """``years`` calendar years back from ``start_year``, distinct unless the caller drops
    repeats itself.  One scan of the years that are there (D8: a missing year in the middle does
    not stop the read)."""
    if not path_exists(spark, path):
        return empty_frame(spark, list(columns) if columns else None, schema)
    wanted = [y for y in _numbered(spark, path, PART_COLS[0]) if int(start_year) - int(years) < y <= int(start_year)]
    df = read_folders(spark, path, [folder_of(path, y) for y in wanted])
    if columns:
        df = df.select(*columns)
    return df.distinct() if distinct else df


def read_source(spark: SparkSession, src, ctx, inputs: dict | None = None) -> DataFrame:
    """Read one declared ``Source`` for a run context; ``inputs`` are the spec's sources read
    before it, which a query may use."""
    from tamarind import spec as S

    path = src.path(ctx.lake_root)
    if src.kind == S.LATEST:
        if ctx.state_root:
            from tamarind.sources.newest import refresh
            return refresh(spark, src, ctx.lake_root, ctx.state_root)
        cols = list(src.columns) if src.columns else None
        if cols is not None:
            cols = cols + [c for c in PART_COLS if c not in cols]  # D1: keep date parts to rank
        if path_exists(spark, path) and file_count(spark, path) > FILES_PER_PASS:
            return newest_in_passes(spark, path, cols, src.keys, src.tie)
        # repeated rows cannot change the newest one: no distinct before it
        df = read_lake(spark, path, columns=cols, full=True, schema=src.schema, distinct=False)
        return latest_per_key(df, src.keys, tie=src.tie)
    if src.kind == S.HISTORY:
        return read_history(spark, path, ctx.start_year, ctx.history_years, src.columns, src.schema, distinct=not src.repeats)
    if src.kind == S.WAREHOUSE:
        from tamarind.sources.warehouse import read_warehouse
        return read_warehouse(spark, ctx.warehouse_root, src.table, schema=src.schema)
    if src.kind == S.SQL:
        from tamarind.sources.warehouse import read_sql
        return read_sql(spark, src, ctx.warehouse_root, inputs)
    c = ctx.resolved()
    if c.full and c.year is None:
        return read_lake(spark, path, columns=src.columns, full=True, schema=src.schema)
    return read_lake(spark, path, columns=src.columns, year=c.year, month=c.month, day=c.day,
                     schema=src.schema)
