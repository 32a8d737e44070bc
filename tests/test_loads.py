"""Path-level reads, kept newest rows, replays, heavy keys, load rules, ledger, order by dependence."""

import datetime as dt
import glob
import os
import re
import shutil
import uuid
from dataclasses import replace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tamarind import jobs
from tamarind import operators as op
from tamarind.context import RunContext
from tamarind.plans.common import schema
from tamarind.plans.registry import BY_NAME, SPECS
from tamarind.queries import loads as Q
from tamarind.queries.operators import FOLDERS_PER_TASK, ensure_adapter_lake, ensure_lake, write_days
from tamarind.session import create_file, path_exists, scratch_root
from tamarind.sinks import ledger
from tamarind.sinks.warehouse import LoadRules, append, load, side_path, stored_schema
from tamarind.sources import lake, newest
from tamarind.spec import Source, TableSpec


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def local(path):
    return path.removeprefix("file:")


@pytest.fixture()
def folder(spark):
    return f"{scratch_root(spark)}/loads-test-{uuid.uuid4().hex}"


# ------------------------------------------------------------ lake reads ----
@pytest.fixture(scope="module")
def long_lake(spark):
    """A table of 3,650 days, one row each: (n, its day)."""
    root = f"{scratch_root(spark)}/long-lake-{uuid.uuid4().hex}"
    spark.range(1).select(F.col("id").alias("n"), F.lit("a").alias("v")).coalesce(1).write.parquet(f"{root}/one")
    one = glob.glob(local(f"{root}/one/*.parquet"))[0]
    for i in range(3650):
        d = dt.date(2014, 1, 1) + dt.timedelta(days=i)
        at = local(lake.folder_of(f"{root}/t", d.year, d.month, d.day))
        os.makedirs(at)
        shutil.copy(one, at)
    return f"{root}/t"


def test_a_read_lists_only_its_folders(spark, long_lake):
    day = lake.read_lake(spark, long_lake, columns=["n"], year=2020, month=2, day=29)
    assert "InMemoryFileIndex(1 paths)[" in plan(day) and "ReadSchema: struct<n:bigint>" in plan(day)
    assert len(day.inputFiles()) == 1 and "month_no=2/day_of_month=29/" in day.inputFiles()[0] and day.count() == 1
    month = lake.read_lake(spark, long_lake, year=2020, month=2, distinct=False)
    assert "InMemoryFileIndex(1 paths)[" in plan(month) and len(month.inputFiles()) == 29
    years = lake.read_history(spark, long_lake, 2016, 2)
    assert "InMemoryFileIndex(2 paths)[" in plan(years) and len(years.inputFiles()) == 731
    src = Source("t", "t", app="x")
    some = lake.read_range(spark, replace(src, app=os.path.basename(os.path.dirname(long_lake))), os.path.dirname(os.path.dirname(long_lake)),
                           dt.date(2015, 12, 30), dt.date(2016, 2, 2))
    assert "InMemoryFileIndex(5 paths)[" in plan(some) and some.count() == 35


def test_a_missing_day_is_an_empty_typed_frame(spark, long_lake):
    for parts in ({"year": 2030, "month": 1, "day": 1}, {"year": 2023, "month": 12, "day": 31}, {"year": 1999}):
        df = lake.read_lake(spark, long_lake, columns=["n", "v"], **parts)
        assert df.collect() == [] and dict(df.dtypes)["n"] == "bigint" and dict(df.dtypes)["v"] == "string"
    assert lake.read_history(spark, long_lake, 1990, 3, columns=["n"]).dtypes == [("n", "bigint")]


def test_date_folders_cover_a_range_exactly():
    p = "/t"
    assert lake.date_folders(p, dt.date(2023, 12, 30), dt.date(2025, 2, 1)) == [
        lake.folder_of(p, 2023, 12, 30), lake.folder_of(p, 2023, 12, 31), lake.folder_of(p, 2024), lake.folder_of(p, 2025, 1), lake.folder_of(p, 2025, 2, 1)]
    assert lake.date_folders(p, dt.date(2024, 2, 1), dt.date(2024, 2, 29)) == [lake.folder_of(p, 2024, 2)]
    assert lake.date_folders(p, dt.date(2024, 2, 2), dt.date(2024, 2, 1)) == []


# ------------------------------------------------------- kept newest rows ----
SRC = Source("t", "t", app="a", kind="latest", keys=("k",), tie=("v",), columns=("k", "v"))


def put(spark, root, day, rows, mode="append"):
    d = dt.date(2024, 1, day)
    spark.createDataFrame(rows, "k string, v long").coalesce(1).write.mode(mode).parquet(lake.folder_of(f"{root}/a/t", d.year, d.month, d.day))


def kept(spark, root):
    rows = sorted((r.k, r.v, r.day_of_month) for r in newest.refresh(spark, SRC, root, f"{root}/state").collect())
    whole = lake.latest_per_key(lake.read_lake(spark, f"{root}/a/t", full=True, columns=["k", "v", *lake.PART_COLS]), SRC.keys, tie=SRC.tie)
    assert rows == sorted((r.k, r.v, r.day_of_month) for r in whole.collect())
    return rows


def test_state_follows_the_lake_and_reads_new_days_only(spark, folder, monkeypatch):
    read = []
    folders, whole = newest.read_folders, newest._read
    monkeypatch.setattr(newest, "read_folders", lambda s, p, f: read.append([x.rpartition("=")[2] for x in f]) or folders(s, p, f))
    monkeypatch.setattr(newest, "_read", lambda s, src, p, f: (read.append("all") if f is None else None) or whole(s, src, p, f))
    put(spark, folder, 2, [("a", 1), ("b", 1), (None, 5)])
    put(spark, folder, 5, [("a", 2)])
    assert kept(spark, folder) == [("a", 2, 5), ("b", 1, 2)] and read == ["all"]
    assert kept(spark, folder) and read == ["all"]                                  # nothing new: nothing read
    put(spark, folder, 6, [("c", 1), ("b", 0), ("b", 3)])
    assert kept(spark, folder) == [("a", 2, 5), ("b", 3, 6), ("c", 1, 6)] and read[1:] == [["6"]]
    put(spark, folder, 3, [("a", 9), ("d", 9)])                                      # a late day
    assert kept(spark, folder) == [("a", 2, 5), ("b", 3, 6), ("c", 1, 6), ("d", 9, 3)] and read[2:] == [["3"]]
    put(spark, folder, 6, [("c", 7)])                                                # more files of a known day
    assert ("c", 7, 6) in kept(spark, folder) and read[3:] == [["6"]]
    put(spark, folder, 5, [("e", 1)], "overwrite")                                   # a known day rewritten: start over
    assert ("a", 9, 3) in kept(spark, folder) and read[4:] == ["all"]
    shutil.rmtree(local(lake.folder_of(f"{folder}/a/t", 2024, 1, 6)))                # and one removed
    assert ("b", 1, 2) in kept(spark, folder) and read[5:] == ["all"]
    state = newest.state_folder(f"{folder}/state", SRC)
    assert len(glob.glob(local(f"{state}/version-*"))) == 2                          # older versions are removed


def test_of_two_runs_at_once_one_fails(spark, folder):
    put(spark, folder, 2, [("a", 1)])
    kept(spark, folder)
    put(spark, folder, 3, [("a", 2)])
    state = newest.state_folder(f"{folder}/state", SRC)
    create_file(spark, f"{state}/done-00000002", "the other run's")
    number = newest.last_version
    try:
        newest.last_version = lambda s, f: (1, f"{f}/{open(local(f'{f}/done-00000001')).read()}")
        with pytest.raises(Exception, match="(?i)exist"):
            newest.refresh(spark, SRC, folder, f"{folder}/state")
    finally:
        newest.last_version = number


def test_a_run_uses_the_kept_state(spark, folder):
    put(spark, folder, 2, [("a", 1), ("b", 1)])
    ctx = RunContext(lake_root=folder, state_root=f"{folder}/state", full=True)
    assert lake.read_source(spark, SRC, ctx).count() == 2 and path_exists(spark, newest.state_folder(f"{folder}/state", SRC))
    assert lake.read_source(spark, replace(SRC, table="none", schema="k string, v long"), ctx).collect() == []


# ------------------------------------------------------------- replays ----
def test_a_replay_equals_day_by_day(spark, sf_dir, folder, monkeypatch):
    root = ensure_lake(spark, sf_dir, "events", "ts")
    monkeypatch.setattr(jobs, "DAYS_PER_PASS", 9)
    out = []
    for how in (True, False):
        ctx = RunContext(lake_root=root, warehouse_root=f"{folder}/{how}")
        reports = jobs.run_range(spark, Q.WEEKLY, ctx, dt.date(2024, 1, 2), dt.date(2024, 1, 28), day_by_day=how)
        assert len(reports) == (27 if how else 3)
        rows = spark.read.schema(Q.WEEKLY.schema).parquet(f"{folder}/{how}/weekly_users").collect()
        out.append(sorted((str(r.date_id), r.user_id or -1, r.event_id) for r in rows))
    assert out[0] == out[1] and len(out[0]) > 100


def test_tables_that_cannot_be_replayed_run_day_by_day(spark, sf_dir, folder):
    ctx = RunContext(lake_root=ensure_lake(spark, sf_dir, "events", "ts"), warehouse_root=folder)
    spec = replace(Q.WEEKLY, pk=("user_id",))
    assert len(jobs.run_range(spark, spec, ctx, dt.date(2024, 1, 2), dt.date(2024, 1, 4))) == 3


# ---------------------------------------------------------- heavy keys ----
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_split_join_equals_the_plain_one(spark, how, null_safe):
    left = spark.createDataFrame([(i, None if i % 4 == 0 else "hot" if i % 4 < 3 else f"k{i}", i % 3) for i in range(400)], "id long, a string, b long")
    right = spark.createDataFrame([(f"r{i}", k, i % 3) for i, k in enumerate(["hot", "hot", None, "k3", "k7", "none", "hot"])], "name string, a string, b long")
    plain = op.lookup_join(left, right, ["a", "b"], ["a", "b"], how, null_safe=null_safe)
    split = op.split_join(left, right, ["a", "b"], ["a", "b"], how, null_safe=null_safe)
    assert split.columns == plain.columns
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))


def test_split_join_refuses_what_it_cannot_split(spark):
    df = spark.range(3)
    with pytest.raises(ValueError, match="cannot split"):
        op.split_join(df, df, "id", "id", "right")


def test_no_task_holds_a_heavy_key(spark, sf_dir):
    keys = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    held = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "false")  # neither AQE's own split nor a broadcast
        spark.conf.set(keys[1], "-1")
        sizes = {}
        for join in (op.lookup_join, op.split_join):
            left = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).alias("k"))
            right = spark.range(60_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).unionByName(spark.range(1).select(F.lit(-1).alias("k"), F.lit(7).alias("v")))
            out = join(left, right, "k", "k", "left", null_safe=True)
            rows = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
            sizes[join.__name__] = max(rows) / sorted(rows)[len(rows) // 2]
        assert sizes["split_join"] < 3 < sizes["lookup_join"], sizes
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


# ---------------------------------------------------------- load rules ----
def test_target_schema_rules(spark, folder):
    old, new = schema("v:str, k:int, date_id:date"), schema("k:long, v:str, extra:str, date_id:date")
    spec = TableSpec("t", "t", ("date_id", "k"), (), lambda s, c: None, new)
    day = F.lit(dt.date(2024, 1, 1)).alias("date_id")
    append(spark, spark.range(3).select(F.col("id").cast("string").alias("v"), F.col("id").alias("k"), day), f"{folder}/t", old)
    rows = spark.range(2, 5).select(F.col("id").alias("k"), F.lit(7).alias("v"), F.lit("x").alias("extra"), day)
    with pytest.raises(ValueError, match="does not have"):
        load(spark, rows, folder, spec, LoadRules(target_schema="target"))
    with pytest.raises(ValueError, match="unknown rule"):
        load(spark, rows, folder, spec, LoadRules(target_schema="other"))
    for _ in range(2):
        load(spark, rows, folder, spec, LoadRules(target_schema="target+add"))
    now = stored_schema(spark, f"{folder}/t")
    assert now.simpleString() == "struct<v:string,k:int,date_id:date,extra:string>"
    got = sorted((r.k, r.v, r.extra) for r in spark.read.schema(now).parquet(f"{folder}/t").collect())
    assert got == [(0, "0", None), (1, "1", None), (2, "7", "x"), (3, "7", "x"), (4, "7", "x")]
    with pytest.raises(ValueError, match="missing"):  # the target's columns must all be built
        load(spark, rows.drop("v"), folder, replace(spec, schema=schema("k:long, date_id:date")), LoadRules(target_schema="target"))


def test_rows_without_a_key_are_replaced(spark, folder):
    sch = schema("k:long, v:str, dwh_crtd_dttm:ts, dwh_updt_dttm:ts, date_id:date")
    spec = TableSpec("t", "t", ("date_id", "k"), (), lambda s, c: None, sch)
    for clock in (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)):  # only the run's clock differs
        rows = [(1, "a", dt.date(2024, 1, 1)), (None, "b", dt.date(2024, 1, 1)), (None, "b", dt.date(2024, 1, 1)), (2, "c", None), (None, None, None)]
        df = spark.createDataFrame(rows, "k long, v string, date_id date").withColumns({c: F.lit(clock) for c in ("dwh_crtd_dttm", "dwh_updt_dttm")})
        load(spark, df, folder, spec, LoadRules(no_key="side"))
    read = lambda p: sorted((r.k or -1, r.v or "", str(r.date_id), r.dwh_crtd_dttm.day) for r in spark.read.schema(sch).parquet(p).collect())
    assert read(f"{folder}/t") == [(1, "a", "2024-01-01", 2)]
    assert read(side_path(f"{folder}/t")) == [(-1, "", "None", 2), (-1, "b", "2024-01-01", 2), (-1, "b", "2024-01-01", 2), (2, "c", "None", 2)]


def test_append_once_after_a_failure(spark, folder, monkeypatch):
    sch, path = schema("k:long, date_id:date"), f"{folder}/t"
    rows = lambda n: spark.range(n).select(F.col("id").alias("k"), F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 3).cast("int")).alias("date_id"))
    keys = lambda: sorted(r.k for r in spark.read.schema(sch).parquet(path).collect())
    append(spark, rows(1), path, sch)                                     # rows of another kind of load stay
    real, moves = ledger.move_path, []

    def breaks(s, a, b):
        if len(moves) == 2:
            raise OSError("lost")
        moves.append(b)
        real(s, a, b)

    monkeypatch.setattr(ledger, "move_path", breaks)
    with pytest.raises(OSError):
        ledger.append_once(spark, rows(9), path, sch, "t-2024-01-01")
    assert ledger.loads(spark, path) == {"t-2024-01-01": False} and len(keys()) > 1
    monkeypatch.setattr(ledger, "move_path", real)
    assert ledger.append_once(spark, rows(9), path, sch, "t-2024-01-01")["rows"] == 9 and keys() == sorted([0, *range(9)])
    assert ledger.append_once(spark, rows(9), path, sch, "t-2024-01-01")["repeated"] and len(keys()) == 10
    assert ledger.append_once(spark, rows(4), path, sch, "t-2024-01-01", "replace")["rows"] == 4 and keys() == [0, 0, 1, 2, 3]
    ledger.append_once(spark, rows(2), path, sch, "t-2024-01-02")
    assert keys() == [0, 0, 0, 1, 1, 2, 3] and ledger.loads(spark, path) == {"t-2024-01-01": True, "t-2024-01-02": True}
    assert spark.read.parquet(path).columns == ["k", "date_id"] and not glob.glob(local(f"{path}/_stage*"))


def test_a_rerun_of_the_address_loads_adds_nothing(spark, sf_dir, folder):
    """T19 and T20, which append to one table."""
    for name in ("dim_address", "dim_address_mobileuser"):
        spec = BY_NAME[name]
        for s in spec.sources:
            root = ensure_adapter_lake(spark, sf_dir, s.table, s, monthly=True)
        ctx = RunContext(lake_root=root, warehouse_root=folder, run_ts=dt.datetime(2025, 1, 1), full=True)
        counts = []
        for _ in range(2):
            jobs.run(spark, spec, ctx, rules=LoadRules(append="skip"))
            counts.append(spark.read.schema(spec.schema).parquet(f"{folder}/dim_address").count())
        assert counts[0] == counts[1] > 0, name


def test_files_by_key_ranges(spark, folder):
    sch = schema("k:long, v:str, date_id:date")
    df = spark.range(40_000).select(((F.col("id") * 7919) % 40_000).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(dt.date(2024, 1, 1)).alias("date_id"))
    spec = TableSpec("t", "t", ("date_id", "k"), (), lambda s, c: None, sch)
    held = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # at this size AQE would write one file
        for _ in range(2):  # a first load and a merge
            load(spark, df, folder, spec, LoadRules(cluster=("k",)))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", held)
    stats = []
    for f in glob.glob(local(f"{folder}/t/*/*.parquet")):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            c = next(meta.row_group(g).column(i) for i in range(meta.num_columns) if meta.row_group(g).column(i).path_in_schema == "k")
            stats.append((c.statistics.min, c.statistics.max, meta.row_group(g).num_rows))
    read = sum(n for low, high, n in stats if any(low <= k <= high for k in (11, 17, 23)))
    assert sum(n for *_, n in stats) == 40_000 and read <= 40_000 / 4
    assert spark.read.schema(sch).parquet(f"{folder}/t").where("k IN (11, 17, 23)").count() == 3


# ------------------------------------------------------ order by dependence ----
def test_dependence_of_the_registry():
    graph = jobs.dependence(SPECS)
    assert graph["dim_party_memberstatus"]["needs"] == {"dim_party_homeservice", "dim_party_gu", "dim_party_ru"}
    assert graph["dim_address_mobileuser"]["after"] == {"dim_address"} and not graph["dim_unit"]["needs"]


def test_side_by_side_gives_what_one_by_one_gives(spark, sf_dir, folder):
    root = ensure_lake(spark, sf_dir, "events", "ts")
    out = []
    for n in (1, 4):
        ctx = RunContext.for_date(root, dt.date(2024, 1, 2), warehouse_root=f"{folder}/{n}")
        report = jobs.run_all(spark, Q._registry(), ctx, at_once=n)
        assert list(report) == [s.name for s in Q._registry()]
        out.append({k: v.get("rows") or sorted(v) for k, v in report.items()})
    assert out[0] == out[1] and out[0]["bad_counts"] == ["held"]


def test_a_failure_on_a_shared_table_holds_back_its_readers_only(spark, sf_dir, folder):
    specs = [s for s in Q._registry() if s.name in ("errors", "clicks", "counts")]

    def broken(src, ctx):
        raise RuntimeError("boom")

    specs[0] = replace(specs[0], build=broken)
    ctx = RunContext.for_date(ensure_lake(spark, sf_dir, "events", "ts"), dt.date(2024, 1, 2), warehouse_root=folder)
    report = jobs.run_all(spark, specs, ctx)
    assert "boom" in report["errors"]["error"] and report["clicks"]["rows"] > 0 and report["counts"] == {"held": ["errors"]}


# ---------------------------------------------------------- SQL sources ----
def test_sql_sources_push_their_filters(spark, sf_dir):
    from tamarind.sources.warehouse import read_sql
    root = Q.sql_warehouse(spark, sf_dir)
    p = plan(read_sql(spark, Q._FROM_SQL[1], root))
    assert "PushedFilters: [IsNotNull(addr_type_id), EqualTo(addr_type_id,5)]" in p
    with pytest.raises(ValueError, match="not read"):
        read_sql(spark, Q._FROM_SQL[2], root)
    assert not [t for t in spark.catalog.listTables() if t.name in ("dim_address", "p", "wanted")]


# ------------------------------------------------- tables of many rows ----
@pytest.mark.parametrize("years", [400, 2])
def test_many_small_day_folders_are_written_by_many_tasks(spark, folder, years):
    """Thousands of folders of a row each, of many years or of few: no task writes them all."""
    n = 2400
    days = spark.range(n).selectExpr("id", f"CAST(2000 + id % {years} AS INT) AS calendar_year", f"CAST(1 + id DIV {years} % 12 AS INT) AS month_no",
                                     f"CAST(1 + id DIV {years} DIV 12 AS INT) AS day_of_month").coalesce(1)
    write_days(days, folder)
    files = glob.glob(f"{local(folder)}/*/*/*/*.parquet")
    by_task = {}
    for f in files:
        by_task.setdefault(os.path.basename(f).split("-")[1], []).append(f)
    assert len(files) == n and max(map(len, by_task.values())) <= 3 * FOLDERS_PER_TASK
    back = spark.read.parquet(folder).select(days.columns)
    assert back.exceptAll(days).isEmpty() and back.count() == n


def test_newest_rows_of_many_files_are_read_in_passes(spark, folder, monkeypatch):
    """Years, months and days of more files than a pass takes, rows of equal date and null keys: the
    rows of one read, and no read is given more files than a pass has room for."""
    rows = spark.range(4000).selectExpr("nullif('k' || id % 90, 'k5') AS k", "id % 7 AS v", "id AS other", "CAST(2000 + sqrt(id) % 3 AS INT) AS calendar_year",
                                        "CAST(nullif(id % 3, 0) AS INT) AS month_no", "CAST(1 + id % 4 AS INT) AS day_of_month")
    path = f"{folder}/a/t"
    rows.repartition(3, "v").write.partitionBy(*lake.PART_COLS).parquet(path)
    src = replace(SRC, columns=("k", "v", "other"))
    ctx = RunContext(lake_root=folder)
    whole = lake.read_source(spark, src, ctx)
    listed, estimate = [], lake.estimated_bytes
    monkeypatch.setattr(lake, "estimated_bytes", lambda df: listed.append(len(df.inputFiles())) or estimate(df))
    n = len(glob.glob(f"{local(path)}/*/*/*/*.parquet"))
    for most in (n - 1, 7):
        listed.clear()
        monkeypatch.setattr(lake, "FILES_PER_PASS", most)
        passed = lake.read_source(spark, src, ctx)
        assert passed.schema == whole.schema and sorted(passed.collect()) == sorted(whole.collect()) and whole.count() == 89
        assert sum(listed) == n and max(listed) <= max(most, 3) and len(listed) > 1


def test_a_scan_is_dealt_by_the_rows_it_holds(spark, folder):
    """Keys pack well: a file of few MB holds millions of wide rows. Twice the rows, twice the tasks,
    also where the file has fewer splits than there are cores."""
    wide = [f"'x' || id % {k} AS c{k}" for k in range(1, 40)]
    parts = []
    for n in (1_500_000, 3_000_000):
        spark.range(n).selectExpr("id * 7919 % 1000003 AS id").coalesce(1).write.parquet(f"{folder}/{n}")
        df = spark.read.parquet(f"{folder}/{n}").selectExpr("id", *wide)
        dealt = lake.deal_small_scan(df)._jdf.queryExecution().optimizedPlan().toString()
        parts.append(int(re.search(r"^RepartitionByExpression \[.*\], (\d+)", dealt)[1]))
    assert parts[0] > 2 * spark.sparkContext.defaultParallelism and 1.8 < parts[1] / parts[0] < 2.2
