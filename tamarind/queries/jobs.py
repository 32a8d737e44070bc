"""Job queries: whole runs from lake tables to warehouse tables (M*, S12, K5, K6)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind import functions as fn
from tamarind import jobs
from tamarind.context import RunContext
from tamarind.plans.common import schema
from tamarind.plans.registry import BY_NAME, SPECS
from tamarind.queries.adapters import ADAPTERS
from tamarind.queries.builders import ORACLES as BUILDERS
from tamarind.queries.builders import QUERIES as BUILDER_QUERIES
from tamarind.queries.operators import _fresh_table, ensure_adapter_lake, ensure_lake
from tamarind.queries.tables import RUN_TS
from tamarind.sources.warehouse import read_warehouse
from tamarind.spec import WAREHOUSE, Source, TableSpec

QUERIES: dict = {}
ORACLES: dict = {}


def _events_build(src, ctx):
    return src["events"].select("event_id", "user_id", "event_type", fn.date_id_from_ts("ts").alias("date_id"))


EVENTS = TableSpec("events_daily", "events_daily", ("date_id", "user_id", "event_type"),
                   (Source("events", "events", app="app", columns=("event_id", "ts", "user_id", "event_type")),),
                   _events_build, schema("event_id:long, user_id:long, event_type:str, date_id:date"))


def _by_day(src, ctx):
    return src["events"].select("event_id", "value", fn.date_id_from_parts("calendar_year", "month_no", "day_of_month").alias("date_id"))


EVENT_VALUES = TableSpec("event_values", "event_values", ("date_id", "event_id"),
                         (Source("events", "events", app="app", columns=("event_id", "value")),), _by_day,
                         schema("event_id:long, value:dbl, date_id:date"), row_local=True)


def _backfill(spark, sf_dir, specs, **how) -> tuple[str, list[dict]]:
    root = ensure_lake(spark, sf_dir, "events", "ts")
    wh = _fresh_table(spark, sf_dir, "range")
    ctx = RunContext(lake_root=root, warehouse_root=wh, run_ts=RUN_TS)
    reports = jobs.run_range(spark, specs, ctx, _dt.date(2024, 1, 10), _dt.date(2024, 1, 12), **how)
    jobs.run_range(spark, specs, ctx, _dt.date(2024, 1, 11), _dt.date(2024, 1, 11))  # a rerun of a day changes nothing
    return wh, reports


def q_backfill_range(spark, sf_dir) -> DataFrame:
    """M2: a three-day range of two tables, one replayed in a pass, one (row-local) in one read."""
    wh, reports = _backfill(spark, sf_dir, [EVENTS, EVENT_VALUES])
    if len(reports) != 2:
        raise AssertionError("one load of each table")
    a = read_warehouse(spark, wh, "events_daily").select(F.lit("events_daily").alias("t"), "event_id", F.col("event_type").alias("v"), "date_id")
    b = read_warehouse(spark, wh, "event_values").select(F.lit("event_values").alias("t"), "event_id", F.col("value").cast("string").alias("v"), "date_id")
    return a.unionByName(b).select("t", "event_id", F.when(F.col("t") == "events_daily", F.col("v")).alias("v"), "date_id")


QUERIES["q_backfill_range"] = q_backfill_range
ORACLES["q_backfill_range"] = """
WITH e AS (SELECT *, CAST(ts AS DATE) AS d FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12')
SELECT 'events_daily' AS t, event_id, event_type AS v, d AS date_id FROM e
UNION ALL SELECT 'event_values', event_id, NULL, d FROM (SELECT DISTINCT event_id, value, d FROM e)"""


def q_range_row_local(spark, sf_dir) -> DataFrame:
    """M2: the row-local table, loaded day by day instead: the same rows."""
    wh, reports = _backfill(spark, sf_dir, replace(EVENT_VALUES, row_local=False), day_by_day=True)
    if len(reports) != 3:
        raise AssertionError("a load of each day")
    return read_warehouse(spark, wh, "event_values").select("event_id", "value", "date_id")


QUERIES["q_range_row_local"] = q_range_row_local
ORACLES["q_range_row_local"] = """SELECT DISTINCT event_id, value, CAST(ts AS DATE) AS date_id FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'"""


def q_default_job_date(spark, sf_dir) -> DataFrame:
    """Without a date a run reads the day before its clock (16 January, 03:00 UTC+7)."""
    root = ensure_lake(spark, sf_dir, "events", "ts")
    ctx = RunContext(lake_root=root, run_ts=_dt.datetime(2024, 1, 16, 3, 0))
    return jobs.build(spark, EVENTS, ctx)


QUERIES["q_default_job_date"] = q_default_job_date
ORACLES["q_default_job_date"] = """SELECT DISTINCT event_id, user_id, event_type, DATE '2024-01-15' AS date_id FROM events
WHERE CAST(ts AS DATE) = DATE '2024-01-15'"""


def q_run_dim_unit(spark, sf_dir) -> DataFrame:
    """M1 end to end: the unit and branch sources as lake tables, one month's run of the
    dim_unit spec (lake read S2 -> newest branch S10 -> build -> upsert K1), read back."""
    ensure_adapter_lake(spark, sf_dir, "tmBRN")
    root = ensure_adapter_lake(spark, sf_dir, "tmRoomH")
    spec = BY_NAME["dim_unit"]
    wh = _fresh_table(spark, sf_dir, "run")
    ctx = RunContext(lake_root=root, warehouse_root=wh, run_ts=RUN_TS, year=1996, month=1)
    jobs.run(spark, spec, ctx)
    jobs.run(spark, spec, ctx)  # a rerun replaces every key, except those with a null part (D16)
    return spark.read.schema(spec.schema).parquet(f"{wh}/{spec.target}").select(*spec.schema.fieldNames())


QUERIES["q_run_dim_unit"] = q_run_dim_unit
_MONTH = BUILDERS["b_dim_unit"] + " WHERE r.calendar_year = 1996 AND r.month_no = 1"
# the rerun adds the rows whose date_id is null once more, since a null key part never matches
ORACLES["q_run_dim_unit"] = f"WITH m AS ({_MONTH}) SELECT * FROM m UNION ALL SELECT * FROM m WHERE date_id IS NULL"

#: Source aliases whose adapter has another name than the table.
_RENAMED = {("dim_party_gu", "customer"): "mr_customer", ("dim_mobile_user", "customer"): "mr_customer"}


def lake_of_all_sources(spark, sf_dir) -> str:
    """Every declared lake source of the 33 specs, from its adapter, at its declared place."""
    root = ""
    for spec in SPECS:
        overrides = BUILDER_QUERIES[f"b_{spec.name}"].overrides or {}
        for s in spec.sources:
            if s.kind != WAREHOUSE:
                root = ensure_adapter_lake(spark, sf_dir, overrides.get(s.alias, _RENAMED.get((spec.name, s.alias), s.table)), s, monthly=True)
    return root


def run_all_tables(spark, sf_dir) -> DataFrame:
    """Every table in full, from lake to warehouse, in registry order;
    the tables that read the warehouse read what was written before them. One row per load."""
    ctx = RunContext(lake_root=lake_of_all_sources(spark, sf_dir), warehouse_root=_fresh_table(spark, sf_dir, "all"),
                     run_ts=RUN_TS, full=True, history_start_year=2024, history_years=100)
    report = jobs.run_all(spark, SPECS, ctx)
    rows = [(k, v.get("rows"), v.get("columns"), v.get("error")) for k, v in report.items()]
    return spark.createDataFrame(rows, "spec string, row_count long, column_count int, error string")


# a full lake read drops repeated rows (S7), so this table's devices are distinct ones
_DEVICES = f"({ADAPTERS['gu_device']})"
BUILT = {k: v.replace(_DEVICES, f"(SELECT DISTINCT * FROM {_DEVICES})") if k == "b_dim_device_detail" else v for k, v in BUILDERS.items()}
# too many small date folders for a driver query: a test runs it at sf0.001
RUN_ALL_ORACLE = " UNION ALL ".join(
    f"SELECT '{s.name}' AS spec, CAST(count(*) AS BIGINT) AS row_count, CAST({len(s.schema.fields)} AS INTEGER) AS column_count, "
    f"CAST(NULL AS VARCHAR) AS error FROM ({BUILT['b_' + s.name]})" for s in SPECS)
