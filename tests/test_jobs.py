"""Jobs: per-table failure reporting, full-load default, month reads."""

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from tamarind import jobs
from tamarind.context import RunContext, default_job_date
from tamarind.plans.common import schema
from tamarind.queries.operators import ensure_lake
from tamarind.session import scratch_root
from tamarind.sources import lake
from tamarind.spec import Source, TableSpec


def _events_spec(build):
    return TableSpec("ev", "ev", ("date_id", "user_id"),
                     (Source("events", "events", app="app", columns=("user_id", "ts")),), build,
                     schema("user_id:long, date_id:date"))


def test_default_job_date_is_yesterday_in_utc_plus_7():
    assert default_job_date(dt.datetime(2024, 1, 15, 16, 59)) == dt.date(2024, 1, 14)
    assert default_job_date(dt.datetime(2024, 1, 15, 17, 0)) == dt.date(2024, 1, 15)


def test_run_all_reports_failures_per_table(spark, sf_dir):
    root = ensure_lake(spark, sf_dir, "events", "ts")
    wh = f"{scratch_root(spark)}/jobs-test-{dt.datetime.now().timestamp()}"
    ctx = RunContext(lake_root=root, warehouse_root=wh, year=2024, month=1, day=3)

    def ok(src, c):
        return src["events"].select("user_id", F.col("ts").cast("date").alias("date_id"))

    def broken(src, c):
        raise RuntimeError("boom")

    report = jobs.run_all(spark, [_events_spec(ok), replace(_events_spec(broken), name="bad")], ctx)
    assert report["ev"]["rows"] > 0
    assert "boom" in report["bad"]["error"]


def test_full_default_reads_everything(spark, sf_dir):
    root = ensure_lake(spark, sf_dir, "events", "ts")
    spec = replace(_events_spec(lambda src, c: src["events"]), full_default=True)
    full = jobs.build(spark, spec, RunContext(lake_root=root))
    day = jobs.build(spark, spec, RunContext.for_date(root, dt.date(2024, 1, 3)))
    assert full.count() > day.count() > 0


def test_month_read_collapses_repeats_and_attaches_parts(spark, sf_dir):
    root = ensure_lake(spark, sf_dir, "events", "ts")
    df = lake.read_lake(spark, f"{root}/app/events", columns=["event_type"], year=2024, month=1)
    rows = df.collect()
    assert len(rows) == 5                                   # one row per event type in the month
    assert {(r.calendar_year, r.month_no) for r in rows} == {(2024, 1)}
    assert "day_of_month" not in df.columns


def test_job_date_comes_from_the_run_clock_once(spark, sf_dir):
    root = ensure_lake(spark, sf_dir, "events", "ts")
    seen = []
    spec = _events_spec(lambda src, c: seen.append((c.year, c.month, c.day)) or src["events"])
    jobs.build(spark, spec, RunContext(lake_root=root, run_ts=dt.datetime(2024, 3, 1, 0, 30)))
    assert seen == [(2024, 2, 29)]


def test_missing_warehouse_table_reads_as_empty(spark):
    from tamarind.plans.user import DIM_PARTY
    from tamarind.sources.warehouse import read_warehouse
    assert read_warehouse(spark, f"{scratch_root(spark)}/no-warehouse", "dim_party", DIM_PARTY).collect() == []


def test_all_tables_from_lake_to_warehouse(spark, sf_dir):
    """Every spec reads its declared lake and warehouse sources and loads what its builder's oracle holds."""
    from tamarind.queries.compare import compare, duck
    from tamarind.queries.jobs import RUN_ALL_ORACLE, run_all_tables
    res = compare(run_all_tables(spark, sf_dir), RUN_ALL_ORACLE, sf_dir, duck(sf_dir))
    assert res["ok"], res
