"""Jobs (M1-M5): run one table for a date or in full, a date range, or all tables."""

from __future__ import annotations

import datetime as _dt
import uuid
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import replace
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarind import spec as S
from tamarind.context import RunContext
from tamarind.session import remove_path, scratch_root
from tamarind.sinks.warehouse import PARTITION_COL, PLAIN, LoadRules, load
from tamarind.sources.lake import read_range, read_source


def build(spark: SparkSession, spec, ctx: RunContext, inputs: dict | None = None) -> DataFrame:
    """Read every declared source (lazily) and build the table's plan.

    The job date is resolved once, from the context's clock, so all sources of a table see
    the same day. ``inputs`` holds sources that have been read already.
    """
    if spec.full_default and ctx.year is None:
        ctx = replace(ctx, full=True)
    ctx = ctx.resolved()
    given = inputs or {}
    frames = {}
    for s in spec.sources:
        frames[s.alias] = given[s.alias] if s.alias in given else read_source(spark, s, ctx, frames)
    return spec.build(frames, ctx)


def load_id(spec, ctx: RunContext) -> str:
    """Name of a table's load for the context's date: what a rerun repeats."""
    if spec.full_default and ctx.year is None:
        ctx = replace(ctx, full=True)
    c = ctx.resolved()
    return f"{spec.name}-" + ("full" if c.year is None else "-".join(f"{v:02d}" for v in (c.year, c.month, c.day) if v is not None))


def run(spark: SparkSession, spec, ctx: RunContext, inputs: dict | None = None, rules: LoadRules = PLAIN) -> dict:
    """M1: read -> build -> load."""
    if ctx.warehouse_root is None:
        raise ValueError("run needs ctx.warehouse_root")
    return load(spark, build(spark, spec, ctx, inputs), ctx.warehouse_root, spec, rules, load_id(spec, ctx))


def _days(start: _dt.date, end: _dt.date):
    while start <= end:
        yield start
        start += _dt.timedelta(days=1)


def _lookups(spark: SparkSession, spec, ctx: RunContext, folder: str) -> dict:
    """The newest-per-key lookups, which do not depend on the day: read once, written to the
    scratch folder and used for every day."""
    out = {}
    for s in spec.sources:
        if s.kind == S.LATEST:
            df = read_source(spark, s, ctx)
            df.write.parquet(f"{folder}/{s.alias}")
            out[s.alias] = spark.read.schema(df.schema).parquet(f"{folder}/{s.alias}")
    return out


def _run_days(spark: SparkSession, spec, ctx: RunContext, start: _dt.date, end: _dt.date, rules: LoadRules) -> list[dict]:
    """Day by day, a load for each."""
    folder = f"{scratch_root(spark)}/range-{uuid.uuid4().hex}"
    try:
        lookups = _lookups(spark, spec, ctx.with_date(start), folder) if start < end else {}
        return [run(spark, spec, ctx.with_date(day), lookups, rules) for day in _days(start, end)]
    finally:
        remove_path(spark, folder)


def _run_at_once(spark: SparkSession, spec, ctx: RunContext, start: _dt.date, end: _dt.date, rules: LoadRules) -> list[dict]:
    """One read of the whole range, for specs whose rows carry their lake day in the key."""
    inputs = {s.alias: read_range(spark, s, ctx.lake_root, start, end) for s in spec.sources if s.kind == S.LAKE}
    return [run(spark, spec, ctx.with_date(end), inputs, rules)]


#: Lake days that one pass of a replay reads and merges; each day is a branch of its plan.
DAYS_PER_PASS = 31
_DAY = "_lake_day"


def _replay(spark: SparkSession, spec, ctx: RunContext, start: _dt.date, end: _dt.date, rules: LoadRules) -> list[dict]:
    """A range in passes of up to a month, each one load: every day is built as its own run would
    build it, all days are staged together with their lake day, and of a key only the rows of its
    last day are merged. One stage and one merge for a pass instead of two writes for each day."""
    folder = f"{scratch_root(spark)}/range-{uuid.uuid4().hex}"
    days, out = list(_days(start, end)), []
    try:
        lookups = _lookups(spark, spec, ctx.with_date(start), folder)
        for i in range(0, len(days), DAYS_PER_PASS):
            rows = None
            for day in days[i:i + DAYS_PER_PASS]:
                one = build(spark, spec, ctx.with_date(day), lookups).withColumn(_DAY, F.lit(int(f"{day:%Y%m%d}")))
                rows = one if rows is None else rows.unionByName(one)
            out.append(load(spark, rows, ctx.warehouse_root, spec, rules, day_col=_DAY))
    finally:
        remove_path(spark, folder)
    return out


def run_range(spark: SparkSession, specs, ctx: RunContext, start: _dt.date, end: _dt.date, rules: LoadRules = PLAIN,
              day_by_day: bool = False) -> list[dict]:
    """M2: one or several tables over a date range, table by table; one report per load.

    A later day replaces keys of an earlier one. A ``row_local`` table reads the range in one
    scan; a table whose key holds its date is replayed in passes (a key then replaces its own
    date's rows only, so the last day of a key is all that remains); others, tables that read
    the warehouse, appends whose repetition matters, and all with ``day_by_day``, run day by day.
    All give the same rows.
    """
    if ctx.warehouse_root is None:
        raise ValueError("run_range needs ctx.warehouse_root")
    out = []
    for spec in [specs] if isinstance(specs, S.TableSpec) else specs:
        own = day_by_day or PARTITION_COL not in spec.pk or spec.warehouse_tables() or (spec.append and rules.append != "add")
        one = _run_days if own and not spec.row_local else _run_at_once if spec.row_local else _replay
        out += one(spark, spec, ctx, start, end, rules)
    return out


def dependence(specs) -> dict[str, dict[str, set[str]]]:
    """For each spec the specs before it in the order that it waits for: ``needs``, those that
    write a warehouse table which it reads, and ``after``, those that write its own target."""
    out, writers = {}, {}
    for spec in specs:
        needs = {w for table in spec.warehouse_tables() for w in writers.get(table, [])}
        out[spec.name] = {"needs": needs, "after": set(writers.get(spec.target, []))}
        writers.setdefault(spec.target, []).append(spec.name)
    return out


def run_all(spark: SparkSession, specs, ctx: RunContext, start: _dt.date | None = None, end: _dt.date | None = None,
            rules: LoadRules = PLAIN, at_once: int = 1) -> dict:
    """M3, M4, K6: every spec for the context's date, in full, or over a date range.

    Tables that do not depend on each other run up to ``at_once`` side by side, as jobs of one
    session (each its own thread). Tables that share a target run one after the other in
    registry order; a table waits for those that write what it reads. A failure is reported per
    table, and a table below a failed one is not run on stale rows but reported as held back.
    The report has the registry's order.
    """
    specs = list(specs)
    by_name, graph, report = {s.name: s for s in specs}, dependence(specs), {}

    def one(spec) -> dict:
        missing = sorted(n for n in graph[spec.name]["needs"] if "error" in report[n] or "held" in report[n])
        if missing:
            return {"held": missing}
        try:
            return run(spark, spec, ctx, rules=rules) if start is None else {"loads": run_range(spark, spec, ctx, start, end or start, rules)}
        except Exception as e:  # noqa: BLE001 - reported per table
            return {"error": f"{type(e).__name__}: {e}"}

    order = TopologicalSorter({n: g["needs"] | g["after"] for n, g in graph.items()})
    order.prepare()
    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        running = {}
        while order.is_active():
            for name in sorted(order.get_ready(), key=list(graph).index):
                running[pool.submit(one, by_name[name])] = name
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(done)
                report[name] = done.result()
                order.done(name)
    return {s.name: report[s.name] for s in specs}
