"""Queries of kept state, replays, heavy keys and load rules."""

from __future__ import annotations

import datetime as _dt
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind import functions as fn
from tamarind import jobs
from tamarind import operators as op
from tamarind.context import RunContext
from tamarind.plans.common import schema
from tamarind.queries.jobs import _MONTH
from tamarind.queries.operators import (DIM_ADDR, DIM_PARTY, DIM_PROJ, EV, MEMBERS, NULLABLE_R, PART_VERSIONS, _fresh_table, ensure_adapter_lake,
                                        ensure_lake)
from tamarind.queries.tables import RUN_TS, select, table
from tamarind.sinks.warehouse import LoadRules, append, load, side_path, stored_schema
from tamarind.sources.newest import refresh
from tamarind.spec import SQL, WAREHOUSE, Source, TableSpec

QUERIES: dict = {}
ORACLES: dict = {}


def reg(name, oracle):
    def deco(f):
        QUERIES[name], ORACLES[name] = f, oracle
        return f
    return deco


# ------------------------------------------------------- kept newest rows ----
def _grow(spark, sf_dir, root: str, where: str) -> None:
    """Adds the events of some days to a lake table of its own."""
    (table(spark, sf_dir, "events").where(where)
     .withColumns({"calendar_year": F.year("ts"), "month_no": F.month("ts"), "day_of_month": F.dayofmonth("ts")})
     .hint("rebalance", "calendar_year", "month_no", "day_of_month")
     .write.mode("append").partitionBy("calendar_year", "month_no", "day_of_month").parquet(f"{root}/app/events"))


def _kept_newest(spark, sf_dir, keys) -> DataFrame:
    """Three runs over a growing lake: the first days, later ones, then the rest and a late day."""
    root, state = _fresh_table(spark, sf_dir, "grow"), _fresh_table(spark, sf_dir, "state")
    src = Source("events", "events", app="app", kind="latest", keys=keys, tie=("ts", "event_id"), columns=tuple(EV.split(", ")))
    out = None
    for days in ("day(ts) <= 10 AND day(ts) <> 7", "day(ts) BETWEEN 11 AND 20", "day(ts) > 20 OR day(ts) = 7"):
        _grow(spark, sf_dir, root, days)
        out = refresh(spark, src, root, state)
    return out.select(*EV.split(", "))


def _newest(keys: str) -> str:
    return f"""SELECT {EV} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY year(ts) DESC, month(ts) DESC, day(ts) DESC, ts DESC,
  event_id DESC) AS rn FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL) WHERE rn = 1"""


@reg("q_kept_newest", _newest("user_id"))
def q_kept_newest(spark, sf_dir):
    """The newest row per user from a state that three runs brought up to date."""
    return _kept_newest(spark, sf_dir, ("user_id",))


@reg("q_kept_newest_composite", _newest("user_id, event_type"))
def q_kept_newest_composite(spark, sf_dir):
    """The same for a composite key."""
    return _kept_newest(spark, sf_dir, ("user_id", "event_type"))


# ------------------------------------------------------------- replays ----
# the date is a week, so that a key comes again on other lake days; a ninth of the rows has no key
_WEEK = "CAST(date_trunc('week', ts) AS DATE)"
REPLAYED = f"SELECT event_id, CASE WHEN user_id % 9 = 0 THEN NULL ELSE user_id END AS user_id, {_WEEK} AS date_id, CAST(ts AS DATE) AS d FROM events"


def _weekly(src, ctx):
    return src["events"].select("event_id", F.when(F.col("user_id") % 9 != 0, F.col("user_id")).alias("user_id"),
                                F.date_trunc("week", "ts").cast("date").alias("date_id"))


WEEKLY = TableSpec("weekly_users", "weekly_users", ("date_id", "user_id"), (Source("events", "events", app="app", columns=("event_id", "ts", "user_id")),),
                   _weekly, schema("event_id:long, user_id:long, date_id:date"))


@reg("q_replay_range", f"""WITH r AS ({REPLAYED})
SELECT event_id, user_id, date_id FROM r WHERE d BETWEEN DATE '2024-01-03' AND DATE '2024-01-24'
  AND (user_id IS NULL OR d = (SELECT max(d) FROM r x WHERE x.user_id = r.user_id AND x.date_id = r.date_id
                               AND x.d BETWEEN DATE '2024-01-03' AND DATE '2024-01-24'))""")
def q_replay_range(spark, sf_dir):
    """M2: three weeks replayed in one pass onto a table that holds the first of them already;
    a key's last lake day stays, with all its rows of that day, and rows without a key add up."""
    root = ensure_lake(spark, sf_dir, "events", "ts")
    ctx = RunContext(lake_root=root, warehouse_root=_fresh_table(spark, sf_dir, "replay"), run_ts=RUN_TS)
    first = replace(WEEKLY, build=lambda src, c: _weekly(src, c).where("user_id IS NOT NULL"))
    jobs.run_range(spark, first, ctx, _dt.date(2024, 1, 3), _dt.date(2024, 1, 7), day_by_day=True)
    reports = jobs.run_range(spark, WEEKLY, ctx, _dt.date(2024, 1, 3), _dt.date(2024, 1, 24))
    if len(reports) != 1:
        raise AssertionError("a range of three weeks is one load")
    return spark.read.schema(WEEKLY.schema).parquet(f"{ctx.warehouse_root}/weekly_users").select("event_id", "user_id", "date_id")


# ---------------------------------------------------------- heavy keys ----
# one part holds a third of the line items
HOT_PART = "CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END"
HOT_ITEMS = f"SELECT l_orderkey, l_linenumber, {HOT_PART} AS part FROM lineitem"


@reg("q_fanout_heavy", f"SELECT l_orderkey, l_linenumber, version, nm FROM ({HOT_ITEMS}) l JOIN ({PART_VERSIONS}) v ON l.part = v.pk")
def q_fanout_heavy(spark, sf_dir):
    """The fan-out join where one key holds a third of the rows, split over pieces."""
    items, v = select(spark, sf_dir, HOT_ITEMS), select(spark, sf_dir, PART_VERSIONS)
    return op.split_join(items, v, "part", "pk", "inner").select("l_orderkey", "l_linenumber", "version", "nm")


HOT_NULLS = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS k FROM orders"


@reg("q_null_safe_heavy", f"SELECT l.o_orderkey, r.c_custkey FROM ({HOT_NULLS}) l LEFT JOIN ({NULLABLE_R}) r ON l.k IS NOT DISTINCT FROM r.k")
def q_null_safe_heavy(spark, sf_dir):
    """Null-matching keys where a third of the rows has none."""
    l_, r_ = select(spark, sf_dir, HOT_NULLS), select(spark, sf_dir, NULLABLE_R)
    return op.split_join(l_, r_, "k", "k", "left", null_safe=True).select("o_orderkey", "c_custkey")


# ---------------------------------------------------- the target's schema ----
_OLD = "o_totalprice:long, o_orderkey:int, date_id:date"
_NEW = "o_orderkey:long, o_totalprice:dbl, o_orderstatus:str, date_id:date"
_MONTH_OF = "CAST(date_trunc('month', o_orderdate) AS DATE)"


@reg("q_target_schema", f"""SELECT CAST(round(o_totalprice * 100) AS BIGINT) AS o_totalprice, CAST(o_orderkey AS INTEGER) AS o_orderkey,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS o_orderstatus, {_MONTH_OF} AS date_id,
  'o_totalprice,o_orderkey,date_id,o_orderstatus' AS columns FROM orders""")
def q_target_schema(spark, sf_dir):
    """K2: a target older than the spec: its types and order hold, and the spec's new column is
    added, null in older rows. Without that rule the load is an error."""
    wh = _fresh_table(spark, sf_dir, "older")
    orders = table(spark, sf_dir, "orders").withColumn("date_id", F.date_trunc("month", "o_orderdate").cast("date"))
    append(spark, orders.where("o_orderkey % 2 = 1").withColumn("o_totalprice", F.col("o_totalprice") * 100), f"{wh}/t", schema(_OLD))
    spec = TableSpec("t", "t", ("date_id", "o_orderkey"), (), lambda src, c: None, schema(_NEW))
    new = orders.where("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 100)
    try:
        load(spark, new, wh, spec, LoadRules(target_schema="target"))
    except ValueError:
        load(spark, new, wh, spec, LoadRules(target_schema="target+add"))
    else:
        raise AssertionError("a new column needs a rule")
    now = stored_schema(spark, f"{wh}/t")
    return spark.read.schema(now).parquet(f"{wh}/t").select("*", F.lit(",".join(now.fieldNames())).alias("columns"))


# ---------------------------------------------------------- SQL sources ----
_FROM_SQL = (
    Source("wanted", "wanted", kind=SQL, query="SELECT CAST(n_nationkey AS STRING) AS id FROM {nation}", reads=("nation",)),
    Source("address", "address", kind=SQL, reads=("dim_address",), query="""
      SELECT addr_id, party_id FROM (SELECT *, row_number() OVER (PARTITION BY party_id ORDER BY date_id DESC, addr_id DESC) AS rn
      FROM {dim_address} WHERE addr_type_id = 5) WHERE rn = 1"""),
    Source("project", "project", kind=SQL, reads=("p=dim_project",), inputs=("wanted",), query="""
      SELECT project_id, project_code, trim(project_name) AS project_name FROM (
        SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY date_id DESC, project_code DESC) AS rn
        FROM {p} LEFT SEMI JOIN {wanted} ON project_id = id) WHERE rn = 1
      UNION ALL SELECT '-1', '(not set)', '(not set)'"""),
    Source("members", "members", kind=SQL, reads=("dim_party", "loyalty"), query="""
      SELECT DISTINCT p.* FROM {dim_party} p LEFT SEMI JOIN {loyalty} m ON lower(p.party_id) = m.member_id WHERE party_type_id IN (1, 2)"""),
)


def sql_warehouse(spark, sf_dir) -> str:
    wh = _fresh_table(spark, sf_dir, "sql")
    for name, text in {"nation": "SELECT * FROM nation", "dim_address": DIM_ADDR, "dim_project": DIM_PROJ, "dim_party": DIM_PARTY,
                       "loyalty": MEMBERS}.items():
        select(spark, sf_dir, text).write.parquet(f"{wh}/{name}")
    return wh


@reg("q_sql_sources", f"""SELECT 'address' AS source, CAST(party_id AS VARCHAR) AS a, CAST(addr_id AS VARCHAR) AS b, NULL AS c FROM (
    SELECT party_id, addr_id, ROW_NUMBER() OVER (PARTITION BY party_id ORDER BY date_id DESC, addr_id DESC) AS rn
    FROM ({DIM_ADDR}) WHERE addr_type_id = 5) WHERE rn = 1
  UNION ALL SELECT 'project', project_id, project_code, trim(project_name) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY project_id ORDER BY date_id DESC, project_code DESC) AS rn FROM ({DIM_PROJ})
    WHERE project_id IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation)) WHERE rn = 1
  UNION ALL SELECT 'project', '-1', '(not set)', '(not set)'
  UNION ALL SELECT DISTINCT 'members', party_id, CAST(party_type_id AS VARCHAR), full_nm FROM ({DIM_PARTY})
    WHERE party_type_id IN (1, 2) AND lower(party_id) IN (SELECT member_id FROM ({MEMBERS}))""")
def q_sql_sources(spark, sf_dir):
    """S12 with the templates S13, S14 and S15 as declared queries over warehouse tables, one of
    them with a semi-join input that another source gives."""
    spec = TableSpec("from_sql", "from_sql", ("date_id",), _FROM_SQL, lambda src, c: (
        src["address"].select(F.lit("address").alias("source"), F.col("party_id").cast("string").alias("a"), F.col("addr_id").cast("string").alias("b"),
                              F.lit(None).cast("string").alias("c"))
        .unionByName(src["project"].select(F.lit("project").alias("source"), F.col("project_id").alias("a"), F.col("project_code").alias("b"),
                                           F.col("project_name").alias("c")))
        .unionByName(src["members"].select(F.lit("members").alias("source"), F.col("party_id").alias("a"),
                                           F.col("party_type_id").cast("string").alias("b"), F.col("full_nm").alias("c")))), schema("a:str"))
    return jobs.build(spark, spec, RunContext(lake_root="", warehouse_root=sql_warehouse(spark, sf_dir), run_ts=RUN_TS, full=True))


# ------------------------------------------------------- registry runs ----
def _registry() -> list[TableSpec]:
    events = Source("events", "events", app="app", columns=("event_id", "ts", "user_id", "event_type", "value"))
    rows = schema("event_id:long, kind:str, date_id:date")

    def kind_of(name, keep):
        return lambda src, c: src["events"].where(keep).select("event_id", F.lit(name).alias("kind"), fn.date_id_from_ts("ts").alias("date_id"))

    def broken(src, c):
        return src["events"].select("event_id", F.raise_error(F.lit("no such account")).cast("string").alias("kind"), fn.date_id_from_ts("ts").alias("date_id"))

    def counted(name):
        return lambda src, c: src[name].groupBy("date_id", "kind").agg(F.count(F.lit(1)).alias("event_id"))

    def reads(table):
        return (Source(table, table, kind=WAREHOUSE, schema=rows),)

    return [
        TableSpec("errors", "events_by_kind", ("date_id", "event_id", "kind"), (events,), kind_of("error", "event_type = 'error'"), rows),
        TableSpec("bad", "bad", ("date_id", "event_id"), (events,), broken, rows),
        TableSpec("clicks", "events_by_kind", ("date_id", "event_id", "kind"), (events,), kind_of("click", "event_type = 'click'"), rows),
        TableSpec("counts", "counts", ("date_id", "kind"), reads("events_by_kind"), counted("events_by_kind"), rows),
        TableSpec("bad_counts", "bad_counts", ("date_id", "kind"), reads("bad"), counted("bad"), rows),
        TableSpec("of_bad_counts", "of_bad_counts", ("date_id", "kind"), reads("bad_counts"), counted("bad_counts"), rows),
        TableSpec("views", "views", ("date_id", "event_id"), (events,), kind_of("view", "event_type = 'view'"), rows, full_default=True),
    ]


_DAY2 = "CAST(ts AS DATE) = DATE '2024-01-02'"


@reg("q_run_registry", f"""WITH e AS (SELECT *, CAST(ts AS DATE) AS d FROM events WHERE {_DAY2})
SELECT 'report' AS part, 'errors' AS name, CAST(count(*) AS BIGINT) AS n, 'done' AS state FROM e WHERE event_type = 'error'
UNION ALL SELECT 'report', 'clicks', count(*), 'done' FROM e WHERE event_type = 'click'
UNION ALL SELECT 'report', 'counts', count(DISTINCT event_type), 'done' FROM e WHERE event_type IN ('error', 'click')
UNION ALL SELECT 'report', 'views', count(*), 'done' FROM e WHERE event_type = 'view'
UNION ALL SELECT 'report', 'bad', NULL, 'failed'
UNION ALL SELECT 'report', 'bad_counts', NULL, 'held by bad'
UNION ALL SELECT 'report', 'of_bad_counts', NULL, 'held by bad_counts'
UNION ALL SELECT 'rows', event_type, count(*), CAST(d AS VARCHAR) FROM e WHERE event_type IN ('error', 'click') GROUP BY ALL""")
def q_run_registry(spark, sf_dir):
    """M3, M4, M5, K6: a registry run for a day: two specs share a table and a third reads it
    after both; a failing table holds back those below it, the others go on."""
    wh = _fresh_table(spark, sf_dir, "registry")
    ctx = RunContext.for_date(ensure_lake(spark, sf_dir, "events", "ts"), _dt.date(2024, 1, 2), warehouse_root=wh, run_ts=RUN_TS)
    report = jobs.run_all(spark, _registry(), ctx, at_once=4)
    state = lambda r: "failed" if "error" in r else "held by " + ",".join(r["held"]) if "held" in r else "done"
    said = spark.createDataFrame([("report", n, r.get("rows"), state(r)) for n, r in report.items()], "part string, name string, n long, state string")
    rows = spark.read.schema(schema("event_id:long, kind:str, date_id:date")).parquet(f"{wh}/counts")
    return said.unionByName(rows.select(F.lit("rows").alias("part"), F.col("kind").alias("name"), F.col("event_id").alias("n"),
                                        F.col("date_id").cast("string").alias("state")))


# ------------------------------------------------- rows without a key ----
@reg("q_rows_without_key", f"SELECT * FROM ({_MONTH})")
def q_rows_without_key(spark, sf_dir):
    """The dim_unit run and its rerun with a side table: rows without a key are
    replaced too, so that table and side table together hold the month once."""
    from tamarind.plans.registry import BY_NAME
    ensure_adapter_lake(spark, sf_dir, "tmBRN")
    root = ensure_adapter_lake(spark, sf_dir, "tmRoomH")
    spec, wh = BY_NAME["dim_unit"], _fresh_table(spark, sf_dir, "nokey")
    ctx = RunContext(lake_root=root, warehouse_root=wh, run_ts=RUN_TS, year=1996, month=1)
    for _ in range(2):
        jobs.run(spark, spec, ctx, rules=LoadRules(no_key="side"))
    names = spec.schema.fieldNames()
    both = [spark.read.schema(spec.schema).parquet(p).select(*names) for p in (f"{wh}/{spec.target}", side_path(f"{wh}/{spec.target}"))]
    return both[0].unionByName(both[1])


# ------------------------------------------------------- appends, once ----
_APPENDED = TableSpec("appended", "appended", ("date_id", "event_id"), (Source("events", "events", app="app", columns=("event_id", "ts", "value")),),
                      lambda src, c: src["events"].select("event_id", "value", fn.date_id_from_ts("ts").alias("date_id")),
                      schema("event_id:long, value:dbl, date_id:date"), append=True)


@reg("q_append_once", """SELECT event_id, value, CAST(ts AS DATE) AS date_id FROM (SELECT DISTINCT event_id, value, ts FROM events)
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-08'""")
def q_append_once(spark, sf_dir):
    """K3: four days appended, each of them loaded again, skipped or replaced: no row twice."""
    wh = _fresh_table(spark, sf_dir, "once")
    ctx = RunContext(lake_root=ensure_lake(spark, sf_dir, "events", "ts"), warehouse_root=wh, run_ts=RUN_TS)
    for rules in (LoadRules(append="skip"), LoadRules(append="skip"), LoadRules(append="replace")):
        jobs.run_range(spark, _APPENDED, ctx, _dt.date(2024, 1, 5), _dt.date(2024, 1, 8), rules)
    return spark.read.schema(_APPENDED.schema).parquet(f"{wh}/appended").select("event_id", "value", "date_id")
