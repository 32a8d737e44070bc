"""Operator queries on the test tables (S*, P*, J*, A*, W*, U*, R*, F*, K*, M*)."""

from __future__ import annotations

import datetime as _dt
import hashlib

from pyspark.sql import functions as F
from pyspark.sql import Window

from tamarind import functions as fn
from tamarind import operators as op
from tamarind.functions.codes import (BOOKBANK_TYPE, BOOKBANK_USETYPE, FLAG_LOWER_YN_TF, FLAG_UPPER_YN_TF, FLAG_YN, FLAG_YN_TF,
                                      GENDER, IS_DELETED, LIVING_TYPE, PCL_PATTERN_TH_ONLY, PROJECT_TYPE)
from tamarind.context import RunContext
from tamarind.queries import sqlfn as q
from tamarind.queries.adapters import ADAPTERS
from tamarind.queries.tables import RUN_TS, select, table
from tamarind.session import path_exists, scratch_root
from tamarind.sinks.warehouse import append, upsert
from tamarind.sources import lake, warehouse as wh
from tamarind.spec import LATEST, Source, TableSpec

QUERIES: dict = {}
ORACLES: dict = {}

NBSP = " "


def _tag(sf_dir: str) -> str:
    return hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:10]


#: Date folders that one task of a lake write makes, about.
FOLDERS_PER_TASK = 256


def write_days(df, path: str) -> None:
    """Writes a lake table, a folder for each day. A rebalance goes by bytes, so that one task would
    write all of thousands of small folders, one after the other: those are dealt over tasks by their
    number. Whole years go to a task where there are years enough: its folders are then committed
    a year at a time."""
    days = df.select(*lake.PART_COLS).distinct().agg(F.count(F.lit(1)).alias("n"), F.count_distinct(lake.PART_COLS[0]).alias("years")).first()
    tasks = -(-days.n // FOLDERS_PER_TASK)
    if tasks <= 1:
        df = df.hint("rebalance", *lake.PART_COLS)
    elif days.years >= tasks:
        df = df.repartition(tasks, lake.PART_COLS[0])
    else:
        df = df.repartition(max(tasks, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *lake.PART_COLS)
    df.write.mode("overwrite").partitionBy(*lake.PART_COLS).parquet(path)


def ensure_lake(spark, sf_dir: str, name: str, ts_col: str, app: str = "app", monthly: bool = False) -> str:
    """Write a test table once as a date-partitioned lake table in the shared scratch
    folder; return its root.  Later calls reuse it."""
    root = f"{scratch_root(spark)}/fixtures-{_tag(sf_dir)}/lake"
    path = f"{root}/{app}/{name}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        write_days(table(spark, sf_dir, name).withColumns({
            "calendar_year": F.year(ts_col), "month_no": F.month(ts_col), "day_of_month": F.lit(1) if monthly else F.dayofmonth(ts_col)}), path)
    return root


def adapter(spark, sf_dir, name):
    return select(spark, sf_dir, ADAPTERS[name])


def reg(name, oracle=None):
    def deco(f):
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f
    return deco


EV = "event_id, ts, user_id, event_type, value, props"

# ------------------------------------------------------------ lake reads ----
@reg("q_lake_day", f"SELECT DISTINCT {EV}, CAST(2024 AS INTEGER) AS calendar_year, CAST(1 AS INTEGER) AS month_no, "
     "CAST(15 AS INTEGER) AS day_of_month FROM events WHERE year(ts) = 2024 AND month(ts) = 1 AND day(ts) = 15")
def q_lake_day(spark, sf_dir):
    """One day's partition; the date parts come back as columns."""
    root = ensure_lake(spark, sf_dir, "events", "ts")
    src = Source("events", "events", app="app")
    return lake.read_source(spark, src, RunContext.for_date(root, _dt.date(2024, 1, 15), run_ts=RUN_TS))


@reg("q_lake_month", "SELECT DISTINCT user_id, event_type, CAST(2024 AS INTEGER) AS calendar_year, "
     "CAST(1 AS INTEGER) AS month_no FROM events WHERE year(ts) = 2024 AND month(ts) = 1")
def q_lake_month(spark, sf_dir):
    """A month read with a projection; duplicates over the read columns drop."""
    root = ensure_lake(spark, sf_dir, "events", "ts")
    return lake.read_lake(spark, f"{root}/app/events", columns=["user_id", "event_type"], year=2024, month=1)


@reg("q_lake_full", "SELECT DISTINCT user_id, event_type, CAST(year(ts) AS INTEGER) AS calendar_year, "
     "CAST(month(ts) AS INTEGER) AS month_no, CAST(day(ts) AS INTEGER) AS day_of_month FROM events")
def q_lake_full(spark, sf_dir):
    """Every partition; the date parts asked for take part in the distinct."""
    root = ensure_lake(spark, sf_dir, "events", "ts")
    return lake.read_lake(spark, f"{root}/app/events", full=True,
                          columns=["user_id", "event_type", "calendar_year", "month_no", "day_of_month"])


@reg("q_latest_per_key", f"""SELECT {EV} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
  ORDER BY year(ts) DESC, month(ts) DESC, day(ts) DESC, ts DESC, event_id DESC) AS rn FROM events
  WHERE user_id IS NOT NULL) WHERE rn = 1""")
def q_latest_per_key(spark, sf_dir):
    """Full lake read, newest partition row per user (ties: ts, event_id)."""
    root = ensure_lake(spark, sf_dir, "events", "ts")
    src = Source("events", "events", app="app", kind=LATEST, keys=("user_id",), tie=("ts", "event_id"),
                 columns=tuple(EV.split(", ")))
    df = lake.read_source(spark, src, RunContext(lake_root=root, run_ts=RUN_TS))
    return df.select(*EV.split(", "))


@reg("q_latest_composite", f"""SELECT {EV} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type
  ORDER BY year(ts) DESC, month(ts) DESC, day(ts) DESC, ts DESC, event_id DESC) AS rn FROM events
  WHERE user_id IS NOT NULL AND event_type IS NOT NULL) WHERE rn = 1""")
def q_latest_composite(spark, sf_dir):
    """Newest row per (user, event type)."""
    ev = table(spark, sf_dir, "events").withColumns(
        {"calendar_year": F.year("ts"), "month_no": F.month("ts"), "day_of_month": F.dayofmonth("ts")})
    return lake.latest_per_key(ev, ("user_id", "event_type"), tie=("ts", "event_id")).select(*EV.split(", "))


@reg("q_history", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE year(o_orderdate) BETWEEN 1998 AND 2000")
def q_history(spark, sf_dir):
    """Three years back from 2000, one range scan, distinct."""
    root = ensure_lake(spark, sf_dir, "orders", "o_orderdate", monthly=True)
    return lake.read_history(spark, f"{root}/app/orders", start_year=2000, years=3,
                             columns=["o_custkey", "o_orderstatus"])


@reg("q_missing_source", "SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS label FROM customer")
def q_missing_source(spark, sf_dir):
    """A table that does not exist reads as an empty typed frame (here a lookup that
    every customer misses)."""
    root = ensure_lake(spark, sf_dir, "events", "ts")
    missing = lake.read_lake(spark, f"{root}/app/no_such_table", columns=["k", "label"], full=True,
                             schema="k bigint, label string")
    cust = table(spark, sf_dir, "customer")
    return op.lookup_join(cust, missing, "c_custkey", "k", "left").select("c_custkey", "c_name", "label")


# ------------------------------------------------------ warehouse templates ----
DIM_ADDR = ("SELECT o_custkey AS party_id, o_orderkey AS addr_id, CAST(o_orderdate AS DATE) AS date_id, "
            "CAST(o_orderkey % 6 AS INT) AS addr_type_id FROM orders")


@reg("q_latest_address", f"""SELECT addr_id, party_id FROM (SELECT party_id, addr_id, ROW_NUMBER() OVER
  (PARTITION BY party_id ORDER BY date_id DESC, addr_id DESC) AS rn FROM ({DIM_ADDR}) WHERE addr_type_id = 5)
  WHERE rn = 1""")
def q_latest_address(spark, sf_dir):
    """Newest home address (type 5) per party."""
    return wh.latest_address(select(spark, sf_dir, DIM_ADDR), 5)


DIM_PROJ = ("SELECT CAST(s_suppkey % 30 AS STRING) AS project_id, 'PJ' || CAST(s_suppkey AS STRING) AS project_code, "
            f"' Project ' || CAST(s_nationkey AS STRING) || '{NBSP}' AS project_name, "
            "CAST(2000 + floor(s_suppkey / 30) AS INT) AS date_id FROM supplier")


@reg("q_project_default_row", f"""SELECT project_id, project_code, project_name FROM (
  SELECT project_id, project_code, {q.strip('project_name')} AS project_name,
    ROW_NUMBER() OVER (PARTITION BY project_id ORDER BY date_id DESC) AS rn
  FROM ({DIM_PROJ}) WHERE project_id IN (SELECT CAST(n_nationkey AS STRING) FROM nation)) WHERE rn = 1
  UNION ALL SELECT '-1', '(not set)', '(not set)'""")
def q_project_default_row(spark, sf_dir):
    """Newest project per wanted id (semi join) plus the '(not set)' row."""
    ids = select(spark, sf_dir, "SELECT CAST(n_nationkey AS STRING) AS id FROM nation")
    return wh.project_with_default(select(spark, sf_dir, DIM_PROJ), ids)


DIM_PARTY = ("SELECT (CASE c_custkey % 3 WHEN 0 THEN 'C' ELSE 'c' END) || CAST(c_custkey AS STRING) AS party_id, "
             "CAST(c_nationkey % 4 AS INT) AS party_type_id, c_name AS full_nm FROM customer")
MEMBERS = "SELECT 'c' || CAST(o_custkey AS STRING) AS member_id FROM orders"


@reg("q_member_parties", f"""SELECT DISTINCT * FROM ({DIM_PARTY}) p WHERE party_type_id IN (1, 2)
  AND lower(party_id) IN (SELECT member_id FROM ({MEMBERS}))""")
def q_member_parties(spark, sf_dir):
    """Parties of type 1/2 whose lower-cased id is a member."""
    return wh.member_parties(select(spark, sf_dir, DIM_PARTY), select(spark, sf_dir, MEMBERS))


# ------------------------------------------------------- projections ----
@reg("q_rename_suffix_schema", """SELECT c_custkey AS customer_id, c_name AS customer_nm, c_nationkey AS nation_id,
  c_acctbal AS balance, c_mktsegment AS segment_x, CAST(NULL AS VARCHAR) AS note_x, 'n/a' AS phone_x,
  TIMESTAMP '2025-01-01 03:00:00' AS dwh_crtd_dttm, TIMESTAMP '2025-01-01 03:00:00' AS dwh_updt_dttm,
  CAST(NULL AS INTEGER) AS dwh_note FROM customer""")
def q_rename_suffix_schema(spark, sf_dir):
    """Upper-case names lowered, renamed, suffixed, optional columns
    defaulted, audit columns, aligned to an ordered schema."""
    from tamarind.plans.common import schema
    from tamarind.sinks.warehouse import align_to_schema
    c = table(spark, sf_dir, "customer")
    c = c.toDF(*[x.upper() for x in c.columns])
    c = op.lower_columns(c)
    c = op.rename(c, {"c_custkey": "customer_id", "c_name": "customer_nm", "c_nationkey": "nation_id",
                      "c_acctbal": "balance", "c_mktsegment": "segment", "no_such": "ignored"})
    sx = op.suffix_columns(c.select("customer_id", "segment"), "_x")
    c = c.join(sx, c.customer_id == sx.customer_id_x, "inner")
    c = c.select("*", op.col_or(c, "note", None).alias("note_x"), op.col_or(c, "phone", "n/a").alias("phone_x"))
    c = op.with_audit(c, RUN_TS)
    sch = schema("customer_id:long, customer_nm:str, nation_id:int, balance:dbl, segment_x:str, note_x:str, "
                 "phone_x:str, dwh_crtd_dttm:ts, dwh_updt_dttm:ts, dwh_note:int")
    return align_to_schema(c, sch)


@reg("q_filters", f"""SELECT o_orderkey, o_orderstatus, o_orderpriority, NULLIF(st, '') AS status_or_null FROM (
  SELECT *, CASE o_orderkey % 4 WHEN 0 THEN '' ELSE o_orderstatus END AS st FROM orders)
  WHERE o_orderstatus = 'F' AND {q.strip("CASE o_orderkey % 3 WHEN 0 THEN ' ' || o_orderpriority ELSE o_orderpriority END")}
        IN ('1-URGENT', '2-HIGH')
  AND o_orderpriority IS NOT NULL AND o_orderpriority <> ''""")
def q_filters(spark, sf_dir):
    """P6 (equality), P7 (set after strip), P8 (non-null, non-blank), P10 (blank -> null)."""
    o = table(spark, sf_dir, "orders")
    o = o.withColumn("st", F.when(F.col("o_orderkey") % 4 == 0, F.lit("")).otherwise(F.col("o_orderstatus")))
    o = o.withColumn("prio", F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(" "), "o_orderpriority"))
                     .otherwise(F.col("o_orderpriority")))
    o = op.blank_strings_to_null(o.select("o_orderkey", "o_orderstatus", "o_orderpriority", "prio",
                                          F.col("st").alias("status_or_null")))
    return (o.where(F.col("o_orderstatus") == "F")
            .where(fn.strip("prio").isin("1-URGENT", "2-HIGH"))
            .where(F.col("o_orderpriority").isNotNull() & (F.col("o_orderpriority") != ""))
            .drop("prio"))


@reg("q_filter_labels", "SELECT doc_id, quality, toxic FROM labels WHERE quality = 1 AND toxic = 0")
def q_filter_labels(spark, sf_dir):
    """P6 on the labels table: good and non-toxic documents."""
    return table(spark, sf_dir, "labels").where((F.col("quality") == 1) & (F.col("toxic") == 0))


# ------------------------------------------------------------- joins ----
@reg("q_lookup_left", "SELECT c_custkey, c_name, n_name FROM customer LEFT JOIN nation ON c_nationkey + 3 = n_nationkey")
def q_lookup_left(spark, sf_dir):
    """Left lookup on a small dimension (broadcast only within the size check)."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    c = c.withColumn("nk", F.col("c_nationkey") + 3)
    return op.lookup_join(c, n, "nk", "n_nationkey", "left", small=True).select("c_custkey", "c_name", "n_name")


@reg("q_inner", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def q_inner(spark, sf_dir):
    """Inner join of a fact with a large dimension (shuffle join under AQE)."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return op.lookup_join(o, c, "o_custkey", "c_custkey", "inner").select("o_orderkey", "c_name")


@reg("q_composite_join", "SELECT o_orderkey, c_name FROM orders JOIN customer "
     "ON o_custkey = c_custkey AND CAST(o_orderkey % 25 AS INTEGER) = c_nationkey")
def q_composite_join(spark, sf_dir):
    """Join on two equalities (one computed)."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    o = o.withColumn("nk", (F.col("o_orderkey") % 25).cast("int"))
    return op.lookup_join(o, c, ["o_custkey", "nk"], ["c_custkey", "c_nationkey"], "inner").select("o_orderkey", "c_name")


PHONES_L = (f"SELECT c_custkey, ' ' || CAST(800000000 + c_custkey AS STRING) || '{NBSP}' AS phone FROM customer")
PHONES_R = "SELECT o_orderkey, '0' || CAST(800000000 + o_custkey AS STRING) AS phone FROM orders"


@reg("q_norm_key_join", f"""SELECT o_orderkey, c_custkey FROM ({PHONES_L}) l JOIN ({PHONES_R}) r
  ON (CASE WHEN length({q.strip('l.phone')}) = 9 THEN '0' || {q.strip('l.phone')} ELSE {q.strip('l.phone')} END) = r.phone""")
def q_norm_key_join(spark, sf_dir):
    """Phones stripped and padded to 10 digits, then an equi-join."""
    l_, r_ = select(spark, sf_dir, PHONES_L), select(spark, sf_dir, PHONES_R)
    l_ = l_.withColumn("pk", fn.phone_pad9(fn.strip("phone")))
    return op.lookup_join(l_, r_, "pk", "phone", "inner").select("o_orderkey", "c_custkey")


@reg("q_phone_prefix_join", """SELECT o_orderkey, c_custkey FROM customer JOIN orders
  ON '0' || CAST(c_custkey AS STRING) = '0' || CAST(o_custkey AS STRING)""")
def q_phone_prefix_join(spark, sf_dir):
    """Join on '0' + key text (null stays null and never matches)."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    c = c.withColumn("pk", fn.phone_prefix0("c_custkey"))
    o = o.withColumn("pk", fn.phone_prefix0("o_custkey"))
    return op.lookup_join(o, c, "pk", "pk", "inner").select("o_orderkey", "c_custkey")


@reg("q_same_dim_twice", """SELECT s_suppkey, n1.n_name AS home_nation, n2.n_name AS next_nation FROM supplier
  LEFT JOIN nation n1 ON s_nationkey = n1.n_nationkey LEFT JOIN nation n2 ON (s_nationkey + 1) % 25 = n2.n_nationkey""")
def q_same_dim_twice(spark, sf_dir):
    """One dimension joined in two roles (suffixes keep the roles apart)."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    n1, n2 = op.suffix_columns(n, "_home"), op.suffix_columns(n, "_next")
    s = s.withColumn("next_key", ((F.col("s_nationkey") + 1) % 25).cast("int"))
    out = op.lookup_join(s, n1, "s_nationkey", "n_nationkey_home", "left", small=True)
    out = op.lookup_join(out, n2, "next_key", "n_nationkey_next", "left", small=True)
    return out.select("s_suppkey", F.col("n_name_home").alias("home_nation"), F.col("n_name_next").alias("next_nation"))


@reg("q_join_chain", """SELECT DISTINCT n_name, o_orderstatus, l_returnflag FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def q_join_chain(spark, sf_dir):
    """A chain of inner joins with one distinct at the end."""
    l_, o, c, n = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "nation"))
    x = op.lookup_join(l_, o, "l_orderkey", "o_orderkey", "inner")
    x = op.lookup_join(x, c, "o_custkey", "c_custkey", "inner")
    x = op.lookup_join(x, n, "c_nationkey", "n_nationkey", "inner", small=True)
    return x.select("n_name", "o_orderstatus", "l_returnflag").distinct()


PART_VERSIONS = ("SELECT p_partkey AS pk, 1 AS version, p_name AS nm FROM part "
                 "UNION ALL SELECT p_partkey, 2, p_brand FROM part")


@reg("q_fanout", f"""SELECT l_orderkey, l_linenumber, version, nm FROM lineitem JOIN ({PART_VERSIONS}) v ON l_partkey = v.pk""")
def q_fanout(spark, sf_dir):
    """Many-to-many on a non-unique key (each part has two versions); output grows
    linearly (two rows per line item)."""
    l_, v = table(spark, sf_dir, "lineitem"), select(spark, sf_dir, PART_VERSIONS)
    return op.lookup_join(l_, v, "l_partkey", "pk", "inner").select("l_orderkey", "l_linenumber", "version", "nm")


@reg("q_two_hop", """SELECT l_orderkey, l_linenumber, c_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey""")
def q_two_hop(spark, sf_dir):
    """A path of two inner joins."""
    l_, o, c = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    x = op.lookup_join(l_, o.select("o_orderkey", "o_custkey"), "l_orderkey", "o_orderkey", "inner")
    return op.lookup_join(x, c, "o_custkey", "c_custkey", "inner").select("l_orderkey", "l_linenumber", "c_name")


@reg("q_semi", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def q_semi(spark, sf_dir):
    """Semi join — customers with a finished order."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return op.lookup_join(c, o, "c_custkey", "o_custkey", "left_semi").select("c_custkey", "c_name")


@reg("q_anti", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def q_anti(spark, sf_dir):
    """Anti join — customers without a finished order."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return op.lookup_join(c, o, "c_custkey", "o_custkey", "left_anti").select("c_custkey", "c_name")


# a fifth of the orders has no key, but one customer only, so the output grows with the orders
NULLABLE_L = "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS k FROM orders"
NULLABLE_R = "SELECT c_custkey, CASE WHEN c_custkey = 7 THEN NULL ELSE c_custkey END AS k FROM customer"


@reg("q_null_safe", f"""SELECT l.o_orderkey, r.c_custkey FROM ({NULLABLE_L}) l JOIN ({NULLABLE_R}) r
  ON l.k IS NOT DISTINCT FROM r.k""")
def q_null_safe(spark, sf_dir):
    """Null-matching keys (null = null), still an equi-join."""
    l_, r_ = select(spark, sf_dir, NULLABLE_L), select(spark, sf_dir, NULLABLE_R)
    return op.lookup_join(l_, r_, "k", "k", "inner", null_safe=True).select("o_orderkey", "c_custkey")


@reg("q_null_plain", f"""SELECT l.o_orderkey, r.c_custkey FROM ({NULLABLE_L}) l LEFT JOIN ({NULLABLE_R}) r ON l.k = r.k""")
def q_null_plain(spark, sf_dir):
    """J11 default: null keys never match (left join keeps them unmatched)."""
    l_, r_ = select(spark, sf_dir, NULLABLE_L), select(spark, sf_dir, NULLABLE_R)
    return op.lookup_join(l_, r_, "k", "k", "left").select("o_orderkey", "c_custkey")


# --------------------------------------------------- distinct, counts ----
@reg("q_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def q_distinct(spark, sf_dir):
    """A1/A2: full-row distinct (partial + final hash aggregate)."""
    return table(spark, sf_dir, "events").select("user_id", "event_type").distinct()


@reg("q_distinct_subset", "SELECT DISTINCT l_suppkey FROM lineitem")
def q_distinct_subset(spark, sf_dir):
    """A3: distinct by a subset where only that column is used later."""
    return table(spark, sf_dir, "lineitem").select("l_suppkey").distinct()


@reg("q_load_summary", """SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(5 AS INTEGER) AS column_count, FALSE AS skipped,
  CAST(count_if(o_orderkey % 10 = 0) AS BIGINT) AS null_dates FROM orders""")
def q_load_summary(spark, sf_dir):
    """A5/K5: what a load reports about itself: rows, columns, rows without a date."""
    from tamarind.plans.common import schema
    rows = select(spark, sf_dir, TARGET).withColumn("date_id", F.when(F.col("o_orderkey") % 10 != 0, F.col("date_id")))
    out = append(spark, rows, _fresh_table(spark, sf_dir, "summary"), schema(_UP_SCHEMA))
    return spark.createDataFrame([(out["rows"], out["columns"], out["skipped"], out["null_dates"])],
                                 "row_count long, column_count int, skipped boolean, null_dates long")


@reg("q_last_login", """SELECT u.user_id, m.last_login FROM (SELECT DISTINCT user_id FROM events) u
  LEFT JOIN (SELECT user_id, max(ts) AS last_login FROM events WHERE event_type = 'error' GROUP BY user_id) m
  ON u.user_id = m.user_id""")
def q_last_login(spark, sf_dir):
    """Newest login of 'disabled' rows (type error) per user, joined back."""
    ev = table(spark, sf_dir, "events")
    last = op.last_value_per_key(ev.where(F.col("event_type") == "error"), "user_id", "ts", "last_login")
    users = ev.select("user_id").distinct()
    return op.lookup_join(users, last.withColumnRenamed("user_id", "uid"), "user_id", "uid", "left").select(
        "user_id", "last_login")


# ------------------------------------------------------------ set ops ----
@reg("q_union_all", "SELECT c_custkey AS k, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier")
def q_union_all(spark, sf_dir):
    """Union all by name."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.lit("customer").alias("kind"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.lit("supplier").alias("kind"))
    return c.unionByName(s)


@reg("q_union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def q_union_distinct(spark, sf_dir):
    """Union then distinct."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    return c.unionByName(s).distinct()


# ------------------------------------------------------------ reshape ----
@reg("q_unpivot", """SELECT l_orderkey, l_linenumber, 'l_partkey' AS key_col, l_partkey AS key_val FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_suppkey', l_suppkey FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_orderkey', l_orderkey FROM lineitem""")
def q_unpivot(spark, sf_dir):
    """Key columns to rows, keeping the source column name (one scan)."""
    li = table(spark, sf_dir, "lineitem")
    wide = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_orderkey").alias("l_orderkey_v"))
    rows = op.unpivot(wide, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_orderkey_v"], "key_col", "key_val")
    name = F.when(F.col("key_col") == "l_orderkey_v", F.lit("l_orderkey")).otherwise(F.col("key_col"))
    return rows.select("l_orderkey", "l_linenumber", name.alias("key_col"), "key_val")


@reg("q_unpivot_groups", """SELECT o_orderkey, 5 AS addr_type_id, o_orderstatus AS code, o_orderpriority AS label FROM orders
  UNION ALL SELECT o_orderkey, 3, CAST(o_custkey AS STRING), 'cust' FROM orders
  UNION ALL SELECT o_orderkey, 4, CAST(year(o_orderdate) AS STRING), NULL FROM orders""")
def q_unpivot_groups(spark, sf_dir):
    """Three column groups -> three rows per input row, tagged by type."""
    o = table(spark, sf_dir, "orders")
    return op.unpivot_groups(o, ["o_orderkey"], {
        5: {"code": "o_orderstatus", "label": "o_orderpriority"},
        3: {"code": F.col("o_custkey").cast("string"), "label": F.lit("cust")},
        4: {"code": F.year("o_orderdate").cast("string"), "label": F.lit(None).cast("string")},
    }, tag_name="addr_type_id").select("o_orderkey", F.col("addr_type_id").cast("int").alias("addr_type_id"),
                                       "code", "label")


# ------------------------------------------------------ scalar functions ----
D = f"({ADAPTERS['dirty_values']})"


@reg("q_clean", f"""SELECT k, {q.clean('txt')} AS cleaned, {q.strip('txt')} AS stripped, NULLIF(txt, '') AS blank_null,
  CAST(num AS STRING) AS as_text, CASE WHEN num IS NULL OR num IN ('None', 'nan', '<NA>') THEN '' ELSE num END AS token, coalesce(num, txt) AS first_non_null
  FROM {D}""")
def q_clean(spark, sf_dir):
    """Coalesce, blank -> null, clean_str, strip, to_text, clean_token."""
    d = adapter(spark, sf_dir, "dirty_values")
    return d.select("k", fn.clean_str("txt").alias("cleaned"), fn.strip("txt").alias("stripped"),
                    fn.blank_to_null("txt").alias("blank_null"), fn.to_text("num").alias("as_text"),
                    fn.clean_token("num").alias("token"), fn.coalesce_first("num", "txt").alias("first_non_null"))


@reg("q_cast", f"""SELECT k, {q.to_long('num')} AS as_long, coalesce({q.to_long('num')}, 0) AS as_long0,
  {q.to_double('num')} AS as_double, {q.to_double('num', 0.0)} AS as_double0 FROM {D}""")
def q_cast(spark, sf_dir):
    """Coercing numbers (fractions and junk -> null)."""
    d = adapter(spark, sf_dir, "dirty_values")
    return d.select("k", fn.to_long("num").alias("as_long"), fn.to_long_or_zero("num").alias("as_long0"),
                    fn.to_double("num").alias("as_double"), fn.to_double("num", 0.0).alias("as_double0"))


_BOOL_T = "('true', '1', 't', 'y', 'yes', 'active')"
_BOOL_F = "('false', '0', 'f', 'n', 'no', 'inactive')"


@reg("q_bool", f"""SELECT k, CASE WHEN lower({q.strip('boolish')}) IN {_BOOL_T} THEN TRUE
  WHEN lower({q.strip('boolish')}) IN {_BOOL_F} THEN FALSE END AS b FROM {D}""")
def q_bool(spark, sf_dir):
    """loose text -> boolean."""
    d = adapter(spark, sf_dir, "dirty_values")
    return d.select("k", fn.norm_bool("boolish").alias("b"))


@reg("q_flags", f"""SELECT k,
  {q.case_map('flag', FLAG_YN_TF)} AS f_a,
  {q.case_map('flag', FLAG_YN)} AS f_b,
  {q.case_map('upper(flag)', FLAG_UPPER_YN_TF)} AS f_c,
  {q.case_map('lower(flag)', FLAG_LOWER_YN_TF)} AS f_d,
  CASE WHEN flag IN ('N', 'false', '0') THEN '0' ELSE '1' END AS f_e,
  CASE WHEN lower(flag) IN ('true', '1') THEN '1' WHEN lower(flag) IN ('false', '0') THEN '0' END AS f_f,
  CASE WHEN flag IS NULL THEN '0' ELSE {q.case_map('lower(flag)', IS_DELETED)} END AS f_g,
  CASE WHEN coalesce(CAST(k % 3 AS STRING), '0') = '0' THEN 'GU' ELSE 'RU' END AS user_type,
  coalesce(CASE WHEN k % 4 = 0 THEN NULL ELSE 'REF' || CAST(k AS STRING) END, '-') AS referral
  FROM {D}""")
def q_flags(spark, sf_dir):
    """F10a-g, F16, F17: every flag-map variant."""
    d = adapter(spark, sf_dir, "dirty_values")
    return d.select(
        "k", fn.flag_map("flag", FLAG_YN_TF).alias("f_a"), fn.flag_map("flag", FLAG_YN).alias("f_b"),
        fn.flag_map("flag", FLAG_UPPER_YN_TF, case="upper").alias("f_c"),
        fn.flag_map("flag", FLAG_LOWER_YN_TF, case="lower").alias("f_d"),
        fn.disabled_flag("flag").alias("f_e"), fn.tri_flag("flag").alias("f_f"),
        fn.is_deleted_flag("flag").alias("f_g"),
        fn.user_type((F.col("k") % 3).cast("string")).alias("user_type"),
        F.coalesce(F.when(F.col("k") % 4 != 0, F.concat(F.lit("REF"), F.col("k").cast("string"))), F.lit("-")).alias("referral"))


@reg("q_maps", f"""SELECT k,
  {q.case_map('upper(sex)', GENDER, 'ไม่ระบุเพศ')} AS gender,
  {q.case_map('code', PROJECT_TYPE)} AS project_type,
  {q.case_map('code', LIVING_TYPE)} AS living_type,
  {q.case_map('bookcode', BOOKBANK_TYPE)} AS book_type,
  {q.case_map('bookcode', BOOKBANK_USETYPE)} AS book_usetype
  FROM {D}""")
def q_maps(spark, sf_dir):
    """Code -> label maps."""
    d = adapter(spark, sf_dir, "dirty_values")
    return d.select("k", fn.gender_label("sex").alias("gender"),
                    fn.map_values("code", PROJECT_TYPE).alias("project_type"),
                    fn.map_values("code", LIVING_TYPE).alias("living_type"),
                    fn.map_values("bookcode", BOOKBANK_TYPE).alias("book_type"),
                    fn.map_values("bookcode", BOOKBANK_USETYPE).alias("book_usetype"))


@reg("q_corporate", f"""SELECT k,
  CASE WHEN coalesce(regexp_matches(company, 'มหาชน|PCL'), FALSE) THEN 'PCL' ELSE 'LOCAL' END AS corp,
  CASE WHEN coalesce(regexp_matches(company, 'มหาชน'), FALSE) THEN 'PCL' ELSE 'LOCAL' END AS corp_th
  FROM {D}""")
def q_corporate(spark, sf_dir):
    """public-company marker in a name."""
    d = adapter(spark, sf_dir, "dirty_values")
    return d.select("k", fn.corporate_type("company").alias("corp"),
                    fn.corporate_type("company", PCL_PATTERN_TH_ONLY).alias("corp_th"))


@reg("q_date_id", f"""SELECT k, {q.date_text('dtext')} AS d_text, {q.date_text('dtext', 2)} AS d_text2,
  {q.date_ts('dtext')} AS d_ts, make_date(calendar_year, month_no, day_of_month) AS d_parts,
  DATE '2025-01-01' AS d_run FROM {D}""")
def q_date_id(spark, sf_dir):
    """F20a-f: date_id from text slices (two widths), a timestamp parse, partition parts, the run date."""
    d = adapter(spark, sf_dir, "dirty_values")
    return d.select("k", fn.date_id_from_text("dtext").alias("d_text"),
                    fn.date_id_from_text("dtext", day_width=2).alias("d_text2"),
                    fn.date_id_from_ts("dtext").alias("d_ts"),
                    fn.date_id_from_parts("calendar_year", "month_no", "day_of_month").alias("d_parts"),
                    F.lit(RUN_TS.date()).alias("d_run"))


@reg("q_to_ts", f"SELECT k, {q.to_ts('dtext')} AS t, {q.to_ts('betext')} AS t_be_raw FROM {D}")
def q_to_ts(spark, sf_dir):
    """coercing timestamp parse (out of the pandas range -> null)."""
    d = adapter(spark, sf_dir, "dirty_values")
    return d.select("k", fn.to_ts("dtext").alias("t"), fn.to_ts("betext").alias("t_be_raw"))


_EP = "TRY_CAST(epoch AS DOUBLE)"


@reg("q_epoch", f"""SELECT k, CASE WHEN {_EP} IS NOT NULL THEN TIMESTAMP '1970-01-01 00:00:00'
  + to_microseconds(CAST(round({_EP} * 1000000) AS BIGINT)) END AS t FROM {D}""")
def q_epoch(spark, sf_dir):
    """epoch seconds -> UTC wall clock."""
    d = adapter(spark, sf_dir, "dirty_values")
    return d.select("k", fn.epoch_to_ts("epoch").alias("t"))


@reg("q_be_year", f"""SELECT k,
  {q.be_to_ce('betext', 2500, 2600, 10)} AS be_a, {q.be_to_ce('betext', 2500)} AS be_b,
  {q.be_to_ce('betext', 2262)} AS be_c, {q.be_to_ce('betext', 2400)} AS be_d,
  {q.to_ts(q.be_to_ce('betext', 2400))} AS ts_d, {q.to_ts(q.be_to_ce('betext', 2500))} AS ts_f FROM {D}""")
def q_be_year(spark, sf_dir):
    """F23a-f: Buddhist-era years at each threshold."""
    d = adapter(spark, sf_dir, "dirty_values")
    return d.select("k", fn.be_to_ce("betext", 2500, 2600, 10).alias("be_a"), fn.be_to_ce("betext", 2500).alias("be_b"),
                    fn.be_to_ce("betext", 2262).alias("be_c"), fn.be_to_ce("betext", 2400).alias("be_d"),
                    fn.to_ts(fn.be_to_ce("betext", 2400)).alias("ts_d"),
                    fn.to_ts(fn.be_to_ce("betext", 2500)).alias("ts_f"))


@reg("q_age", f"SELECT k, CAST(2025 - year({q.to_ts('dtext')}) AS INTEGER) AS age FROM {D}")
def q_age(spark, sf_dir):
    """age in calendar years at the run clock."""
    d = adapter(spark, sf_dir, "dirty_values")
    return d.select("k", fn.age_years(RUN_TS, fn.to_ts("dtext")).alias("age"))


@reg("q_text", f"""SELECT k, first_nm || ' ' || last_nm AS full_nm,
  {q.strip('txt')} || ' ' || first_nm || ' ' || last_nm AS addr_text,
  CASE WHEN txt IS NULL THEN NULL ELSE split_part(txt, ' ', 1) END AS first_tok,
  CAST(DATE '2025-01-01' AS STRING) || CAST(k AS STRING) || '5' AS addr_key,
  CASE WHEN length(phone) = 9 THEN '0' || phone ELSE phone END AS phone10,
  '0' || phone AS phone0,
  CASE WHEN length(CAST(k % 1000 AS STRING)) >= 2 THEN CAST(k % 1000 AS STRING) ELSE lpad(CAST(k % 1000 AS STRING), 2, '0') END AS z2,
  upper(first_nm) AS up, lower(last_nm) AS low FROM {D}""")
def q_text(spark, sf_dir):
    """Names, address text, first token, keys, phones, zero padding, case."""
    d = adapter(spark, sf_dir, "dirty_values")
    return d.select("k", fn.full_name("first_nm", "last_nm").alias("full_nm"),
                    fn.join_words(fn.strip("txt"), "first_nm", "last_nm").alias("addr_text"),
                    fn.first_token("txt").alias("first_tok"),
                    F.concat(F.lit(RUN_TS.date()).cast("string"), F.col("k").cast("string"), F.lit("5")).alias("addr_key"),
                    fn.phone_pad9("phone").alias("phone10"), fn.phone_prefix0("phone").alias("phone0"),
                    fn.zfill((F.col("k") % 1000).cast("string"), 2).alias("z2"),
                    F.upper("first_nm").alias("up"), F.lower("last_nm").alias("low"))


# --------------------------------------------------------------- sinks ----
MONTH_START = "make_date(CAST(year(o_orderdate) AS INT), CAST(month(o_orderdate) AS INT), 1)"
TARGET = (f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {MONTH_START} AS date_id FROM orders")
# the changed slice: every order of 1997 gets a new status and price (the update set is the feature)
STAGED = ("SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1.0 AS o_totalprice, "
          f"{MONTH_START} AS date_id FROM orders WHERE year(o_orderdate) = 1997 "
          f"UNION ALL SELECT o_orderkey + 1000000000, o_custkey, 'N', 0.0, {MONTH_START} FROM orders "
          "WHERE year(o_orderdate) = 1997 AND o_orderkey % 2 = 0")
_UP_SCHEMA = "o_orderkey:long, o_custkey:long, o_orderstatus:str, o_totalprice:dbl, date_id:date"


def _fresh_table(spark, sf_dir, kind):
    import uuid
    return f"{scratch_root(spark)}/fixtures-{_tag(sf_dir)}/warehouse-{kind}-{uuid.uuid4().hex}"


@reg("q_upsert", f"""SELECT * FROM ({TARGET}) t WHERE NOT EXISTS (SELECT 1 FROM ({STAGED}) s
  WHERE s.date_id = t.date_id AND s.o_orderkey = t.o_orderkey) UNION ALL SELECT * FROM ({STAGED})""")
def q_upsert(spark, sf_dir):
    """K1/K2/U4: replace-by-key into a date-partitioned table, via scratch staging and a
    dynamic partition overwrite; the whole table is read back."""
    from tamarind.plans.common import schema
    sch = schema(_UP_SCHEMA)
    path = _fresh_table(spark, sf_dir, "upsert")
    append(spark, select(spark, sf_dir, TARGET), path, sch)
    upsert(spark, select(spark, sf_dir, STAGED), path, ("date_id", "o_orderkey"), sch)
    return spark.read.schema(sch).parquet(path).select(*[f.name for f in sch.fields])


@reg("q_append", f"SELECT * FROM ({TARGET}) UNION ALL SELECT * FROM ({STAGED})")
def q_append(spark, sf_dir):
    """K3: append mode — no delete, every row added."""
    from tamarind.plans.common import schema
    sch = schema(_UP_SCHEMA)
    path = _fresh_table(spark, sf_dir, "append")
    append(spark, select(spark, sf_dir, TARGET), path, sch)
    append(spark, select(spark, sf_dir, STAGED), path, sch)
    append(spark, select(spark, sf_dir, STAGED).where(F.lit(False)), path, sch)  # K4: empty input writes nothing
    return spark.read.schema(sch).parquet(path).select(*[f.name for f in sch.fields])


@reg("q_align_schema", """SELECT CAST(o_orderkey AS INTEGER) AS k32, CAST(round(o_totalprice) AS BIGINT) AS price_long,
  CAST(CASE o_orderkey % 4 WHEN 0 THEN 3 WHEN 1 THEN -3 WHEN 2 THEN 2 ELSE 0 END AS BIGINT) AS half,
  CAST(o_totalprice AS DECIMAL(38,9)) AS price_dec, CAST(o_orderdate AS TIMESTAMP) AS ts,
  CAST(o_orderdate AS DATE) AS d, CAST(o_custkey AS STRING) AS cust_txt FROM orders""")
def q_align_schema(spark, sf_dir):
    """K2: columns reordered, cast to the target types, fractions rounded half away from zero
    into integers, extra columns dropped."""
    from pyspark.sql.types import DecimalType, StructField, StructType
    from tamarind.plans.common import schema
    from tamarind.sinks.warehouse import align_to_schema
    halves = F.when(F.col("o_orderkey") % 4 == 0, 2.5).when(F.col("o_orderkey") % 4 == 1, -2.5).when(F.col("o_orderkey") % 4 == 2, 1.5).otherwise(0.4)
    o = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("cust_txt"), F.col("o_orderdate").alias("d"), F.col("o_totalprice").alias("price_long"),
        F.col("o_totalprice").alias("price_dec"), F.col("o_orderdate").cast("string").alias("ts"), halves.alias("half"),
        F.col("o_orderkey").alias("k32"), "o_orderstatus")
    wanted = schema("k32:int, price_long:long, half:long, ts:ts, d:date, cust_txt:str").fields
    return align_to_schema(o, StructType([*wanted[:3], StructField("price_dec", DecimalType(38, 9)), *wanted[3:]]))


NULL_KEY_TARGET = ("SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey % 1000 END AS k, "
                   f"o_orderstatus AS v, {MONTH_START} AS date_id FROM orders")
NULL_KEY_STAGED = ("SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey % 1000 END AS k, "
                   f"'new' AS v, {MONTH_START} AS date_id FROM orders WHERE o_orderkey % 3 = 0")


@reg("q_upsert_null_key", f"""SELECT * FROM ({NULL_KEY_TARGET}) t WHERE NOT EXISTS (SELECT 1 FROM ({NULL_KEY_STAGED}) s
  WHERE s.date_id = t.date_id AND s.k = t.k) UNION ALL SELECT * FROM ({NULL_KEY_STAGED})""")
def q_upsert_null_key(spark, sf_dir):
    """A pk with a null part never matches, so old rows with it stay; several
    staged rows per pk all go in."""
    from tamarind.plans.common import schema
    sch = schema("k:long, v:str, date_id:date")
    path = _fresh_table(spark, sf_dir, "nullkey")
    append(spark, select(spark, sf_dir, NULL_KEY_TARGET), path, sch)
    upsert(spark, select(spark, sf_dir, NULL_KEY_STAGED), path, ("date_id", "k"), sch)
    return spark.read.schema(sch).parquet(path).select(*[f.name for f in sch.fields])


# ------------------------------------------------------------ fixtures ----
def ensure_adapter_lake(spark, sf_dir: str, adapter_name: str, source: Source | None = None, monthly: bool = False) -> str:
    """Write an adapter once as a lake table in the shared scratch folder, at the place that
    ``source`` declares; return the lake root. An adapter without date parts is one day;
    ``monthly`` puts each row on the first day of its month (fewer folders to list)."""
    root = f"{scratch_root(spark)}/fixtures-{_tag(sf_dir)}/lake{'-monthly' if monthly else ''}"
    path = (source or Source("", adapter_name)).path(root)
    if not path_exists(spark, f"{path}/_SUCCESS"):
        df = adapter(spark, sf_dir, adapter_name)
        for name, value in zip(lake.PART_COLS, (2024, 1, 1)):
            if name not in df.columns:
                df = df.withColumn(name, F.lit(value))
        if monthly:
            df = df.withColumn("day_of_month", F.lit(1))
        write_days(df, path)
    return root
