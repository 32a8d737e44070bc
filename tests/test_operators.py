"""Operators: latest per key, joins, unpivot, sinks, missing sources."""

import datetime as dt

from pyspark.sql import functions as F

from tamarind import operators as op
from tamarind.plans.common import schema
from tamarind.session import scratch_root
from tamarind.sinks.warehouse import append, upsert
from tamarind.sources import lake


def test_latest_per_key_ties_and_null_keys(spark):
    rows = [("a", 2024, 1, 5, "old"), ("a", 2024, 12, 1, "new"), ("a", 2024, 9, 30, "mid"),
            (None, 2030, 1, 1, "nullkey"), ("b", 2024, 1, 1, "x"), ("b", 2024, 1, 1, "y")]
    df = spark.createDataFrame(rows, "k string, calendar_year int, month_no int, day_of_month int, v string")
    out = {r.k: r.v for r in lake.latest_per_key(df, "k").collect()}
    assert out["a"] == "new"            # month 12 beats month 9 (numeric order, D22)
    assert None not in out              # null keys dropped
    assert out["b"] in ("x", "y")
    again = {r.k: r.v for r in lake.latest_per_key(df.repartition(3), "k").collect()}
    assert again["b"] == out["b"]       # ties resolve the same way whatever the partitioning (D5)


def test_null_safe_join(spark):
    l_ = spark.createDataFrame([(1, None), (2, "x")], "id int, k string")
    r_ = spark.createDataFrame([(None, "n"), ("x", "m")], "k string, v string")
    plain = op.lookup_join(l_, r_, "k", "k", "left").select("id", "v").collect()
    safe = op.lookup_join(l_, r_, "k", "k", "left", null_safe=True).select("id", "v").collect()
    assert sorted((r.id, r.v) for r in plain) == [(1, None), (2, "m")]
    assert sorted((r.id, r.v) for r in safe) == [(1, "n"), (2, "m")]


def test_unpivot_groups(spark):
    df = spark.createDataFrame([(1, "a1", "z1", "a2", "z2")], "id int, h_addr string, h_zip string, s_addr string, s_zip string")
    out = op.unpivot_groups(df, ["id"], {5: {"addr": "h_addr", "zip": "h_zip"}, 3: {"addr": "s_addr", "zip": "s_zip"}},
                            tag_name="t").collect()
    assert sorted((r.t, r.addr, r.zip) for r in out) == [(3, "a2", "z2"), (5, "a1", "z1")]


def test_missing_source_is_empty(spark):
    root = scratch_root(spark)
    df = lake.read_lake(spark, f"{root}/nowhere/table", columns=["a", "b"], full=True)
    assert df.count() == 0 and df.columns == ["a", "b"]


def test_upsert_null_pk_and_rerun(spark):
    root = scratch_root(spark)
    sch = schema("k:long, v:str, date_id:date")
    d = dt.date(2024, 1, 1)
    path = f"{root}/t-upsert-test"
    base = spark.createDataFrame([(1, "a", d), (None, "n", d), (2, "b", dt.date(2024, 1, 2))], "k long, v string, date_id date")
    append(spark, base, path, sch)
    staged = spark.createDataFrame([(1, "A", d), (1, "A2", d), (None, "N", d)], "k long, v string, date_id date")
    upsert(spark, staged, path, ("date_id", "k"), sch)
    got = sorted(((r.k, r.v, str(r.date_id)) for r in spark.read.schema(sch).parquet(path).collect()), key=str)
    # k=1 replaced (both staged rows in), null-key old row kept, other day untouched
    assert got == sorted([(1, "A", "2024-01-01"), (1, "A2", "2024-01-01"), (None, "n", "2024-01-01"),
                          (None, "N", "2024-01-01"), (2, "b", "2024-01-02")], key=str)
    empty = upsert(spark, staged.where(F.lit(False)), path, ("date_id", "k"), sch)
    assert empty["skipped"] is True


def test_registry_has_every_builder():
    from tamarind.plans.registry import BY_NAME, SPECS
    assert len(SPECS) == 33
    assert SPECS[-1].name == "fact_unit"
    names = [s.name for s in SPECS]
    # the member-status update reads what the other party builders wrote
    assert names.index("dim_party_memberstatus") > names.index("dim_party_ru")
    assert {s.target for s in SPECS if s.target == "dim_party"} == {"dim_party"}
    assert sum(s.target == "dim_party" for s in SPECS) == 4
    assert sum(s.target == "dim_address" for s in SPECS) == 2


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_estimate_is_a_real_size_and_grants_a_broadcast(spark, sf_dir):
    from tamarind.operators.joins import estimated_bytes, lookup_join
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    assert 1000 < estimated_bytes(nation) < 10_000
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = [spark.conf.get(k) for k in keys]
    try:
        for k, v in zip(keys, ("-1", "false")):
            spark.conf.set(k, v)
        assert "BroadcastHashJoin" in plan_of(lookup_join(cust, nation, "c_nationkey", "n_nationkey", small=True))
        assert "SortMergeJoin" in plan_of(lookup_join(cust, nation, "c_nationkey", "n_nationkey", small=True, max_bytes=100))
    finally:
        for k, v in zip(keys, old):
            spark.conf.set(k, v)


def test_latest_per_key_has_no_distinct_and_limits_before_the_shuffle(spark, sf_dir):
    from tamarind.sources.lake import latest_per_key
    df = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("*", "year(ts) AS calendar_year", "month(ts) AS month_no", "day(ts) AS day_of_month")
    p = plan_of(latest_per_key(df, "user_id", tie=("ts", "event_id")))
    assert "SortAggregate" not in p and p.count("WindowGroupLimit") >= 2 and p.count("Exchange hashpartitioning") == 1


def test_fractions_round_half_away_from_zero(spark):
    from decimal import Decimal
    from tamarind.plans.common import schema
    from tamarind.sinks.warehouse import align_to_schema
    df = spark.createDataFrame([(0.5, Decimal("2.50")), (-0.5, Decimal("-2.50")), (1.4, Decimal("1.49")), (None, None)], "a double, b decimal(10,2)")
    assert [tuple(r) for r in align_to_schema(df, schema("a:long, b:int")).collect()] == [(1, 3), (-1, -3), (1, 1), (None, None)]


def test_run_clock(spark):
    import datetime as dt
    from tamarind.functions.dates import run_clock
    given = dt.datetime(2025, 1, 1, 3)
    now, same = spark.range(1).select(run_clock(), run_clock(given)).first()
    assert same == given
    expected = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(hours=7)
    assert abs((now - expected).total_seconds()) < 60


def test_one_date_spreads_over_many_write_tasks(spark):
    import uuid
    from tamarind.session import child_names, scratch_root
    from tamarind.sinks.warehouse import spread
    key, old = "spark.sql.adaptive.advisoryPartitionSizeInBytes", spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set(key, "64k")
    try:
        rows = spark.range(0, 400_000, numPartitions=40).selectExpr("id", "sha2(string(id), 256) AS pad", "make_date(2024, 1, 1 + int(id) % 1) AS date_id")
        path = f"{scratch_root(spark)}/spread-{uuid.uuid4().hex}"
        spread(rows, "date_id").write.partitionBy("date_id").parquet(path)
        files = [n for n in child_names(spark, f"{path}/date_id=2024-01-01") if n.startswith("part-")]
        assert len(files) > 16 and spark.read.parquet(path).count() == 400_000
    finally:
        spark.conf.set(key, old)


def test_latest_project_is_the_same_row_whatever_the_read_order(spark):
    from tamarind.sources.warehouse import project_with_default
    rows = [("p", "a", "x", "2024-01-01"), ("p", "b", "x", "2024-01-01"), ("p", "b", "y", "2024-01-01")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "project_id string, project_code string, project_name string, date_id string")
        got = project_with_default(df).where("project_id = 'p'").collect()
        assert [(r.project_code, r.project_name) for r in got] == [("b", "y")]


def test_streamed_join_equals_the_lookup_and_sorts_no_left_rows(spark):
    from tamarind.operators.joins import lookup_join, streamed_join
    # a third of the left rows without a key, a third of one key, the others of own keys, some unknown
    left = spark.range(3000).selectExpr("id", "CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 7 ELSE id END AS k")
    right = spark.range(2500).selectExpr("id AS key", "nullif('v' || id, 'v5') AS v").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS key, 'none' AS v"))
    plain = sorted(lookup_join(left, right, "k", "key").collect())
    for most, kind in ((0, "ShuffledHashJoin"), (1 << 20, "BroadcastHashJoin")):
        df = streamed_join(left, right, "k", "key", max_bytes=most)
        assert kind in plan_of(df) and "SortMergeJoin" not in plan_of(df)
        assert sorted(df.collect()) == plain and len(plain) == 3000


def test_placed_join_needs_one_shuffle_for_join_and_distinct(spark, monkeypatch):
    """Rows as of a plain join and distinct: keys that differ as text only, repeated rows on both
    sides, null keys on both sides, a heavy key; nothing goes through a shuffle above the join."""
    from pyspark.sql import functions as F
    from tamarind.operators import PLACE, joins
    left = spark.range(4000).selectExpr("CASE id % 4 WHEN 0 THEN '7' WHEN 1 THEN NULL WHEN 2 THEN '0' || (id % 50) ELSE 'x' || (id % 3) END AS k", "id % 300 AS v")
    left = left.withColumn("number", F.expr("try_cast(k AS BIGINT)"))
    right = spark.range(120).selectExpr("CASE id % 6 WHEN 0 THEN NULL WHEN 1 THEN '0' || (id % 50) WHEN 2 THEN 'x1' WHEN 3 THEN '7' ELSE string(id) END AS key", "'w' || id % 4 AS w")
    right = right.withColumn("number_of", F.expr("try_cast(key AS BIGINT)"))
    plain = sorted(joins.lookup_join(left, right, "k", "key", "left", null_safe=True).select("v", "number", "w").distinct().collect(), key=str)
    monkeypatch.setattr(joins, "WORTH_COUNTING", 0)
    pieces, counted = [], joins._heavy_groups
    monkeypatch.setattr(joins, "_heavy_groups", lambda groups, tasks: pieces.append(counted(groups, tasks)) or pieces[-1])
    for most, kind, tasks in ((0, "ShuffledHashJoin", 16), (0, "ShuffledHashJoin", 0), (1 << 20, "BroadcastHashJoin", 16)):
        df = joins.placed_join(left, right, "k", "key", "number", "number_of", tasks, max_bytes=most).select("v", "number", "w", PLACE).distinct().drop(PLACE)
        p = plan_of(df)
        assert kind in p and "Exchange" not in p[:p.index(kind)] and p.count("Exchange hashpartitioning") == (2 if most == 0 else 1)
        assert sorted(df.collect(), key=str) == plain
    assert all(max(r._pieces for r in h.collect()) > 4 for h in pieces) and len(pieces) == 2


def test_packed_flags_come_back(spark):
    from pyspark.sql import functions as F
    from tamarind.operators import pack_flags, unpack_flag
    rows = [(a, b, c) for a in (True, False, None) for b in (True, False, None) for c in (True, False, None)]
    df = spark.createDataFrame(rows, "a boolean, b boolean, c boolean").withColumn("p", pack_flags([F.col(c) for c in "abc"]))
    assert df.where("p IS NULL").isEmpty() and df.select("p").distinct().count() == 27
    assert df.where(~(unpack_flag("p", 0).eqNullSafe(F.col("a")) & unpack_flag("p", 1).eqNullSafe(F.col("b")) & unpack_flag("p", 2).eqNullSafe(F.col("c")))).isEmpty()


def test_tasks_by_rows(spark):
    """As many tasks as the rows ask for, one for each core at least, none where nothing is known of them."""
    from tamarind.sources.lake import DEALT_BYTES, tasks_by_rows
    cores = spark.sparkContext.defaultParallelism
    assert tasks_by_rows(spark.range(10)) == cores
    assert tasks_by_rows(spark.range(DEALT_BYTES * cores)) == 8 * cores
    assert tasks_by_rows(spark.createDataFrame([(1,)], "id long")) == 0
