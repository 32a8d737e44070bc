"""Plan shape: pruning reaches the scan; no Python UDFs, no nested-loop or cartesian joins."""

import pytest

from tamarind.queries.catalog import all_queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


QUERIES = all_queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_no_cartesian(spark, sf_dir, name):
    p = plan(QUERIES[name](spark, sf_dir))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "RoundRobin"):
        assert bad not in p, f"{name}: {bad}"
    if name != "b_dim_party_memberstatus":  # its fixture doubles a table by two literal rows
        assert "BroadcastNestedLoopJoin" not in p, name


def test_mobile_user_plan_is_lean(spark, sf_dir):
    assert plan(QUERIES["b_dim_mobile_user"](spark, sf_dir)).count("Exchange hashpartitioning") <= 14


def test_mobile_user_histories_shuffle_what_counts(spark, sf_dir):
    """No date of a history goes through a shuffle: repeats are dropped from the columns in use."""
    p = plan(QUERIES["b_dim_mobile_user"](spark, sf_dir))
    shuffled = [l for l in p.splitlines() if "Exchange hashpartitioning" in l]
    assert shuffled and not [l for l in shuffled if "ftcreatedate" in l or "ftupdatedate" in l]


def test_upsert_reads_only_touched_partitions(spark):
    """A daily load must not scan the whole warehouse table: the touched dates become a
    partition filter on the target scan."""
    import datetime as dt
    from pyspark.sql import functions as F
    from tamarind.plans.common import schema
    from tamarind.session import scratch_root
    from tamarind.sinks.warehouse import append, touched_dates, upsert, upsert_frame
    sch = schema("k:long, v:str, date_id:date")
    root = f"{scratch_root(spark)}/plan-upsert-{dt.datetime.now().timestamp()}"
    base = spark.range(0, 1000).select(
        F.col("id").alias("k"), F.lit("a").alias("v"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 20).cast("int")).alias("date_id"))
    append(spark, base, f"{root}/t", sch)
    new = spark.range(0, 5).select(F.col("id").alias("k"), F.lit("b").alias("v"), F.lit(dt.date(2024, 1, 5)).alias("date_id"))
    append(spark, new, f"{root}/s", sch)
    assert touched_dates(spark, f"{root}/s") == ["2024-01-05"]
    target, staged = (spark.read.schema(sch).parquet(f"{root}/{x}") for x in "ts")
    merged = upsert_frame(target, staged, ("date_id", "k"), ["2024-01-05"])
    scans = [l for l in plan(merged).splitlines() if "FileScan" in l and "PartitionFilters: [isnotnull(date_id" in l]
    assert scans and any("2024-01-05" in l for l in scans)
    # the touched date holds ids 4, 24, ..., 984; of the staged keys 0-4 only 4 is there: 49 kept + 5 staged
    assert merged.count() == 54
    out = upsert(spark, new, f"{root}/t", ("date_id", "k"), sch)
    assert out == {"rows": 5, "columns": 3, "skipped": False, "null_dates": 0}
    assert spark.read.schema(sch).parquet(f"{root}/t").count() == 1004


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from tamarind.session import scratch_root

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session())


def test_role_permissions_go_through_one_shuffle(spark, sf_dir):
    """Permissions are shuffled once, without the columns of their role, and not again by the distinct."""
    p = plan(QUERIES["b_dim_pmsrole_permission"](spark, sf_dir))
    join = p.index("HashJoin")
    assert "Exchange" not in p[:join] and "HashAggregate" in p[:join] and "Aggregate" not in p[join:]
    assert p.count("Exchange hashpartitioning") == 1


def test_company_projects_hold_log_rows_in_the_dealt_distinct_only(spark):
    """Neither join sorts log rows and nothing below the last shuffle keeps them; that shuffle has
    twice the tasks for twice the rows. The rows are those of a hand-made table."""
    import datetime as dt
    import re
    import uuid
    from tamarind.plans.project import build_fact_pmscompany_projects
    from tamarind.queries.builders import CTX
    from tamarind.session import scratch_root

    company = spark.createDataFrame([(1, " C1 ", "nan"), (2, None, "two")], "id long, code string, name_th string")
    project = spark.createDataFrame([(5, "", "five"), (6, "P6", None)], "id long, pms_project_id string, name_th string")
    names = "id string, company_project_id string, company_id long, project_id long, action_type string, created_at string, created_by string"
    rows = [("1", "10", 1, 5, " ADD ", "2024-01-02 03:04:05", "me"), ("1", "10", 1, 5, "ADD", "2024-01-02 03:04:05", "me"),
            ("2", "", None, 6, None, "not a date", ""), ("x", "", None, 6, None, "", None), ("y", None, None, 6, "nan", None, None),
            ("4.0", "4.5", 2, None, "", "2024-01-03", None), ("5", "7", 9, 9, "", "2024-01-03", None)]
    root = f"{scratch_root(spark)}/projects-{uuid.uuid4().hex}"
    spark.createDataFrame(rows, names).write.parquet(f"{root}/few")

    def build(log):
        return build_fact_pmscompany_projects({"companies_projects_logs": log, "companies": company, "projects": project}, CTX)

    cols = ("mapping_log_id", "mapping_id", "company_id", "company_cd", "company_nm_th", "project_id", "ref_pmsproject_id", "pmsproject_nm_th", "status_nm", "crtd_by", "date_id")
    got = sorted((tuple(r) for r in build(spark.read.parquet(f"{root}/few")).select(*cols).collect()), key=str)
    assert got == sorted([(1, 10, 1, "C1", "", 5, None, "five", "ADD", "me", dt.date(2024, 1, 2)), (2, None, None, "", "", 6, "P6", "", "", None, None),
                          (None, None, None, "", "", 6, "P6", "", "", None, None), (4, None, 2, "", "two", None, None, "", "", None, dt.date(2024, 1, 3)),
                          (5, 7, 9, "", "", 9, None, "", "", None, dt.date(2024, 1, 3))], key=str)

    tasks = []
    for n in (1_500_000, 3_000_000):
        log = spark.range(4 * n).selectExpr("string(id) AS id", "string(id) AS company_project_id", "id % 9 AS company_id", "nullif(id % 3, 0) AS project_id",
                                            "string(id % 2) AS action_type", "'2024-01-0' || (id % 7 + 1) AS created_at", "string(id % 5) AS created_by")
        p = plan(build(log))
        last = p.index("Exchange hashpartitioning(date_id")
        assert "SortMergeJoin" not in p and p.count("ShuffledHashJoin") == 2
        assert p[:last].count("HashAggregate") == 2 and "Aggregate" not in p[last:]
        tasks.append(int(re.search(r", (\d+)\), REPARTITION_BY_NUM", p[last:])[1]))
    assert tasks[0] > 2 * spark.sparkContext.defaultParallelism and 1.8 < tasks[1] / tasks[0] < 2.2
