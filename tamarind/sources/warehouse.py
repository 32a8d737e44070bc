"""Warehouse reads and the three SQL templates of the studied system."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tamarind.functions.clean import strip
from tamarind.operators.windows import union_default_row
from tamarind.session import path_exists


def read_warehouse(spark: SparkSession, root: str | None, table: str, schema: str | None = None) -> DataFrame:
    """A warehouse table — a catalog table when no root is given, else the Parquet
    directory ``{root}/{table}``.  A missing directory reads as an empty typed frame."""
    if root is None:
        return spark.table(table)
    path = f"{root.rstrip('/')}/{table}"
    if not path_exists(spark, path):
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path)


def read_sql(spark: SparkSession, src, root: str | None, inputs: dict | None = None) -> DataFrame:
    """A declared query. ``src.reads`` are its warehouse tables ("name" or "name=table"),
    ``src.inputs`` frames that have been read already (a list of wanted ids to semi-join, say);
    the query names them as ``{name}``, so nothing is registered under a name that another
    source could take. Catalyst pushes its filters and columns into the scans."""
    frames = {}
    for entry in src.reads:
        name, _, table = entry.rpartition("=")
        frames[name or table] = read_warehouse(spark, root, table)
    given = inputs or {}
    missing = [a for a in src.inputs if a not in given]
    if missing:
        raise ValueError(f"inputs of the query {src.alias} that are not read: {missing}")
    frames.update({a: given[a] for a in src.inputs})
    return spark.sql(src.query, **frames)


def latest_address(dim_address: DataFrame, addr_type_id: int = 5) -> DataFrame:
    """Newest address of the given type per party, by ``date_id desc, addr_id desc``."""
    w = Window.partitionBy("party_id").orderBy(F.col("date_id").desc(), F.col("addr_id").desc())
    return (dim_address.where(F.col("addr_type_id") == F.lit(addr_type_id))
            .select("party_id", "addr_id", "date_id")
            .withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1)
            .select("addr_id", "party_id"))


def project_with_default(dim_project: DataFrame, wanted_ids: DataFrame | None = None,
                         id_col: str = "project_id") -> DataFrame:
    """Newest row per project (optionally only the ids in ``wanted_ids``, a semi
    join — never a driver-side id list), name trimmed, plus the ``-1 / (not set)`` row."""
    src = dim_project
    if wanted_ids is not None:
        src = src.join(wanted_ids.select(F.col(wanted_ids.columns[0]).alias(id_col)).distinct(),
                       id_col, "left_semi")
    w = Window.partitionBy(id_col).orderBy(F.col("date_id").desc(), F.col("project_code").desc(), F.col("project_name").desc())
    latest = (src.select(F.col(id_col).cast("string").alias("project_id"),
                         F.col("project_code").cast("string").alias("project_code"),
                         strip(F.col("project_name")).alias("project_name"), "date_id")
              .withColumn("_rn", F.row_number().over(w))
              .where("_rn = 1").drop("_rn", "date_id"))
    # The '(not set)' row, fixed values of the template
    return union_default_row(latest, {"project_id": "-1", "project_code": "(not set)",
                                      "project_name": "(not set)"})


def member_parties(dim_party: DataFrame, member_ids: DataFrame, id_col: str = "party_id") -> DataFrame:
    """Parties of type 1 or 2 whose lower-cased id is a member id (semi join)."""
    ids = member_ids.select(F.col(member_ids.columns[0]).cast("string").alias("_mid")).distinct()
    return (dim_party.where(F.col("party_type_id").cast("string").isin("1", "2"))
            .join(ids, F.lower(F.col(id_col)) == F.col("_mid"), "left_semi")
            .distinct())
