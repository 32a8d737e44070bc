"""Driver test tables as temp views."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed run clock of every driver query, so outputs are repeatable.
import datetime as _dt

RUN_TS = _dt.datetime(2025, 1, 1, 3, 0, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register(spark: SparkSession, sf_dir: str, sql: str) -> None:
    """Register the test tables that ``sql`` names as temp views (lazy; no data read)."""
    words = set(re.findall(r"\w+", sql))
    for n in TABLES:
        if n in words:
            table(spark, sf_dir, n).createOrReplaceTempView(n)


def select(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """``sql`` over the test tables that it names."""
    register(spark, sf_dir, sql)
    return spark.sql(sql)
