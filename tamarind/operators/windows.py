"""Per-key newest values and literal default rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_value_per_key(df: DataFrame, key: str, value: str, alias: str | None = None) -> DataFrame:
    """The greatest ``value`` per ``key`` (row_number over value desc, nulls last,
    keeping only the value, is the same as ``max``).  A key whose values are all null
    still gets a row, with a null value.  Partial aggregation before the shuffle."""
    return df.groupBy(key).agg(F.max(value).alias(alias or value))


def union_default_row(df: DataFrame, row: dict) -> DataFrame:
    """``df UNION ALL`` one literal row (columns missing from ``row`` are null)."""
    lits = [F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    one = df.sparkSession.range(1).select(*lits)
    return df.unionByName(one)
