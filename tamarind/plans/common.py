"""Shared pieces of the table builders.

The schemas, column lists, keys, address groups and permission pairs in the plan modules are
fixed values: they are the contract of the source and target tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)

_TYPES = {"str": StringType(), "ts": TimestampNTZType(), "date": DateType(), "int": IntegerType(),
          "long": LongType(), "dbl": DoubleType(), "bool": BooleanType()}


def schema(text: str) -> StructType:
    """``"a:str, b:ts, ..."`` -> StructType (every field nullable)."""
    out = []
    for part in text.replace("\n", " ").split(","):
        part = part.strip()
        if part:
            name, typ = part.split(":")
            out.append(StructField(name.strip(), _TYPES[typ.strip()], True))
    return StructType(out)


def finish(df: DataFrame, sch: StructType, distinct: bool = True, tasks: int = 0, same: tuple[str, ...] = ()) -> DataFrame:
    """P5 + A1: the ordered output columns, cast to the table schema, then (usually)
    a full-row distinct — a hash aggregate with a partial step before the shuffle.

    With ``tasks`` the rows are first dealt over so many tasks and the distinct is made there, so
    that the tasks before it hold no rows; for rows of which few repeat, and many to a task.
    ``same`` columns hold one value throughout and take no part in the dealing."""
    out = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in sch.fields])
    if tasks:
        out = out.repartition(tasks, *[c for c in sch.names if c not in same])
    return out.distinct() if distinct else out


AUDIT = "dwh_crtd_dttm:ts, dwh_updt_dttm:ts, dwh_note:int"
