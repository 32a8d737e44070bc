"""Column-level operators: rename, suffix, lower-case, optional columns, blank -> null,
audit columns (P1-P4, P9-P11).  Each is one ``select`` — a Project node, no data pass."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tamarind.functions.dates import run_clock


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename by map; unknown names are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def suffix_columns(df: DataFrame, sfx: str) -> DataFrame:
    """Append ``sfx`` to every column name (collision-free joins)."""
    return df.select(*[F.col(f"`{c}`").alias(f"{c}{sfx}") for c in df.columns])


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def col_or(df: DataFrame, name: str, default=None, dtype: str = "string") -> Column:
    """The column when the frame has it, else a typed literal default."""
    if name in df.columns:
        return F.col(f"`{name}`")
    return F.lit(default).cast(dtype)


def blank_strings_to_null(df: DataFrame, but=()) -> DataFrame:
    """P10: ``""`` -> null in every string column (one select), ``but`` some, such as join keys."""
    return df.select(*[
        F.nullif(F.col(f"`{f.name}`"), F.lit("")).alias(f.name) if isinstance(f.dataType, StringType) and f.name not in but
        else F.col(f"`{f.name}`") for f in df.schema.fields])


def pack_flags(flags) -> Column:
    """Booleans that may be null as one number, two bits each: a row of many takes less of a shuffle."""
    digits = [F.shiftleft(F.coalesce(c.cast("int") + 1, F.lit(0)), 2 * i) for i, c in enumerate(flags)]
    return reduce(lambda a, b: a + b, digits)


def unpack_flag(packed, i: int) -> Column:
    """The boolean at place ``i`` of ``pack_flags``."""
    digit = F.shiftright(packed, 2 * i).bitwiseAND(F.lit(3))
    return F.when(digit > 0, digit == 2)


def with_audit(df: DataFrame, run_ts: _dt.datetime | None, note_type: str = "int") -> DataFrame:
    """``dwh_crtd_dttm``, ``dwh_updt_dttm`` = run clock, ``dwh_note`` = typed null."""
    clock = run_clock(run_ts)
    return df.withColumns({"dwh_crtd_dttm": clock, "dwh_updt_dttm": clock,
                           "dwh_note": F.lit(None).cast(note_type)})
