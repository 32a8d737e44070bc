"""Columns -> rows (R1-R3).  One scan of the input; Spark plans an Expand/Generate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot(df: DataFrame, ids, values, var_name: str, value_name: str) -> DataFrame:
    """Melt ``values`` into (``var_name``, ``value_name``) rows, keeping ``ids``."""
    return df.unpivot(list(ids), list(values), var_name, value_name)


def unpivot_groups(df: DataFrame, ids, groups: dict, tag_name: str | None = None) -> DataFrame:
    """Each tag's group of columns becomes one row.

    ``groups = {tag: {out_name: in_column_or_Column, ...}, ...}``; every group must
    name the same outputs.  ``tag_name`` (optional) receives the tag literal.
    """
    outs = None
    structs = []
    for tag, cols in groups.items():
        names = list(cols.keys())
        if outs is None:
            outs = names
        elif names != outs:
            raise ValueError("every group must list the same output columns in the same order")
        fields = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in cols.items()]
        if tag_name:
            fields.append(F.lit(tag).alias(tag_name))
        structs.append(F.struct(*fields))
    ids = list(ids)
    return df.select(*ids, F.inline(F.array(*structs)))
