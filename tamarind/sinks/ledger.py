"""Appends that a rerun does not repeat (K3): a ledger of loads beside the table.

A load is named by its table and lake day. Its rows are written to a folder beside the data first;
then its files are named in the ledger (an ``intent``), moved into the table's date folders under
names of the load's own, and the load is marked ``done``. A load that is done is skipped or
replaced, by choice; one that stopped in between is taken back, from the files that its intent
names, and made again. The ledger lies in the table's ``_loads`` folder, which readers pass over.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tamarind.session import child_names, create_file, move_path, path_exists, read_file, remove_path
from tamarind.sinks.warehouse import PARTITION_COL, _write


def _entry(path: str, load_id: str) -> str:
    return f"{path.rstrip('/')}/_loads/{load_id}"


def loads(spark: SparkSession, path: str) -> dict[str, bool]:
    """The loads of a table that began, and whether each was finished."""
    root = f"{path.rstrip('/')}/_loads"
    names = child_names(spark, root) if path_exists(spark, root) else []
    return {n: path_exists(spark, f"{root}/{n}/done") for n in sorted(names)}


def take_back(spark: SparkSession, path: str, load_id: str) -> None:
    """Removes the files of a load and its entry."""
    entry = _entry(path, load_id)
    if path_exists(spark, f"{entry}/intent"):
        for name in read_file(spark, f"{entry}/intent").splitlines():
            remove_path(spark, f"{path}/{name}")
    remove_path(spark, entry)


def append_once(spark: SparkSession, df: DataFrame, path: str, schema: StructType, load_id: str, repeated: str = "skip",
                partition_col: str = PARTITION_COL, sort=()) -> dict:
    """Appends the rows of a load unless it is done; ``repeated``: "skip" a load that is, or
    "replace" its rows. The report of a skipped load has no rows."""
    if repeated not in ("skip", "replace"):
        raise ValueError(f"a repeated load is skipped or replaced, not {repeated}")
    entry = _entry(path, load_id)
    done = path_exists(spark, f"{entry}/done")
    if done and repeated == "skip":
        return {"rows": 0, "columns": len(schema.fields), "skipped": True, "null_dates": 0, "repeated": True}
    stage = f"{path.rstrip('/')}/_stage-{uuid.uuid4().hex}"  # on the table's own file system, so that moving renames
    try:
        out = _write(df, stage, schema, partition_col, "errorifexists", sort)  # before anything of the old load goes
        take_back(spark, path, load_id)
        folders = [n for n in child_names(spark, stage) if n.startswith(f"{partition_col}=")]
        files = [(f"{folder}/{name}", f"{folder}/{load_id}-{name}") for folder in folders for name in child_names(spark, f"{stage}/{folder}")
                 if name.endswith(".parquet")]
        create_file(spark, f"{entry}/intent", "\n".join(to for _, to in files))
        for name, to in files:
            move_path(spark, f"{stage}/{name}", f"{path}/{to}")
        create_file(spark, f"{entry}/done", str(out["rows"]))
        return out
    finally:
        remove_path(spark, stage)
