"""Declarative specs: where a builder's inputs come from and where its output goes."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# Source kinds
LAKE = "lake"          # S1-S3: the job's day (or month/year/all)
LATEST = "latest"      # S10: full read, newest row per key
HISTORY = "history"    # S11: N years back, distinct
WAREHOUSE = "warehouse"  # S12: a warehouse table
SQL = "sql"            # S12: a query over warehouse tables and other sources of the spec


@dataclass(frozen=True)
class Source:
    alias: str
    table: str
    app: str = "mssql"
    source_type: str = ""
    columns: tuple[str, ...] | None = None
    kind: str = LAKE
    keys: tuple[str, ...] = ()
    tie: tuple[str, ...] = ()
    schema: str | StructType | None = None  # used when the table does not exist (S9)
    query: str | None = None           # SQL: names its inputs as {name}
    reads: tuple[str, ...] = ()        # SQL: warehouse tables, or "name=table", among the inputs
    inputs: tuple[str, ...] = ()       # SQL: other sources of the spec among the inputs (their aliases)
    repeats: bool = False              # HISTORY: the builder drops the repeats, of what it uses, so the read need not
    dealt: bool = False                # the builder deals the rows before it keeps any, so a scan of enough splits need not

    def path(self, root: str) -> str:
        """``{root}/{app}[/{source_type}]/{table}``."""
        seg = f"/{self.source_type}" if self.source_type else ""
        return f"{root.rstrip('/')}/{self.app}{seg}/{self.table}"


Builder = Callable[[dict, "object"], DataFrame]


@dataclass(frozen=True)
class TableSpec:
    name: str                      # unique spec name (M5)
    target: str                    # warehouse table
    pk: tuple[str, ...]            # delete key of the upsert (not a uniqueness rule)
    sources: tuple[Source, ...]
    build: Builder
    schema: StructType
    full_default: bool = False     # M3
    append: bool = False           # K3
    sort: tuple[str, ...] = ()     # O2: order of the rows within a partition's files
    row_local: bool = False        # M2: the key holds the lake day, so one range read equals day by day

    def warehouse_tables(self) -> set[str]:
        """The warehouse tables that the spec reads."""
        out = {s.table for s in self.sources if s.kind == WAREHOUSE}
        return out | {r.rpartition("=")[2] for s in self.sources if s.kind == SQL for r in s.reads}
