"""DuckDB SQL snippets for the oracles: the same cleaning rules, written independently
in SQL (DuckDB's own casts differ: e.g. TRY_CAST('1.5' AS BIGINT) rounds, so numbers
are checked by pattern first)."""

from __future__ import annotations

TS_MIN = "TIMESTAMP '1677-09-21 00:12:43.145225'"
TS_MAX = "TIMESTAMP '2262-04-11 23:47:16.854775'"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\x{{00A0}}\x{{1C}}-\x{{1F}}]+|[\s\x{{00A0}}\x{{1C}}-\x{{1F}}]+$', '', 'g')"


def clean(x: str) -> str:
    return f"(CASE WHEN ({x}) IS NULL OR lower(CAST({x} AS STRING)) = 'nan' THEN '' ELSE {strip(f'CAST({x} AS STRING)')} END)"


def to_ts(x: str) -> str:
    t = f"TRY_CAST({strip(f'CAST({x} AS STRING)')} AS TIMESTAMP)"
    return f"(CASE WHEN {t} BETWEEN {TS_MIN} AND {TS_MAX} THEN {t} END)"


def zfill2(x: str) -> str:
    return f"(CASE WHEN length({x}) >= 2 THEN {x} ELSE lpad({x}, 2, '0') END)"


def date_text(x: str, day_width: int = 3) -> str:
    s = f"CAST({x} AS STRING)"
    day = f"substr({s}, 9, {day_width})"
    if day_width > 2:
        day = f"regexp_replace({day}, '^([0-9]{{2}})[ T]$', '\\1')"
    txt = f"(substr({s}, 1, 4) || {zfill2(f'substr({s}, 6, 2)')} || {zfill2(day)})"
    d = f"(CASE WHEN regexp_full_match({txt}, '[0-9]{{8}}') THEN CAST(try_strptime({txt}, '%Y%m%d') AS DATE) END)"
    return f"(CASE WHEN {d} BETWEEN DATE '1677-09-22' AND DATE '2262-04-11' THEN {d} END)"


def date_ts(x: str) -> str:
    return f"CAST({to_ts(x)} AS DATE)"


def _dbl(x: str) -> str:
    return f"TRY_CAST(CAST({x} AS STRING) AS DOUBLE)"


def to_double(x: str, default: float | None = None) -> str:
    d = _dbl(x)
    v = f"(CASE WHEN isnan({d}) THEN NULL ELSE {d} END)"
    return v if default is None else f"coalesce({v}, {float(default)!r})"


def to_long(x: str) -> str:
    s = f"CAST({x} AS STRING)"
    d = _dbl(x)
    return (f"(CASE WHEN regexp_full_match({s}, '\\s*[+-]?[0-9]+\\s*') THEN TRY_CAST(trim({s}) AS BIGINT) "
            f"WHEN {d} = floor({d}) AND abs({d}) < 9.2e18 THEN CAST({d} AS BIGINT) END)")


def be_to_ce(x: str, threshold: int, upper: int | None = None, min_len: int = 4) -> str:
    s = f"CAST({x} AS STRING)"
    y = f"TRY_CAST(CASE WHEN regexp_full_match(substr({s}, 1, 4), '[0-9]{{4}}') THEN substr({s}, 1, 4) END AS INTEGER)"
    cond = f"{y} > {threshold} AND length({s}) >= {min_len}"
    if upper is not None:
        cond += f" AND {y} < {upper}"
    return f"(CASE WHEN {cond} THEN CAST({y} - 543 AS STRING) || substr({s}, 5) ELSE {s} END)"


def case_map(x: str, mapping: dict, default: str | None = "__PASS__") -> str:
    whens = " ".join(f"WHEN {x} = '{k}' THEN '{v}'" for k, v in mapping.items())
    if default == "__PASS__":
        other = x
    elif default is None:
        other = "NULL"
    else:
        other = f"'{default}'"
    return f"(CASE {whens} ELSE {other} END)"


def latest(table_sql: str, keys: str, order: str = "calendar_year DESC, month_no DESC, day_of_month DESC") -> str:
    """Newest row per key: the oracle's ROW_NUMBER form."""
    nn = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) AS _rn "
            f"FROM ({table_sql}) WHERE {nn}) WHERE _rn = 1")


RUN_TS = "TIMESTAMP '2025-01-01 03:00:00'"
AUDIT = f"{RUN_TS} AS dwh_crtd_dttm, {RUN_TS} AS dwh_updt_dttm, CAST(NULL AS INTEGER) AS dwh_note"


def epoch(d: str) -> str:
    """Seconds (a DOUBLE expression) -> timestamp; NaN/null/huge -> null."""
    return (f"(CASE WHEN {d} IS NOT NULL AND NOT isnan({d}) AND abs({d}) < 1e13 THEN "
            f"TIMESTAMP '1970-01-01 00:00:00' + to_microseconds(CAST(round({d} * 1000000) AS BIGINT)) END)")


def nullif_all(cols: str) -> str:
    return ", ".join(f"NULLIF({c.strip()}, '') AS {c.strip()}" for c in cols.split(","))


def nulls(cols: str, typ: str = "VARCHAR") -> str:
    return ", ".join(f"CAST(NULL AS {typ}) AS {c.strip()}" for c in cols.split(","))
