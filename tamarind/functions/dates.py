"""Dates, timestamps and Buddhist-era years.

Timestamps are ``timestamp_ntz`` throughout: the source text carries no zone and the
warehouse keeps Bangkok wall-clock time.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamarind.functions.clean import _c, int_or_null, strip
from tamarind.functions.text import zfill

# The range of a pandas nanosecond timestamp.  Outside it the coercing
# parse of the studied code gives null, so ours does too.
TS_MIN = _dt.datetime(1677, 9, 21, 0, 12, 43, 145225)
TS_MAX = _dt.datetime(2262, 4, 11, 23, 47, 16, 854775)

DATE_MIN = _dt.date(1677, 9, 22)
DATE_MAX = _dt.date(2262, 4, 11)

# Seconds beyond the range of timestamps on both sides; they also fit the interval's decimal.
MOST_SECONDS = 1e10

BANGKOK = "Asia/Bangkok"
ERA_OFFSET = 543  # Buddhist era year - common era year


def ntz_literal(value: _dt.datetime) -> Column:
    """A timestamp_ntz literal built from text, so no time zone (session or process)
    can shift it."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _in_range(ts: Column) -> Column:
    return F.when((ts >= ntz_literal(TS_MIN)) & (ts <= ntz_literal(TS_MAX)), ts)


def to_ts(c) -> Column:
    """coercing text (or timestamp) -> naive timestamp; bad or out of range -> null."""
    return _in_range(strip(_c(c).cast("string")).try_cast("timestamp_ntz"))


def date_id_from_ts(c) -> Column:
    """F20d: date of a coercing timestamp parse."""
    return to_ts(c).cast("date")


def date_id_from_text(c, day_width: int = 3) -> Column:
    """F20a/b/c: ``s[0:4] + zfill(s[5:7]) + zfill(s[8:8+day_width])`` read as a date.

    With ``day_width=3`` the slice takes one character past the day; a trailing blank
    or ``T`` is accepted there (as the pandas parser does), anything else fails.
    Unparsable text gives null.
    """
    s = _c(c).cast("string")
    day = F.substring(s, 9, day_width)
    if day_width > 2:
        day = F.regexp_replace(day, r"^([0-9]{2})[ T]$", "$1")
    # joined by dashes, the cast reads it without a formatter
    txt = F.concat_ws("-", F.substring(s, 1, 4), zfill(F.substring(s, 6, 2), 2), zfill(day, 2))
    d = F.when(s.isNotNull() & txt.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), txt.try_cast("date"))
    return F.when(d.between(F.lit(DATE_MIN), F.lit(DATE_MAX)), d)


def date_id_from_parts(year, month, day) -> Column:
    """F20e: date from the lake partition columns."""
    return F.make_date(_c(year).cast("int"), _c(month).cast("int"), _c(day).cast("int"))


def be_to_ce(c, threshold: int, upper: int | None = None, min_len: int = 4) -> Column:
    """when the leading 4 characters are a year above ``threshold`` (and below
    ``upper``; text at least ``min_len`` long), subtract 543 from it; else unchanged."""
    s = _c(c).cast("string")
    y = int_or_null(F.substring(s, 1, 4), "int")
    cond = y.isNotNull() & (y > F.lit(threshold)) & (F.length(s) >= F.lit(min_len))
    if upper is not None:
        cond = cond & (y < F.lit(upper))
    return F.when(cond, F.concat((y - F.lit(ERA_OFFSET)).cast("string"), F.substring(s, 5, 1 << 30))).otherwise(s)


def epoch_to_ts(c) -> Column:
    """epoch seconds (number or numeric text) -> UTC wall clock as a naive timestamp; out of
    the range of timestamps -> null, as the coercing parse gives."""
    secs = _c(c).cast("string").try_cast("double")
    whole = F.floor(secs)
    micros = F.round((secs - whole) * F.lit(1_000_000)).cast("bigint")
    base = ntz_literal(_dt.datetime(1970, 1, 1))
    return _in_range(F.when(F.abs(secs) < F.lit(MOST_SECONDS), base + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0),
        (whole.cast("decimal(20,0)") + micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)"))))


def age_years(run_ts: _dt.datetime, dob) -> Column:
    """calendar years between the birth date and the run date."""
    return (F.lit(run_ts.year) - F.year(_c(dob))).cast("int")


def run_clock(run_ts: _dt.datetime | None = None) -> Column:
    """the run's clock as a naive Bangkok timestamp literal (given, or now)."""
    if run_ts is None:
        return F.convert_timezone(F.current_timezone(), F.lit(BANGKOK), F.current_timestamp().cast("timestamp_ntz"))
    return ntz_literal(run_ts)
