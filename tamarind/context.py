"""Run parameters.  The studied system reads the wall clock; here the clock and the job
date are parameters, so that every run is repeatable."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace
from zoneinfo import ZoneInfo

BANGKOK = ZoneInfo("Asia/Bangkok")


def bangkok_now() -> _dt.datetime:
    """Current Bangkok wall clock, naive."""
    return _dt.datetime.now(tz=BANGKOK).replace(tzinfo=None)


def default_job_date(clock_utc: _dt.datetime) -> _dt.date:
    """Yesterday in UTC+7, i.e. ``clock + 7h - 1d`` of a UTC clock."""
    return (clock_utc + _dt.timedelta(hours=7) - _dt.timedelta(days=1)).date()


@dataclass(frozen=True)
class RunContext:
    """Everything a builder may depend on besides its inputs."""

    lake_root: str
    warehouse_root: str | None = None
    run_ts: _dt.datetime = field(default_factory=bangkok_now)
    year: int | None = None
    month: int | None = None
    day: int | None = None
    full: bool = False
    history_years: int = 10
    history_start_year: int | None = None
    state_root: str | None = None  # where newest-per-key sources keep their rows between runs (None: nowhere)

    @staticmethod
    def for_date(lake_root: str, job_date: _dt.date, **kw) -> "RunContext":
        return RunContext(lake_root=lake_root, year=job_date.year, month=job_date.month,
                          day=job_date.day, **kw)

    def with_date(self, job_date: _dt.date) -> "RunContext":
        return replace(self, year=job_date.year, month=job_date.month, day=job_date.day, full=False)

    def resolved(self) -> "RunContext":
        """Fill the job date with the day before the run clock (which is UTC+7 already)
        when neither a year nor full is set."""
        if self.year is None and not self.full:
            return self.with_date((self.run_ts - _dt.timedelta(days=1)).date())
        return self

    @property
    def start_year(self) -> int:
        """History starts at the job year (the run year when no job date)."""
        if self.history_start_year is not None:
            return self.history_start_year
        return self.year if self.year is not None else self.run_ts.year
