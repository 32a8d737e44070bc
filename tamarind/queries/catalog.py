"""Every driver query and its oracle, in one place."""

from __future__ import annotations

from tamarind.queries import builders, jobs, loads, operators


def all_queries() -> dict:
    return operators.QUERIES | builders.QUERIES | jobs.QUERIES | loads.QUERIES


def all_oracles() -> dict:
    return operators.ORACLES | builders.ORACLES | jobs.ORACLES | loads.ORACLES
