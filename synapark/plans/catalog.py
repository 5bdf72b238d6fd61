"""Registered queries of the engine and their DuckDB equivalents."""

from __future__ import annotations

from . import queries_aggregate, queries_influence, queries_interval, queries_relational, queries_series, queries_signal, queries_statistics, queries_trials, queries_units, queries_window  # noqa: F401  they register themselves
from .registry import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLES)
