"""Collects the example modules."""

from __future__ import annotations

from dialwright.examples import (  # noqa: F401
    cleaning,
    dashboards,
    forecasting,
    loads,
    lookups,
    marts,
    members,
    parsing,
    raw_files,
    refreshes,
    reshaping,
    series,
    streams,
)
from dialwright.examples.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
