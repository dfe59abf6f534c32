"""Marts kept current by computing only the calendar periods that a load touched.

Every mart of ``plans.marts`` is closed under days: a row of a day depends on
that day's facts alone.  So rows that arrive late reopen their own periods of
a partitioned mart and no others.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from dialwright.sources.sinks import replace_partition


def affected_days(*increments: DataFrame, date_key: str = "date_key") -> DataFrame:
    """Days on which any of the loaded increments has rows, each once; rows without a day affect none."""
    days = [rows.select(F.col(date_key).alias("date_key")) for rows in increments]
    return reduce(DataFrame.union, days).where("date_key IS NOT NULL").distinct()


def touched_periods(days: DataFrame, affected: DataFrame, by: list[str]) -> DataFrame:
    """Periods of the calendar that hold an affected day: ``by``, first and last day key, and place in the calendar.

    ``by`` are calendar columns whose values are stretches of time, such as
    ``year`` and ``month``.  There is one row per period of the calendar, so the
    unpartitioned window sees at most as many rows as the calendar has days.
    """
    edges = days.groupBy(*by).agg(F.min("date_key").alias("first_key"), F.max("date_key").alias("last_key"))
    placed = edges.withColumn("place", F.row_number().over(Window.orderBy("first_key")))
    return placed.join(days.join(affected, "date_key", "left_semi").select(*by).distinct(), by, "left_semi")


def _stretches(periods: list[Row]) -> list[tuple[int, int]]:
    """First and last day key of each run of periods that follow each other."""
    runs: list[list[int]] = []
    last_place = None
    for period in sorted(periods, key=lambda p: p["place"]):
        if last_place is not None and period["place"] == last_place + 1:
            runs[-1][1] = period["last_key"]
        else:
            runs.append([period["first_key"], period["last_key"]])
        last_place = period["place"]
    return [tuple(run) for run in runs]


def refresh_mart(
    build: Callable[..., DataFrame],
    path: str,
    days: DataFrame,
    facts: list[DataFrame],
    affected: DataFrame,
    by: list[str] | None = None,
) -> list[dict[str, object]]:
    """Compute ``build(days, *facts)`` for the periods of the affected days and swap those into the mart.

    ``by`` (default year and month) are calendar columns that the mart has too;
    they partition its folder.  Facts are cut by ranges of ``date_key``, which
    reach their scans.  Other partitions keep their files; a period that now
    has no row is cleared.  Returns the periods that were replaced; with none
    affected nothing is read or written.  A changed dimension touches every
    day: pass the whole calendar as ``affected``.
    """
    by = by or ["year", "month"]
    periods = touched_periods(days, affected, by).collect()  # as long as the calendar at most
    if not periods:
        return []
    inside = reduce(or_, (F.col("date_key").between(*stretch) for stretch in _stretches(periods)))
    mart = build(days.filter(inside), *[fact.filter(inside) for fact in facts])
    replaced = [{column: period[column] for column in by} for period in periods]
    replace_partition(mart, path, by, runs=replaced)
    return replaced
