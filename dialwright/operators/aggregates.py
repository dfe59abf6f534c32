"""Grouped aggregates.  All of them combine on the map side before shuffling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialwright.functions import measures


def synthesize(
    df: DataFrame, members: list[str], name: str, site: str, keys: list[str], value: str, sentinels: list[float]
) -> DataFrame:
    """Virtual station: mean over its member stations, "no data" markers left out first."""
    cleaned = df.filter(F.col(site).isin(members)).withColumn(value, measures.null_sentinel(value, sentinels))
    return cleaned.groupBy(*keys).agg(F.avg(value).alias(value)).withColumn(site, F.lit(name))


def count_distinct(df: DataFrame, keys: list[str], col: str, out: str) -> DataFrame:
    """Distinct values per group."""
    return df.groupBy(*keys).agg(F.count_distinct(col).alias(out))


def n_distinct(df: DataFrame, col: str) -> Column:
    """Distinct values overall, as a scalar subquery for use as a denominator."""
    return df.agg(F.count_distinct(col)).scalar()


def bounds(df: DataFrame, ts: str, by: list[str] | None = None, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Earliest and latest timestamp, overall or per series."""
    return df.groupBy(*(by or [])).agg(F.min(ts).alias(lo), F.max(ts).alias(hi))


def share_of_group(df: DataFrame, group: list[str], item: list[str], n: str, pct: str) -> DataFrame:
    """Row count per item and its percentage of the group.

    The window runs over the counts, not over the rows.
    """
    counts = df.groupBy(*group, *item).agg(F.count(F.lit(1)).alias(n))
    total = F.sum(n).over(Window.partitionBy(*group))
    return counts.withColumn(pct, (100.0 * F.col(n) / total).cast("decimal(6,2)"))


def count_if(df: DataFrame, keys: list[str], conditions: dict[str, Column]) -> DataFrame:
    """Rows per group that meet each condition."""
    return df.groupBy(*keys).agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def earliest_latest(df: DataFrame, keys: list[str], first: str, last: str) -> DataFrame:
    """Smallest ``first`` and largest ``last`` per group."""
    return df.groupBy(*keys).agg(F.min(first).alias(first), F.max(last).alias(last))


def days_with(df: DataFrame, condition: Column, day: str, out: str) -> DataFrame:
    """Number of distinct days on which the condition held."""
    return df.agg(F.count_distinct(F.when(condition, F.col(day))).alias(out))
