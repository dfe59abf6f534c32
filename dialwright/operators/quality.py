"""Integrity checks and load summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def fk_violations(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Fact keys without a dimension row, with the number of rows they affect.

    The fact is reduced to its distinct keys before the join.
    """
    used = fact.groupBy(fact_key).agg(F.count(F.lit(1)).alias("n_rows"))
    known = dim.select(F.col(dim_key or fact_key).alias(fact_key))
    return used.join(known, fact_key, "left_anti")


def pk_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once or contain a NULL."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return counts.filter((F.col("n_rows") > 1) | missing)


def load_summary(df: DataFrame, group: list[str], day: str, measured: dict[str, str]) -> DataFrame:
    """Rows, first and last day, and filled values (name -> column) per group."""
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        *[F.count(c).alias(name) for name, c in measured.items()],
    )


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, instead of in a second job.

    Read ``observation.get["n_rows"]`` after the write.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("n_rows")), observation


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    first, *others = counts
    for other in others:
        first = first.unionByName(other)
    return first


def freshness(df: DataFrame, day: str, today: Column | None = None, stale_after_days: int = 2) -> DataFrame:
    """Last day present, its age, and whether the data is stale."""
    now = F.current_date() if today is None else today.cast("date")
    return df.agg(F.max(day).cast("date").alias("last_day")).select(
        "last_day",
        F.date_diff(now, F.col("last_day")).alias("age_days"),
        (F.date_diff(now, F.col("last_day")) > stale_after_days).alias("is_stale"),
    )
