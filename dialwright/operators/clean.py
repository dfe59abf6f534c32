"""Row and column cleaning: narrow operations that never shuffle, plus de-duplication."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialwright.functions import measures


def _all(conditions: list[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def select_typed(df: DataFrame, spec: list[tuple[str, str, str]]) -> DataFrame:
    """Project ``(source, target, type)`` triples; values that do not convert become NULL."""
    return df.select(*[F.col(source).try_cast(type_).alias(target) for source, target, type_ in spec])


def require_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows that miss any of the columns."""
    return df.filter(_all([F.col(c).isNotNull() for c in cols]))


def matching(df: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Keep rows whose columns match all the given regular expressions."""
    return df.filter(_all([F.col(c).rlike(p) for c, p in patterns.items()]))


def starting_with(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Keep rows whose text starts with ``prefix`` (reaches the Parquet scan)."""
    return df.filter(F.col(col).startswith(prefix))


def one_of(df: DataFrame, col: str, values: list) -> DataFrame:
    """Keep rows whose value is in the list."""
    return df.filter(F.col(col).isin(values))


def null_sentinel(df: DataFrame, col: str, sentinels: list[float]) -> DataFrame:
    """Replace "no data" markers with NULL."""
    return df.withColumn(col, measures.null_sentinel(col, sentinels))


def drop_sentinel(df: DataFrame, col: str, sentinels: list[float]) -> DataFrame:
    """Drop rows that carry a "no data" marker or nothing at all."""
    return df.filter(~F.col(col).isin(sentinels))


def drop_negative(df: DataFrame, col: str) -> DataFrame:
    """Drop physically impossible negative quantities (and missing ones)."""
    return df.filter(F.col(col) >= 0)


def clamp_min(df: DataFrame, col: str, lowest: float = 0.0) -> DataFrame:
    """Raise values below ``lowest``; NULL stays NULL."""
    return df.withColumn(col, measures.clamp_min(col, lowest))


def zero_as_null(df: DataFrame, col: str) -> DataFrame:
    """Natural-number column where 0 means "none"."""
    return df.withColumn(col, measures.zero_as_null(col))


def flag_equals(df: DataFrame, col: str, code: object, flag: str) -> DataFrame:
    """Add a boolean that is true exactly where ``col`` equals ``code``."""
    return df.withColumn(flag, measures.flag_equals(col, code))


def with_constants(df: DataFrame, constants: dict[str, tuple[object, str]]) -> DataFrame:
    """Add constant columns ``name -> (value, type)``; a ``None`` value gives a typed NULL."""
    return df.withColumns({name: F.lit(value).cast(type_) for name, (value, type_) in constants.items()})


def dedupe_rows(df: DataFrame) -> DataFrame:
    """One copy of every fully identical row (pre-aggregated before the shuffle)."""
    return df.distinct()


def dedupe_by_key(df: DataFrame, keys: list[str], order_by: list[Column | str]) -> DataFrame:
    """One row per key: the first one in ``order_by``, which should be a total order.

    Spark plans ``row_number() = 1`` with a group limit on both sides of the
    shuffle, so a task ships at most one row per key even when a single key
    holds a large share of the rows.
    """
    order = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__nth", F.row_number().over(order)).filter(F.col("__nth") == 1).drop("__nth")


def positive_intervals(df: DataFrame, start: str, end: str) -> DataFrame:
    """Keep intervals that end after they start."""
    return df.filter(F.col(end) > F.col(start))


def split_rejects(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose look-ups all succeeded, and the others kept for inspection."""
    complete = _all([F.col(k).isNotNull() for k in keys])
    return df.filter(complete), df.filter(~complete)


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Remove columns; absent ones are ignored."""
    return df.drop(*cols)


def rename_if_present(df: DataFrame, old: str, new: str) -> DataFrame:
    """Schema migration step: rename only when ``old`` exists and ``new`` does not."""
    if old in df.columns and new not in df.columns:
        return df.withColumnRenamed(old, new)
    return df
