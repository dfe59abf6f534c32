"""Incremental loads: watermarks and late rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from dialwright.functions.keys import key_to_date


def watermark(loaded: DataFrame, key: str = "date_key") -> Column:
    """Largest loaded day key as a scalar subquery; 0 when nothing is loaded.

    A failing read raises.  It must not look like an empty table, which would
    load everything a second time.
    """
    return loaded.agg(F.coalesce(F.max(key), F.lit(0))).scalar()


def _first_new(mark: Column, lookback_days: int, type_: DataType) -> Column:
    """Start of the first day to read; an empty table has mark 0, which is no date: take everything."""
    day = F.date_add(key_to_date(mark), 1 - lookback_days)
    return F.coalesce(day, F.lit("0001-01-01").cast("date")).cast(type_)


def after_watermark(
    src: DataFrame, ts: str, mark: DataFrame | int, lookback_days: int = 0, date_key: str = "date_key"
) -> DataFrame:
    """Rows of days after the watermark, written as a range on the raw column.

    ``mark`` is a day key, or the loaded table whose largest ``date_key`` it
    is.  ``date_key(ts) > mark`` would hide the column inside a function and
    read every row group; ``ts >= <first new day>`` reaches the Parquet reader,
    for a loaded table too: the whole bound is computed inside one scalar
    subquery of the column's type.  ``lookback_days`` reopens that many already
    loaded days for late rows.
    """
    type_ = src.schema[ts].dataType
    if isinstance(mark, int):
        return src.filter(F.col(ts) >= _first_new(F.lit(mark), lookback_days, type_))
    largest = F.coalesce(F.max(date_key), F.lit(0))
    return src.filter(F.col(ts) >= mark.agg(_first_new(largest, lookback_days, type_).alias("bound")).scalar())


def incremental_append(
    src: DataFrame,
    loaded: DataFrame,
    business_key: list[str],
    date_key: str = "date_key",
    oldest: Column | None = None,
) -> DataFrame:
    """Rows of ``src`` whose business key is not loaded yet.

    ``src`` is the already keyed increment, evaluated once.  Two NULLs in a key
    column are equal, so a row whose key holds one is not added again either.
    ``oldest`` is a bound on the increment's days, usually the watermark's: days
    before it are not looked up, and where the loaded table is partitioned by
    ``year`` and ``month`` neither are their folders.
    """
    if oldest is not None:
        loaded = loaded.filter(F.col(date_key) >= oldest)
        if {"year", "month"} <= set(loaded.columns):
            month = F.col("year") * 100 + F.col("month")
            loaded = loaded.filter(month >= F.floor(oldest / 100))
    known = loaded.select(*[F.col(c).alias(f"__{c}") for c in business_key])
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in business_key))
    return src.join(known, same, "left_anti")
