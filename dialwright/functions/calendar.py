"""Calendar attributes of a timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialwright.functions.keys import _col


def is_weekend(ts: Column | str) -> Column:
    """1 on Saturday and Sunday, else 0."""
    return F.dayofweek(_col(ts)).isin(1, 7).cast("int")


def quarter_hour(ts: Column | str) -> Column:
    """Index of the 15-minute slot in the day (0-95)."""
    ts = _col(ts)
    return (F.hour(ts) * 4 + F.floor(F.minute(ts) / 15)).cast("int")


def day_before(day: Column | str) -> Column:
    """The day a validity that is replaced on ``day`` ends."""
    return F.date_sub(_col(day), 1)


def add_time_features(df: DataFrame, ts: str) -> DataFrame:
    """hour, minute, month, day_of_week (1 = Sunday), is_weekend, is_academic_day, quarter_hour."""
    weekend = is_weekend(ts)
    return df.withColumns(
        {
            "hour": F.hour(ts),
            "minute": F.minute(ts),
            "month": F.month(ts),
            "day_of_week": F.dayofweek(ts),
            "is_weekend": weekend,
            "is_academic_day": 1 - weekend,
            "quarter_hour": quarter_hour(ts),
        }
    )
