"""Feature tables for the two forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialwright import fixed_values as fv
from dialwright.functions.calendar import add_time_features
from dialwright.operators import clean, joins, timeseries
from dialwright.operators.aggregates import bounds
from dialwright.operators.reshape import pivot_measures, time_grid

SOLAR_FEATURES = [
    "irradiance_wm2",
    "temp_c",
    "hour",
    "minute",
    "month",
    "day_of_week",
    "is_weekend",
    "quarter_hour",
]
CONSUMPTION_FEATURES = [
    "temp_c",
    "humidity_pct",
    "precipitation_kgm2",
    "room_occupation_pct",
    "hour",
    "minute",
    "month",
    "day_of_week",
    "is_weekend",
    "is_academic_day",
    "quarter_hour",
]


def weather_features(
    forecasts: DataFrame,
    names: dict[str, str] | None = None,
    step_minutes: int = 15,
    fill: str = "last",
    required: str = "irradiance_wm2",
    segments: int | None = None,
) -> DataFrame:
    """Forecasts (ts, measure, horizon, value) to one row per grid step.

    "No data" markers are dropped, the shortest horizon wins, measures become
    columns, and every column is filled onto the grid from the past.  Steps
    before the first value of ``required`` are left out.
    """
    names = names or fv.FORECAST_FEATURES
    valid = clean.drop_sentinel(forecasts, "value", fv.FORECAST_SENTINELS)
    nearest = timeseries.first_per_group(valid, ["ts", "measure"], ["horizon", "value"])
    wide = pivot_measures(nearest, ["ts"], "measure", "value", names)
    on_grid = timeseries.onto_grid(time_grid(bounds(wide, "ts"), "lo", "hi", "ts", step_minutes), wide, ["ts"])
    filled = timeseries.fill_forward(on_grid, [], "ts", list(names.values()), fill, segments=segments)
    return clean.require_not_null(filled, [required])


def target(readings: DataFrame, delta: str, name: str) -> DataFrame:
    """Training target per timestamp: missing (reset) and negative deltas are left out.

    Of several values for one timestamp the largest is kept.
    """
    valid = clean.drop_negative(clean.require_not_null(readings, ["ts", delta]), delta)
    return valid.groupBy("ts").agg(F.max(F.col(delta).cast("double")).alias(name))


def solar_features(production: DataFrame, weather: DataFrame, delta: str = "delta_kwh") -> DataFrame:
    """Eight features and the production of each slot both sources know."""
    name = "production_delta_kwh"
    joined = joins.join_on(target(production, delta, name), weather, ["ts"])
    rows = add_time_features(joined, "ts").select("ts", *SOLAR_FEATURES, name)
    return clean.require_not_null(rows, [name, "irradiance_wm2", "temp_c"])


def consumption_features(
    consumption: DataFrame, weather: DataFrame, occupation: DataFrame, delta: str = "delta_kwh"
) -> DataFrame:
    """Eleven features and the consumption of each slot; no booking means occupation 0."""
    name = "consumption_delta_kwh"
    joined = joins.join_on(target(consumption, delta, name), weather, ["ts"])
    rooms = occupation.select(F.col("slot").alias("ts"), "room_occupation_pct")
    joined = joins.join_default(joined, rooms, ["ts"], {"room_occupation_pct": 0.0})
    rows = add_time_features(joined, "ts").select("ts", *CONSUMPTION_FEATURES, name)
    return clean.require_not_null(rows, [name, "temp_c", "humidity_pct"])


def as_text_timestamp(df: DataFrame, ts: str = "ts", out: str = "timestamp") -> DataFrame:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss`` text for a CSV export."""
    others = [c for c in df.columns if c != ts]
    return df.select(F.date_format(ts, fv.PREDICTION_TIME_FORMAT).alias(out), *others)
