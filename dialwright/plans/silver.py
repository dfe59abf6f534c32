"""Raw files to typed, de-duplicated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialwright import fixed_values as fv
from dialwright.functions.text import first_number, parse_timestamp, pseudonym, with_timestamp
from dialwright.operators import aggregates, clean, timeseries
from dialwright.operators.reshape import unpivot_groups
from dialwright.sources import readers

_DEVICE_TYPES = {
    "pac": "double",
    "daysum": "double",
    "status": "int",
    "pdc1": "double",
    "pdc2": "double",
    "udc1": "double",
    "udc2": "double",
}


def device_log_names(units: int = fv.DEVICE_LOG_UNITS) -> list[str]:
    """Positional column names of the wide device log."""
    return readers.repeated_group_names(["date_raw", "time_raw"], fv.DEVICE_LOG_GROUP, units)


def device_readings(raw: DataFrame, units: int = fv.DEVICE_LOG_UNITS) -> DataFrame:
    """Wide device log (all text) to one typed row per timestamp and unit.

    Dates may be ISO or dotted; the clock is used as it stands, so no spurious
    date can leak in from it.
    """
    present = clean.require_not_null(raw, ["date_raw", "time_raw"])
    stamped = with_timestamp(present, "date_raw", "time_raw", "log_timestamp")
    groups = {u: {m: f"{m}_{u}" for m in _DEVICE_TYPES} for u in range(1, units + 1)}
    long = unpivot_groups(stamped, ["log_timestamp"], "unit_id", groups, _DEVICE_TYPES)
    flagged = clean.flag_equals(long, "status", fv.FAILURE_STATUS_CODE, "is_failure")
    renamed = flagged.withColumnsRenamed({"pac": "ac_power_w", "status": "status_code"})
    return clean.dedupe_rows(clean.require_not_null(renamed, ["log_timestamp"]))


def sensor_readings(raw: DataFrame, value_col: str, delta_col: str) -> DataFrame:
    """Sensor export cells to (ts, value, delta); junk lines are dropped."""
    kept = clean.matching(raw, {"date_raw": fv.SENSOR_DATE_PATTERN, "time_raw": fv.SENSOR_TIME_PATTERN})
    typed = with_timestamp(kept, "date_raw", "time_raw", "ts").select(
        "ts",
        first_number(value_col).alias(value_col),
        first_number(delta_col).alias(delta_col),
    )
    return clean.dedupe_rows(clean.require_not_null(typed, ["ts"]))


def meter_readings(
    raw: DataFrame, value_col: str, delta_col: str, series: list[str] | None = None, **window: object
) -> DataFrame:
    """Cumulative meter with a recomputed, reset-aware delta."""
    typed = sensor_readings(raw, value_col, delta_col).drop(delta_col)
    return timeseries.meter_delta(typed, series or [], "ts", value_col, delta_col, tie=[value_col], **window)


def instant_readings(
    raw: DataFrame, value_col: str, delta_col: str, series: list[str] | None = None, **window: object
) -> DataFrame:
    """Instantaneous sensor; its exported variation is a copy of the value and is replaced."""
    typed = sensor_readings(raw, value_col, delta_col).drop(delta_col)
    return timeseries.sensor_delta(typed, series or [], "ts", value_col, delta_col, tie=[value_col], **window)


def synthetic_forecast(raw: DataFrame, members: list[str], name: str) -> DataFrame:
    """Forecasts of a virtual site; the same step serves past and future files."""
    mean = aggregates.synthesize(
        raw, members, name, "Site", ["Time", "Measurement", "Prediction", "Unit"], "Value", fv.FORECAST_SENTINELS
    )
    return clean.require_not_null(mean, ["Time"])


def read_bookings(spark: SparkSession, path: str) -> DataFrame:
    """Booking export with its repeated headers named by meaning."""
    return readers.read_tsv_unquoted(spark, path, meanings=fv.BOOKING_REPEATED_HEADERS)


def masked_bookings(
    raw: DataFrame, room: str, prefix: str, people: dict[str, str], salt: str | None = None
) -> DataFrame:
    """Bookings of one building with person columns replaced by hashes.

    ``people`` maps each person column to the name of its hash column.
    """
    unquoted = raw.withColumn(room, F.translate(room, '"', ""))
    inside = clean.starting_with(unquoted, room, prefix)
    masked = inside.withColumns({out: pseudonym(src, salt) for src, out in people.items()})
    return clean.dedupe_rows(clean.drop_columns(masked, list(people)))


def predictions(raw: DataFrame, value: str) -> DataFrame:
    """Prediction file to (ts, value): parsed, non-negative, one row per timestamp.

    Of several values for one timestamp the largest is kept, so that a re-run
    keeps the same one.
    """
    readers.require_columns(raw, ["timestamp", value], "predictions")
    typed = raw.select(
        parse_timestamp(F.col("timestamp"), [fv.PREDICTION_TIME_FORMAT]).alias("ts"),
        F.col(value).try_cast("double").alias(value),
    )
    clamped = clean.clamp_min(clean.require_not_null(typed, ["ts"]), value)
    return clamped.groupBy("ts").agg(F.max(value).alias(value))
