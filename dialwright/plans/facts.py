"""Fact rows: keys looked up, values typed, one row per business key.

Each builder returns ``(rows, rejects)``: rejects failed a look-up and are
kept for inspection.  Columns ``year`` and ``month`` are the partition columns
of the stored facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialwright import fixed_values as fv
from dialwright.functions.keys import date_key, key_to_date, minutes_of_clock, time_key
from dialwright.functions.measures import priced, recurring, zero_as_null
from dialwright.functions.text import computed_once, month_text_date
from dialwright.operators import clean, joins
from dialwright.operators.increments import after_watermark, incremental_append


def stamped(df: DataFrame, ts: str) -> DataFrame:
    """Add date_key, time_key, year and month of a timestamp."""
    return df.withColumns(
        {"date_key": date_key(ts), "time_key": time_key(ts), "year": F.year(ts), "month": F.month(ts)}
    )


def device_fact(readings: DataFrame, units: DataFrame, statuses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Device readings per minute and unit; unknown statuses get the unknown member."""
    keyed = joins.lookup_key(stamped(readings, "log_timestamp"), units, {"unit_id": "unit_id"}, ["unit_key"])
    keyed = joins.lookup_key(
        keyed, statuses, {"status_code": "status_code"}, ["status_key"], {"status_key": fv.UNKNOWN_STATUS_KEY}
    )
    typed = clean.select_typed(
        keyed,
        [
            ("date_key", "date_key", "int"),
            ("time_key", "time_key", "int"),
            ("unit_key", "unit_key", "bigint"),
            ("status_key", "status_key", "bigint"),
            ("ac_power_w", "ac_power_w", "double"),
            ("daysum", "day_energy_kwh", "double"),
            ("pdc1", "dc_power1_w", "double"),
            ("pdc2", "dc_power2_w", "double"),
            ("udc1", "dc_voltage1_v", "double"),
            ("udc2", "dc_voltage2_v", "double"),
            ("is_failure", "is_failure", "boolean"),
            ("year", "year", "int"),
            ("month", "month", "int"),
            ("log_timestamp", "log_timestamp", "timestamp_ntz"),
            ("unit_id", "unit_id", "int"),
        ],
    )
    good, rejects = clean.split_rejects(typed, ["unit_key"])
    order = ["log_timestamp", "status_key", "ac_power_w", "day_energy_kwh"]
    rows = clean.dedupe_by_key(good, ["date_key", "time_key", "unit_key"], order)
    return rows.drop("log_timestamp", "unit_id"), rejects


def meter_fact(
    readings: DataFrame, cumulative: str, delta: str, money: str, price: str | Column = fv.DEFAULT_PRICE_PER_KWH
) -> DataFrame:
    """Production or consumption per minute, with its money value."""
    rows = stamped(readings, "ts").select(
        "date_key",
        "time_key",
        F.col(cumulative).try_cast("double").alias("cumulative_kwh"),
        F.col(delta).try_cast("double").alias("delta_kwh"),
        "year",
        "month",
        "ts",
    )
    unique = clean.dedupe_by_key(rows, ["date_key", "time_key"], ["ts", "cumulative_kwh", "delta_kwh"])
    return unique.drop("ts").withColumn(money, priced("delta_kwh", price))


def environment_fact(temperature: DataFrame, humidity: DataFrame) -> DataFrame:
    """Temperature and humidity side by side; neither loses a reading to the other."""
    warm = temperature.select("ts", F.col("actual_temp").alias("temperature_c"), F.col("temp_delta").alias("temp_variation_c"))
    damp = humidity.select(
        "ts", F.col("actual_humidity").alias("humidity_pct"), F.col("humidity_delta").alias("humidity_variation_pct")
    )
    both = stamped(joins.align_outer(warm, damp, ["ts"]), "ts")
    unique = clean.dedupe_by_key(both, ["date_key", "time_key"], ["ts", "temperature_c", "humidity_pct"])
    return unique.select(
        "date_key",
        "time_key",
        "temperature_c",
        "temp_variation_c",
        "humidity_pct",
        "humidity_variation_pct",
        "year",
        "month",
    )


def forecast_fact(forecasts: DataFrame, sites: DataFrame, measures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Forecast values per site, measure and horizon (text ``'00'`` to a number)."""
    typed = stamped(forecasts.withColumn("ts", F.col("Time").cast("timestamp_ntz")), "ts")
    keyed = joins.lookup_key(typed, sites, {"Site": "site_name"}, ["site_key"], trim=True)
    keyed = joins.lookup_key(keyed, measures, {"Measurement": "measure_code"}, ["measure_key"], trim=True)
    rows = keyed.select(
        "date_key",
        "time_key",
        "site_key",
        "measure_key",
        F.col("Prediction").try_cast("int").alias("horizon"),
        F.col("Value").try_cast("double").alias("forecast_value"),
        "year",
        "month",
        "ts",
        "Site",
        "Measurement",
    )
    good, rejects = clean.split_rejects(rows, ["site_key", "measure_key"])
    key = ["date_key", "time_key", "site_key", "measure_key", "horizon"]
    unique = clean.dedupe_by_key(good, key, ["ts", "forecast_value"])
    return unique.drop("ts", "Site", "Measurement"), rejects


def booking_fact(
    bookings: DataFrame,
    rooms: DataFrame,
    divisions: DataFrame,
    columns: dict[str, str],
    months: dict[str, int] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Bookings with parsed dates, clock keys, duration and recurrence.

    ``columns`` maps the target names (room, division, day, start, end,
    recurrence_start, recurrence_end, reservation_no, and any descriptive
    column) to source columns.  Rows on impossible dates are dropped.
    """
    special = {"room", "division", "day", "start", "end", "recurrence_start", "recurrence_end", "reservation_no"}
    described = [c for c in columns if c not in special]
    src = {name: F.col(f"`{source}`") for name, source in columns.items()}
    raw = bookings.select(*[src[c].alias(c) for c in columns])
    parsed = computed_once(
        raw,
        {
            "booked_on": month_text_date("day", months),
            "start_time_key": minutes_of_clock("start"),
            "end_time_key": minutes_of_clock("end"),
            "recurs_from": month_text_date("recurrence_start", months),
            "recurs_to": month_text_date("recurrence_end", months),
        },
    )
    dated = clean.require_not_null(parsed, ["booked_on"]).select(
        F.col("room").alias("room_code"),
        F.col("division").alias("division_name"),
        date_key("booked_on").alias("date_key"),
        F.year("booked_on").alias("year"),
        F.month("booked_on").alias("month"),
        "start_time_key",
        "end_time_key",
        (F.col("end_time_key") - F.col("start_time_key")).alias("duration_minutes"),
        zero_as_null("reservation_no").alias("reservation_no"),
        F.col("recurs_from").alias("recurrence_start"),
        F.col("recurs_to").alias("recurrence_end"),
        recurring("recurs_from", "recurs_to").alias("is_recurring"),
        *[F.col(c).cast("string").alias(c) for c in described],
    )
    keyed = joins.lookup_key(dated, rooms, {"room_code": "room_code"}, ["room_key"], trim=True)
    keyed = joins.lookup_key(keyed, divisions, {"division_name": "division_name"}, ["division_key"], trim=True)
    good, rejects = clean.split_rejects(keyed, ["room_key", "division_key"])
    key = ["date_key", "start_time_key", "room_key", "reservation_no"]
    order = ["end_time_key", "division_name", "recurrence_start", "recurrence_end", *described]
    return clean.dedupe_by_key(good, key, order).drop("room_code", "division_name"), rejects


def prediction_fact(
    kinds: list[tuple[DataFrame, str, str]], models: DataFrame, run_date_key: int, unknown: str = "raise"
) -> tuple[DataFrame, DataFrame]:
    """Predictions of several models in one table.

    Each kind is ``(predictions, model code, target column)`` where the
    predictions have ``ts`` and ``value``.  Columns of the other kinds are NULL,
    and so are the actuals until they are back-filled.  A code that ``models``
    lacks stops the load before anything is read; ``unknown="reject"`` returns
    its rows as rejects instead.
    """
    if unknown not in ("raise", "reject"):
        raise ValueError(f"unknown setting {unknown!r}: use 'raise' or 'reject'")
    if unknown == "raise":
        codes = {code for _, code, _ in kinds}
        # As many rows as there are codes at most.
        known = models.filter(F.col("model_code").isin(*codes)).select("model_code").distinct().collect()
        if missing := codes - {r["model_code"] for r in known}:
            raise LookupError(f"no model with code {', '.join(sorted(missing))}; load the models first")
    parts = [
        stamped(df, "ts").select(
            "date_key", "time_key", F.lit(code).alias("model_code"), F.col("value").cast("double").alias(target), "ts"
        )
        for df, code, target in kinds
    ]
    targets = sorted({target for _, _, target in kinds})
    keyed = joins.lookup_key(joins.union_kinds(parts), models, {"model_code": "model_code"}, ["model_key"])
    good, rejects = clean.split_rejects(keyed, ["model_key"])
    key = ["date_key", "time_key", "model_key"]
    unique = clean.dedupe_by_key(good, key, ["ts", *targets]).drop("ts", "model_code")
    actuals = {t.replace("predicted", "actual"): (None, "double") for t in targets}
    rows = clean.with_constants(unique, {"run_date_key": (run_date_key, "int"), **actuals})
    return rows.select(*key, "run_date_key", *targets, *actuals), rejects


def backfill_actuals(
    predictions: DataFrame, production: DataFrame, consumption: DataFrame, only: Column | None = None
) -> DataFrame:
    """Fill both actual columns for all dates at once."""
    on = ["date_key", "time_key"]
    filled = joins.backfill(predictions, production, on, {"actual_production_kwh": "delta_kwh"}, only)
    return joins.backfill(filled, consumption, on, {"actual_consumption_kwh": "delta_kwh"}, only)


def load_increment(
    silver: DataFrame, ts: str, loaded: DataFrame, business_key: list[str], build, lookback_days: int = 0
) -> DataFrame:
    """Rows to append to a fact: after the watermark, built, and not yet loaded.

    ``build`` turns silver rows into fact rows.  With ``lookback_days`` late
    rows of loaded days are found as well; the key check keeps it idempotent.
    """
    fresh = build(after_watermark(silver, ts, loaded, lookback_days))
    reopened = F.date_add(key_to_date(F.coalesce(F.max("date_key"), F.lit(0))), 1 - lookback_days)
    oldest = loaded.agg(F.coalesce(date_key(reopened), F.lit(0)).alias("oldest")).scalar()
    return incremental_append(fresh, loaded, business_key, oldest=oldest)
