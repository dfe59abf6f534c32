"""Reporting marts over the star schema.

Expected columns are those of ``plans.facts`` and ``operators.dimensions``.
Every mart aggregates a fact to its grain first and joins dimensions to the
aggregate, so attributes are looked up per group rather than per reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialwright import fixed_values as fv
from dialwright.functions import measures
from dialwright.operators import joins

_DAY = ["full_date", "year", "month", "month_name"]


def status_breakdown(device: DataFrame, days: DataFrame, units: DataFrame, statuses: DataFrame) -> DataFrame:
    """Readings per day, unit and status, and their share of the unit's day."""
    counts = device.groupBy("date_key", "unit_key", "status_key").agg(F.count(F.lit(1)).alias("reading_count"))
    described = joins.star_join(
        counts,
        [
            (days, "date_key", _DAY),
            (units, "unit_key", ["unit_id", "unit_name"]),
            (statuses, "status_key", ["status_code", "status_label", "status_category", "is_failure"]),
        ],
    )
    total = F.sum("reading_count").over(Window.partitionBy("full_date", "unit_id"))
    share = (100.0 * F.col("reading_count") / total).cast("decimal(6,2)")
    return described.withColumn("pct_of_day_readings", share).drop("date_key", "unit_key", "status_key")


def unit_performance(device: DataFrame, days: DataFrame, units: DataFrame) -> DataFrame:
    """Produced over possible power per day and unit, and whether the unit failed."""
    daily = device.groupBy("date_key", "unit_key").agg(
        F.sum(F.coalesce("ac_power_w", F.lit(0.0))).alias("__power"),
        F.count(F.lit(1)).alias("__n"),
        measures.any_flag("is_failure").alias("had_failure"),
    )
    described = joins.star_join(
        daily, [(days, "date_key", ["full_date"]), (units, "unit_key", ["unit_id", "rated_kwp"])]
    )
    possible = F.col("rated_kwp").cast("double") * 1000.0 * F.col("__n")
    ratio = measures.safe_div("__power", possible).cast("decimal(28,6)")
    return described.select("unit_id", "full_date", ratio.alias("performance_ratio"), "had_failure")


def daily_energy_balance(
    days: DataFrame, production: DataFrame, consumption: DataFrame, price: str = fv.DEFAULT_PRICE_PER_KWH
) -> DataFrame:
    """Production, consumption, net, money and self-sufficiency for every calendar day.

    Each fact is summed per day before the calendar is joined; joining the raw
    facts on the day would pair every production slot with every consumption
    slot.
    """
    kwh = F.sum("delta_kwh")
    made = production.groupBy("date_key").agg(kwh.alias("__made"))
    used = consumption.groupBy("date_key").agg(kwh.alias("__used"))
    both = days.join(made, "date_key", "left").join(used, "date_key", "left")
    made, used = F.coalesce("__made", F.lit(0.0)), F.coalesce("__used", F.lit(0.0))
    rate = F.lit(price).cast("double")
    return both.select(
        *_DAY,
        "quarter",
        "is_weekend",
        "is_academic_day",
        "season",
        made.alias("total_production_kwh"),
        used.alias("total_consumption_kwh"),
        (used - made).alias("net_consumption_kwh"),
        (used * rate).alias("total_cost"),
        (made * rate).alias("total_production_value"),
        F.when(used > 0, made / used).otherwise(0.0).alias("self_sufficiency_ratio"),
    )


def building_occupation(
    days: DataFrame,
    rooms: DataFrame,
    bookings: DataFrame,
    divisions: DataFrame,
    times: DataFrame,
    minutes_per_day: int = fv.BOOKABLE_MINUTES_PER_DAY,
) -> DataFrame:
    """Booked minutes per academic day, room and division, empty rooms included.

    The room-by-day scaffold is an expansion of the room list over the
    calendar's range, thinned by an equi join with the academic days.
    """
    used = bookings.groupBy("date_key", "room_key", "division_key").agg(
        F.count(F.lit(1)).alias("booking_count"),
        F.sum("duration_minutes").alias("total_booked_minutes"),
        F.min("start_time_key").alias("__first"),
        F.max("end_time_key").alias("__last"),
    )
    span = days.agg(F.min("full_date").alias("lo"), F.max("full_date").alias("hi"))
    room_attributes = ["room_key", "room_code", "floor", "wing", "room_type"]
    scaffold = joins.scaffold_days(
        rooms.select(*room_attributes), span.select("lo").scalar(), span.select("hi").scalar(), "full_date"
    )
    day_attributes = ["date_key", *_DAY, "week_of_year", "day_name", "is_weekend", "is_academic_day"]
    academic = days.filter("is_academic_day").select(*day_attributes)
    empty = scaffold.join(academic, "full_date")
    label = times.select("time_key", "time_label")
    first = label.select(F.col("time_key").alias("__first"), F.col("time_label").alias("earliest_booking_time"))
    last = label.select(F.col("time_key").alias("__last"), F.col("time_label").alias("latest_booking_time"))
    filled = (
        empty.join(used, ["date_key", "room_key"], "left")
        .join(divisions.select("division_key", "school_name", "division_code"), "division_key", "left")
        .join(first, "__first", "left")
        .join(last, "__last", "left")
    )
    minutes = F.coalesce("total_booked_minutes", F.lit(0))
    return filled.select(
        *day_attributes[1:],
        *room_attributes[1:],
        "school_name",
        "division_code",
        F.coalesce("booking_count", F.lit(0)).alias("booking_count"),
        minutes.alias("total_booked_minutes"),
        (minutes * 100.0 / float(minutes_per_day)).alias("occupation_pct"),
        "earliest_booking_time",
        "latest_booking_time",
    )


def energy_slots(
    consumption: DataFrame, production: DataFrame, environment: DataFrame, all_slots: bool = False
) -> DataFrame:
    """Consumption, production and climate per slot.

    By default slots with production but no consumption are left out;
    ``all_slots`` brings them in.  Facts bucketed by ``date_key`` and
    ``time_key`` (``sinks.write_bucketed``) meet here without a shuffle, unless
    ``all_slots`` is set: its merged keys are no longer those of a bucket.
    """
    slot = ["date_key", "time_key"]
    used = consumption.select(*slot, F.col("delta_kwh").alias("consumption_kwh"))
    made = production.select(*slot, F.col("delta_kwh").alias("production_kwh"))
    climate = environment.select(*slot, "temperature_c", "humidity_pct")
    return used.join(made, slot, "full" if all_slots else "left").join(climate, slot, "left")


def kpi_home(
    days: DataFrame,
    consumption: DataFrame,
    production: DataFrame,
    environment: DataFrame,
    device: DataFrame,
    price: str = fv.DEFAULT_PRICE_PER_KWH,
    all_slots: bool = False,
) -> DataFrame:
    """Consumption, production, climate and daily failure rate per consumption slot.

    Days without consumption keep one row.  By default slots with production
    but no consumption are left out; ``all_slots`` brings them in.
    """
    slots = energy_slots(consumption, production, environment, all_slots)
    failing = device.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("total_readings"), F.count_if("is_failure").alias("failure_readings")
    )
    calendar = days.select("date_key", "full_date", "year", "month")
    joined = calendar.join(slots, "date_key", "left").join(failing, "date_key", "left")
    kwh = F.coalesce("consumption_kwh", F.lit(0.0))
    rate = F.col("failure_readings") * 100.0 / F.col("total_readings")
    return joined.select(
        "full_date",
        "year",
        "month",
        "time_key",
        (kwh * F.lit(price).cast("double")).alias("consumption_cost"),
        kwh.alias("consumption_kwh"),
        F.coalesce("production_kwh", F.lit(0.0)).alias("production_kwh"),
        "temperature_c",
        "humidity_pct",
        "total_readings",
        "failure_readings",
        F.when(F.col("total_readings") > 0, rate).otherwise(0.0).alias("panel_failure_rate_pct"),
    )


def weather_vs_production(
    days: DataFrame,
    production: DataFrame,
    environment: DataFrame,
    forecasts: DataFrame,
    site_key: Column,
    irradiance_key: Column,
    temperature_key: Column,
    horizon: int | None = None,
    step_minutes: int = 1,
) -> DataFrame:
    """Production beside forecast irradiance and temperature for every day and minute.

    A coarser ``step_minutes`` shows the readings at those minutes only.

    The three keys are usually ``joins.scalar_lookup`` results.  With
    ``horizon=None`` the shortest horizon that has a value is used: some
    measures have no value at horizon 0.
    """
    slot = ["date_key", "time_key"]
    wanted = forecasts.filter(
        (F.col("site_key") == site_key)
        & ((F.col("measure_key") == irradiance_key) | (F.col("measure_key") == temperature_key))
    )
    if horizon is not None:
        wanted = wanted.filter(F.col("horizon") == horizon)
    nearest = wanted.filter(~F.col("forecast_value").isin(fv.FORECAST_SENTINELS)).groupBy(*slot).agg(
        F.min_by("forecast_value", F.when(F.col("measure_key") == irradiance_key, F.col("horizon"))).alias(
            "irradiance_wm2"
        ),
        F.min_by("forecast_value", F.when(F.col("measure_key") == temperature_key, F.col("horizon"))).alias(
            "forecast_temp_c"
        ),
    )
    scaffold = joins.scaffold_minutes(days.select("date_key", "full_date", "year", "month"), step_minutes)
    made = production.select(*slot, F.col("delta_kwh").alias("actual_production_kwh"), "cumulative_kwh")
    climate = environment.select(
        *slot, F.col("temperature_c").alias("actual_indoor_temp_c"), F.col("humidity_pct").alias("actual_humidity_pct")
    )
    joined = scaffold.join(made, slot, "left").join(climate, slot, "left").join(nearest, slot, "left")
    return joined.select(
        "full_date",
        "year",
        "month",
        F.floor(F.col("time_key") / 60).cast("int").alias("hour"),
        F.floor(F.col("time_key") / 15).cast("int").alias("quarter_hour_slot"),
        "actual_production_kwh",
        "cumulative_kwh",
        "irradiance_wm2",
        "forecast_temp_c",
        "actual_indoor_temp_c",
        "actual_humidity_pct",
    )


def prediction_accuracy(predictions: DataFrame, days: DataFrame, models: DataFrame) -> DataFrame:
    """Totals and weighted absolute percentage errors per day, model and run."""
    made, used = ("predicted_production_kwh", "actual_production_kwh"), (
        "predicted_consumption_kwh",
        "actual_consumption_kwh",
    )
    grouped = predictions.groupBy("date_key", "model_key", "run_date_key").agg(
        *[F.sum(c).alias(c) for c in (*made, *used)],
        measures.wape(*made).alias("production_wape"),
        measures.wape(*used).alias("consumption_wape"),
    )
    described = joins.star_join(
        grouped, [(days, "date_key", ["full_date"]), (models, "model_key", ["model_code", "model_name"])]
    )
    return described.drop("date_key", "model_key")


def flat_export(breakdown: DataFrame, performance: DataFrame) -> DataFrame:
    """Status breakdown with the unit's daily ratio on its ``OK`` row only.

    The failure count appears on failure rows only.
    """
    daily = performance.groupBy("unit_id", "full_date").agg(
        F.round(F.avg("performance_ratio"), 4).cast("decimal(8,4)").alias("__ratio"),
        F.max("had_failure").alias("had_failure_today"),
    )
    joined = breakdown.join(daily, ["unit_id", "full_date"], "left")
    return joined.select(
        *_DAY,
        "unit_id",
        "unit_name",
        "status_code",
        "status_label",
        "status_category",
        "is_failure",
        "reading_count",
        F.when(F.col("is_failure"), F.col("reading_count")).otherwise(0).alias("failure_reading_count"),
        "pct_of_day_readings",
        F.when(F.col("status_category") == "OK", F.col("__ratio")).alias("avg_performance_ratio"),
        "had_failure_today",
    )
