"""Dashboard questions over the marts."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialwright import fixed_values as fv
from dialwright.functions import measures
from dialwright.operators.reshape import heatmap


def filter_days(fact: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """The rows of a fact inside a date range, as bounds on ``date_key`` that reach its scan.

    A mart knows the date only after its calendar join; bounding the fact
    before spares reading the other days.
    """
    if first is not None:
        fact = fact.filter(F.col("date_key") >= int(first.replace("-", "")))
    if last is not None:
        fact = fact.filter(F.col("date_key") <= int(last.replace("-", "")))
    return fact


def during(fact: DataFrame, days: DataFrame) -> DataFrame:
    """The rows of a fact on the given days, usually a filtered calendar.

    Of a fact in folders by ``year`` and ``month`` only the folders of those
    days are read: Spark takes their values from the calendar's own small
    result at run time, whatever its filter was (a week, a weekday, a season).
    """
    keys = ["date_key", *(c for c in ("year", "month") if c in fact.columns)]
    return fact.join(days.select(*keys).distinct(), keys, "left_semi")


def filter_bar(
    df: DataFrame,
    day: str | None = None,
    first: str | None = None,
    last: str | None = None,
    members: dict[str, list] | None = None,
) -> DataFrame:
    """Date range and member lists, each optional.

    Conditions stay on raw columns, so they prune partitions and row groups.
    """
    conditions = []
    if first is not None:
        conditions.append(F.col(day) >= F.lit(first).cast(df.schema[day].dataType))
    if last is not None:
        conditions.append(F.col(day) <= F.lit(last).cast(df.schema[day].dataType))
    conditions += [F.col(c).isin(values) for c, values in (members or {}).items()]
    return df.filter(reduce(and_, conditions)) if conditions else df


def failure_kpis(export: DataFrame) -> DataFrame:
    """Failure readings, failure rate, mean performance ratio and days with failures."""
    failures, readings = F.sum("failure_reading_count"), F.sum("reading_count")
    return export.agg(
        failures.alias("failure_readings"),
        F.round(100.0 * failures / readings, 4).alias("failure_rate_pct"),
        F.round(100.0 * F.avg("avg_performance_ratio").cast("double"), 4).alias("avg_performance_ratio_pct"),
        F.count_distinct(F.when(F.col("failure_reading_count") > 0, F.col("full_date"))).alias("days_with_failures"),
    )


def daily_failures(export: DataFrame) -> DataFrame:
    """Failure readings per day."""
    return export.groupBy("full_date").agg(F.sum("failure_reading_count").alias("failure_readings"))


def errors_per_unit(export: DataFrame) -> DataFrame:
    """Units ranked by failure readings."""
    ranked = export.groupBy("unit_name").agg(F.sum("failure_reading_count").alias("failure_readings"))
    return ranked.orderBy(F.desc("failure_readings"), "unit_name")


def status_share(breakdown: DataFrame) -> DataFrame:
    """Share of each status category in a unit's readings; shares of a unit add to 100."""
    counts = breakdown.groupBy("unit_name", "status_category").agg(F.sum("reading_count").alias("reading_count"))
    total = F.sum("reading_count").over(Window.partitionBy("unit_name"))
    return counts.withColumn("share_pct", F.round(100.0 * F.col("reading_count") / total, 4))


def ratio_band(export: DataFrame, orange: float | None = fv.ORANGE_FROM) -> DataFrame:
    """Mean performance ratio per unit with its traffic light."""
    mean = 100.0 * F.avg("avg_performance_ratio").cast("double")
    per_unit = export.groupBy("unit_name").agg(F.round(mean, 4).alias("avg_ratio_pct"))
    return per_unit.withColumn("band", measures.band("avg_ratio_pct", orange=orange))


def occupancy_kpis(occupation: DataFrame) -> DataFrame:
    """Mean occupation, busiest weekday and number of bookings.

    Of equally busy weekdays the alphabetically first is named.
    """
    daily = occupation.groupBy("day_name").agg(
        F.sum("occupation_pct").alias("__sum"), F.count(F.lit(1)).alias("__n"), F.sum("booking_count").alias("__bookings")
    )
    mean = F.col("__sum") / F.col("__n")
    busiest = F.min_by("day_name", F.struct((-F.round(mean, 6)).alias("m"), F.col("day_name").alias("d")))
    return daily.agg(
        F.round(F.sum("__sum") / F.sum("__n"), 6).alias("occupation_rate_pct"),
        busiest.alias("peak_day"),
        F.sum("__bookings").alias("total_bookings"),
    )


def occupancy_by(occupation: DataFrame, keys: list[str]) -> DataFrame:
    """Mean occupation by weekday, by week and academic flag, or by any other keys."""
    return occupation.groupBy(*keys).agg(F.round(F.avg("occupation_pct"), 6).alias("occupation_rate_pct"))


def occupancy_trend(occupation: DataFrame, series: str = "division_code") -> DataFrame:
    """Occupation per day and division with the straight line through each division.

    The line is fitted on the daily values; its x axis counts days since
    1970-01-01.
    """
    daily = occupation.groupBy(series, "full_date").agg(F.avg("occupation_pct").alias("occupation_rate_pct"))
    x, y = F.unix_date("full_date").cast("double"), F.col("occupation_rate_pct")
    line = daily.groupBy(series).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
    return daily.join(line, series).withColumn(
        "trend_pct", F.col("slope") * F.unix_date("full_date") + F.col("intercept")
    )


def room_heatmap(slots: DataFrame, room: str, slot: str) -> DataFrame:
    """Booked slots per room and hour of day."""
    return heatmap(slots.withColumn("__hour", F.hour(slot)), room, "__hour", F.count(F.lit(1)))


def top_rooms(occupation: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` rooms with the highest mean occupation."""
    return occupancy_by(occupation, ["room_code"]).orderBy(F.desc("occupation_rate_pct"), "room_code").limit(k)


def top_days_detail(daily_by_unit: DataFrame, value: str, k: int = 10) -> DataFrame:
    """The ``k`` best days, split by unit."""
    totals = daily_by_unit.groupBy("full_date").agg(F.sum(value).alias("__total"))
    best = totals.orderBy(F.desc("__total"), "full_date").limit(k).select("full_date")
    return daily_by_unit.join(best, "full_date", "left_semi")


def incident_log(device: DataFrame, units: DataFrame, statuses: DataFrame) -> DataFrame:
    """Time, unit and fault of every failure reading.

    The order is total, so the log can be written to range-partitioned files.
    """
    faults = statuses.filter("is_failure").select("status_key", "status_label")
    failing = device.join(faults, "status_key").join(units.select("unit_key", "unit_name"), "unit_key")
    return failing.select("date_key", "time_key", "unit_name", "status_label").orderBy(
        "date_key", "time_key", "unit_name", "status_label"
    )


def temperature_correlation(production: DataFrame, environment: DataFrame, by: list[str]) -> DataFrame:
    """Correlation of production with temperature per group."""
    both = production.join(environment.select("date_key", "time_key", "temperature_c"), ["date_key", "time_key"])
    return both.groupBy(*by).agg(
        F.corr("delta_kwh", "temperature_c").alias("correlation"), F.count(F.lit(1)).alias("n_slots")
    )


def preview(df: DataFrame, order_by: list[Column | str], n: int) -> DataFrame:
    """First ``n`` rows in a given order."""
    return df.orderBy(*order_by).limit(n)
