"""Dashboard questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialwright.examples import base, marts
from dialwright.examples.registry import query
from dialwright.plans import marts as build
from dialwright.plans import reports


@query(
    "failure_kpis",
    """SELECT CAST(sum(failure_reading_count) AS BIGINT) AS failure_readings,
       round(100.0 * sum(failure_reading_count) / sum(reading_count), 4) AS failure_rate_pct,
       round(100.0 * CAST(sum(CAST(round(avg_performance_ratio * 10000) AS BIGINT)) AS DOUBLE)
             / 10000 / count(avg_performance_ratio), 4) AS avg_performance_ratio_pct,
       count(DISTINCT CASE WHEN failure_reading_count > 0 THEN full_date END) AS days_with_failures FROM {export}""",
)
def failure_kpis(spark, sf_dir):
    return reports.failure_kpis(marts.export(spark, sf_dir))


@query(
    "daily_failures",
    "SELECT full_date, CAST(sum(failure_reading_count) AS BIGINT) AS failure_readings FROM {export} GROUP BY 1",
)
def daily_failures(spark, sf_dir):
    return reports.daily_failures(marts.export(spark, sf_dir))


@query(
    "errors_per_unit",
    "SELECT unit_name, CAST(sum(failure_reading_count) AS BIGINT) AS failure_readings FROM {export} GROUP BY 1",
)
def errors_per_unit(spark, sf_dir):
    return reports.errors_per_unit(marts.export(spark, sf_dir))


@query(
    "status_share",
    """SELECT unit_name, status_category, CAST(sum(reading_count) AS BIGINT) AS reading_count,
       round(100.0 * sum(reading_count) / sum(sum(reading_count)) OVER (PARTITION BY unit_name), 4) AS share_pct
       FROM {breakdown} GROUP BY 1, 2""",
)
def status_share(spark, sf_dir):
    return reports.status_share(marts.breakdown(spark, sf_dir))


@query(
    "ratio_band",
    """SELECT unit_name, ratio AS avg_ratio_pct,
       CASE WHEN ratio >= 85 THEN 'green' WHEN ratio >= 75 THEN 'orange' ELSE 'red' END AS band FROM (
         SELECT unit_name, round(100.0 * CAST(sum(CAST(round(avg_performance_ratio * 10000) AS BIGINT)) AS DOUBLE)
                / 10000 / count(avg_performance_ratio), 4) AS ratio FROM {export} GROUP BY 1)""",
)
def ratio_band(spark, sf_dir):
    return reports.ratio_band(marts.export(spark, sf_dir))


@query(
    "occupancy_kpis",
    """SELECT round(sum(s) / sum(n), 6) AS occupation_rate_pct, arg_min(day_name, (-round(s / n, 6), day_name)) AS peak_day,
       CAST(sum(b) AS BIGINT) AS total_bookings FROM (
         SELECT day_name, sum(total_booked_minutes) / 7.2 AS s, count(*) AS n, sum(booking_count) AS b
         FROM {occupation} GROUP BY 1)""",
)
def occupancy_kpis(spark, sf_dir):
    return reports.occupancy_kpis(marts.occupation(spark, sf_dir))


def _mean(keys: str) -> str:
    return f"SELECT {keys}, round(sum(total_booked_minutes) / 7.2 / count(*), 6) AS occupation_rate_pct FROM {{occupation}} GROUP BY ALL"


@query("occupancy_by_weekday", _mean("day_name"))
def occupancy_by_weekday(spark, sf_dir):
    return reports.occupancy_by(marts.occupation(spark, sf_dir), ["day_name"])


@query("occupancy_by_week", _mean("week_of_year, is_academic_day"))
def occupancy_by_week(spark, sf_dir):
    return reports.occupancy_by(marts.occupation(spark, sf_dir), ["week_of_year", "is_academic_day"])


@query(
    "occupancy_trend",
    """SELECT division_code, full_date, round(pct, 5) AS occupation_rate_pct,
       round(regr_slope(pct, x) OVER w, 8) AS slope, round(regr_intercept(pct, x) OVER w, 4) AS intercept,
       round(regr_slope(pct, x) OVER w * x + regr_intercept(pct, x) OVER w, 5) AS trend_pct FROM (
         SELECT division_code, full_date, sum(total_booked_minutes) / 7.2 / count(*) AS pct,
                CAST(date_diff('day', DATE '1970-01-01', CAST(full_date AS DATE)) AS DOUBLE) AS x
         FROM {occupation} WHERE division_code IS NOT NULL GROUP BY 1, 2) WINDOW w AS (PARTITION BY division_code)""",
)
def occupancy_trend(spark, sf_dir):
    trend = reports.occupancy_trend(marts.occupation(spark, sf_dir).filter("division_code IS NOT NULL"))
    return trend.select(
        "division_code",
        "full_date",
        F.round("occupation_rate_pct", 5).alias("occupation_rate_pct"),
        F.round("slope", 8).alias("slope"),
        F.round("intercept", 4).alias("intercept"),
        F.round("trend_pct", 5).alias("trend_pct"),
    )


@query("top_rooms", _mean("room_code") + " ORDER BY occupation_rate_pct DESC, room_code LIMIT 10")
def top_rooms(spark, sf_dir):
    return reports.top_rooms(marts.occupation(spark, sf_dir))


@query(
    "top_days_detail",
    """SELECT full_date, unit_id, energy FROM (
         SELECT full_date, unit_id, CAST(sum(ac_power_w) AS DOUBLE) AS energy FROM {device} JOIN {event_days} USING (date_key) GROUP BY 1, 2)
       WHERE full_date IN (SELECT full_date FROM {device} JOIN {event_days} USING (date_key) GROUP BY 1
                           ORDER BY sum(ac_power_w) DESC, full_date LIMIT 5)""",
)
def top_days_detail(spark, sf_dir):
    rows, units, _ = base.device(spark, sf_dir)
    daily = rows.groupBy("date_key", "unit_key").agg(F.sum("ac_power_w").alias("energy"))
    days = base.days_of_events(spark, sf_dir).select("date_key", "full_date")
    named = daily.join(days, "date_key").join(units.select("unit_key", "unit_id"), "unit_key")
    return reports.top_days_detail(named.select("full_date", "unit_id", "energy"), "energy", 5)


@query(
    "incident_log",
    "SELECT date_key, time_key, unit_name, status_label FROM {device} d JOIN {unit_dim} USING (unit_id) JOIN {status_dim} s USING (status_code) WHERE s.is_failure",
)
def incident_log(spark, sf_dir):
    return reports.incident_log(*base.device(spark, sf_dir))


@query(
    "temp_corr",
    """SELECT date_key, round(corr(delta_kwh, temperature_c), 6) AS correlation, count(*) AS n_slots
       FROM {production} p JOIN {environment} e USING (date_key, time_key) WHERE temperature_c IS NOT NULL
       GROUP BY 1 HAVING count(*) > 2""",
)
def temp_corr(spark, sf_dir):
    environment = base.environment(spark, sf_dir).filter("temperature_c IS NOT NULL")
    by_day = reports.temperature_correlation(base.production(spark, sf_dir), environment, ["date_key"])
    return by_day.filter("n_slots > 2").withColumn("correlation", F.round("correlation", 6))


@query(
    "filter_bar",
    "SELECT full_date, unit_name, status_category, reading_count FROM {breakdown} WHERE full_date BETWEEN '2024-01-08' AND '2024-01-14' AND unit_name IN ('INV-01', 'INV-03') AND status_category = 'Error'",
)
def filter_bar(spark, sf_dir):
    rows, units, statuses = base.device(spark, sf_dir)
    week = reports.filter_days(rows, "2024-01-08", "2024-01-14")
    kept = reports.filter_bar(
        build.status_breakdown(week, base.days_of_events(spark, sf_dir), units, statuses),
        "full_date",
        "2024-01-08",
        "2024-01-14",
        {"unit_name": ["INV-01", "INV-03"], "status_category": ["Error"]},
    )
    return kept.select("full_date", "unit_name", "status_category", "reading_count")


@query("preview", "SELECT event_id, user_id FROM events ORDER BY ts, event_id LIMIT 5")
def preview(spark, sf_dir):
    return reports.preview(base.table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), ["ts", "event_id"], 5).drop("ts")
