"""Deltas, gap filling, as-of alignment and best-row selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialwright.examples import base
from dialwright.examples.registry import cte, query
from dialwright.functions.keys import date_key, floor_minutes
from dialwright.operators import aggregates, scans, timeseries
from dialwright.operators.reshape import time_grid


def user_readings(spark, sf_dir):
    return base.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", base.cents().alias("reading"))


cte("user_readings", "SELECT event_id, user_id, ts, CAST(round(value * 100) AS BIGINT) AS reading FROM events")

METER_SQL = """SELECT event_id, user_id, reading,
       CASE WHEN reading >= lag(reading) OVER w THEN reading - lag(reading) OVER w END AS delta
       FROM {user_readings} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""


@query("meter_delta", METER_SQL)
def meter_delta(spark, sf_dir):
    rows = user_readings(spark, sf_dir)
    return timeseries.meter_delta(rows, ["user_id"], "ts", "reading", tie=["event_id"]).drop("ts")


HOT_SEGMENTS = 24

cte(
    "hot_readings",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS series,
       CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-10 12:00:00' + to_seconds(event_id // 3 % 3600) ELSE ts END AS ts,
       reading FROM {user_readings}""",
)


@query(
    "hot_series_delta",
    """SELECT event_id, CASE WHEN reading >= lag(reading) OVER w THEN reading - lag(reading) OVER w END AS delta,
       last_value(CASE WHEN reading % 3 <> 0 THEN reading END IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS carried,
       true AS balanced
       FROM {hot_readings} WINDOW w AS (PARTITION BY series ORDER BY ts, event_id)""",
)
def hot_series_delta(spark, sf_dir):
    """A third of all readings in one series inside one hour; no segment holds three times the median."""
    hot = F.col("event_id") % 3 == 0
    second = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.floor(F.col("event_id") / 3) % 3600)
    rows = user_readings(spark, sf_dir).select(
        "event_id",
        F.when(hot, F.lit(0)).otherwise(F.col("user_id")).alias("series"),
        F.when(hot, F.lit("2024-01-10 12:00:00").cast("timestamp_ntz") + second).otherwise(F.col("ts")).alias("ts"),
        "reading",
        F.when(F.col("reading") % 3 != 0, F.col("reading")).alias("carried"),
    )
    sizes = scans.segmented(rows, ["series"], ["ts", "event_id"], HOT_SEGMENTS).groupBy(scans.SEGMENT).count()
    balanced = sizes.agg(F.max("count") <= 3 * F.median("count")).scalar()
    filled = timeseries.fill_forward(rows, ["series"], "ts", ["carried"], tie=["event_id"], segments=HOT_SEGMENTS)
    delta = timeseries.meter_delta(filled, ["series"], "ts", "reading", tie=["event_id"], segments=HOT_SEGMENTS)
    return delta.select("event_id", "delta", "carried", balanced.alias("balanced"))


@query(
    "meter_delta_single_series",
    """SELECT event_id, reading,
       CASE WHEN reading >= lag(reading) OVER w THEN reading - lag(reading) OVER w END AS delta
       FROM {user_readings} WINDOW w AS (ORDER BY ts, event_id)""",
)
def meter_delta_single_series(spark, sf_dir):
    rows = user_readings(spark, sf_dir).drop("user_id")
    return timeseries.meter_delta(rows, [], "ts", "reading", tie=["event_id"]).drop("ts")


@query(
    "sensor_delta",
    """SELECT event_id, user_id, reading, reading - lag(reading) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS delta
       FROM {user_readings}""",
)
def sensor_delta(spark, sf_dir):
    rows = user_readings(spark, sf_dir)
    return timeseries.sensor_delta(rows, ["user_id"], "ts", "reading", tie=["event_id"]).drop("ts")


def gappy_hours(spark, sf_dir):
    """Hourly grid per user with the reading of the hour, a third of them missing."""
    rows = user_readings(spark, sf_dir)
    hourly = rows.groupBy("user_id", floor_minutes("ts", 60).alias("ts")).agg(F.sum("reading").alias("reading"))
    hourly = hourly.withColumn("reading", F.when(F.col("reading") % 3 != 0, F.col("reading")))
    grid = time_grid(aggregates.bounds(hourly, "ts", ["user_id"]), "lo", "hi", "ts", 60)
    return timeseries.onto_grid(grid, hourly, ["user_id", "ts"])


cte(
    "hourly",
    """SELECT user_id, time_bucket(INTERVAL '1 hour', ts) AS ts,
       CASE WHEN sum(reading) % 3 <> 0 THEN CAST(sum(reading) AS BIGINT) END AS reading FROM {user_readings} GROUP BY 1, 2""",
)
cte(
    "gappy_hours",
    """SELECT user_id, ts, reading FROM (
         SELECT user_id, unnest(generate_series(min(ts), max(ts), INTERVAL '1 hour')) AS ts FROM {hourly} GROUP BY user_id)
       LEFT JOIN {hourly} USING (user_id, ts)""",
)


@query("time_grid", "SELECT user_id, ts, reading FROM {gappy_hours}")
def time_grid_query(spark, sf_dir):
    return gappy_hours(spark, sf_dir)


@query(
    "fill_forward",
    """SELECT user_id, ts, last_value(reading IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reading FROM {gappy_hours}""",
)
def fill_forward(spark, sf_dir):
    return timeseries.fill_forward(gappy_hours(spark, sf_dir), ["user_id"], "ts", ["reading"])


@query(
    "running_mean_fill",
    """SELECT user_id, ts, round(avg(reading) OVER (PARTITION BY user_id ORDER BY ts
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS reading FROM {gappy_hours}""",
)
def running_mean_fill(spark, sf_dir):
    filled = timeseries.fill_forward(gappy_hours(spark, sf_dir), ["user_id"], "ts", ["reading"], "running_mean")
    return filled.withColumn("reading", F.round("reading", 6))


def _by_unit(spark, sf_dir, event_type):
    events = base.table(spark, sf_dir, "events").filter(F.col("event_type") == event_type)
    return events.select((F.col("user_id") % 5 + 1).alias("unit_id"), "ts", "event_id", base.cents().alias("reading"))


def _asof_sql(keep: str) -> str:
    return f"""SELECT l.event_id, l.unit_id, {keep} AS temperature FROM (
         SELECT event_id, user_id % 5 + 1 AS unit_id, ts FROM events WHERE event_type = 'click') l
       ASOF LEFT JOIN (
         SELECT user_id % 5 + 1 AS unit_id, ts, CAST(round(value * 100) AS BIGINT) AS reading
         FROM events WHERE event_type = 'view') r
       ON l.unit_id = r.unit_id AND l.ts >= r.ts"""


def _asof(spark, sf_dir, **kwargs):
    left = _by_unit(spark, sf_dir, "click").select("event_id", "unit_id", "ts")
    right = _by_unit(spark, sf_dir, "view").withColumnRenamed("reading", "temperature")
    joined = timeseries.asof_join(left, right, ["unit_id"], "ts", ["temperature"], right_tie=["event_id"], **kwargs)
    return joined.drop("ts")


@query("asof_weather", _asof_sql("r.reading"))
def asof_weather(spark, sf_dir):
    return _asof(spark, sf_dir)


@query("asof_weather_tolerance", _asof_sql("CASE WHEN l.ts - r.ts <= INTERVAL 30 MINUTE THEN r.reading END"))
def asof_weather_tolerance(spark, sf_dir):
    return _asof(spark, sf_dir, tolerance_minutes=30)


@query(
    "best_horizon",
    """SELECT event_id, user_id, event_type, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id) = 1""",
)
def best_horizon(spark, sf_dir):
    events = base.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "ts", date_key("ts").alias("date_key")
    )
    return timeseries.first_per_group(events, ["user_id", "event_type", "date_key"], ["ts", "event_id"]).drop("ts")


@query(
    "share_of_group",
    """SELECT user_id, event_type, count(*) AS n,
       CAST(round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY user_id), 2) AS DOUBLE) AS pct
       FROM events GROUP BY user_id, event_type""",
)
def share_of_group(spark, sf_dir):
    events = base.table(spark, sf_dir, "events")
    return aggregates.share_of_group(events, ["user_id"], ["event_type"], "n", "pct")
