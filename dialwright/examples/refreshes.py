"""Marts refreshed by affected periods, counts from the write, bucketed and pruned facts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from dialwright.examples import base
from dialwright.examples import marts as _subqueries  # noqa: F401  (defines what the SQL below names)
from dialwright.examples.registry import query
from dialwright.operators import increments
from dialwright.operators.dimensions import dim_time
from dialwright.plans import marts, refresh, reports
from dialwright.session import local_frame, shared_dir
from dialwright.sources import sinks

BOOKING_KEY = ["date_key", "start_time_key", "room_key", "reservation_no"]
#: What the first load does not hold: rows of one month that arrive late, and the last months.
LATE = "date_key BETWEEN 19950301 AND 19950331 AND start_time_key < 720"
NEW = "date_key >= 20010401"


def refreshed_occupation(spark, sf_dir, path):
    """Two loads of bookings into the mart at ``path``; returns the periods that the second one replaced."""
    rows, rooms, divisions = base.booking_fact(spark, sf_dir)
    days, times = base.days_of_orders(spark, sf_dir), dim_time(spark)

    def build(calendar, bookings):
        return marts.building_occupation(calendar, rooms, bookings, divisions, times)

    first = base.stored(rows.filter(f"NOT ({LATE}) AND NOT ({NEW})"), "first-load")
    refresh.refresh_mart(build, path, days, [first], days.select("date_key"))
    added = base.stored(increments.incremental_append(rows, first, BOOKING_KEY), "second-load")
    return refresh.refresh_mart(build, path, days, [first.union(added)], refresh.affected_days(added))


@query("refresh_occupation", "SELECT * FROM {occupation}")
def refresh_occupation(spark, sf_dir):
    path = shared_dir(spark, "occupation-mart")
    refreshed_occupation(spark, sf_dir, path)
    return spark.read.parquet(path)


@query("refresh_breakdown", "SELECT * FROM {breakdown}")
def refresh_breakdown(spark, sf_dir):
    """Device readings of one unit arrive late on three days; the mart is partitioned by day."""
    rows, units, statuses = base.device(spark, sf_dir)
    days, path = base.days_of_events(spark, sf_dir), shared_dir(spark, "breakdown-mart")

    def build(calendar, readings):
        return marts.status_breakdown(readings, calendar, units, statuses)

    late = "unit_key = 2 AND date_key BETWEEN 20240105 AND 20240107 OR date_key >= 20240125"
    first, added = rows.filter(f"NOT ({late})"), rows.filter(late)
    refresh.refresh_mart(build, path, days, [first], days.select("date_key"), ["full_date"])
    refresh.refresh_mart(build, path, days, [rows], refresh.affected_days(added), ["full_date"])
    return spark.read.parquet(path)


@query(
    "refresh_balance",
    """SELECT full_date, year, month, coalesce(made, 0) AS total_production_kwh, coalesce(used, 0) AS total_consumption_kwh
       FROM {event_days}
       LEFT JOIN (SELECT date_key, sum(delta_kwh) AS made FROM {production} GROUP BY 1) USING (date_key)
       LEFT JOIN (SELECT date_key, sum(delta_kwh) AS used FROM {consumption} GROUP BY 1) USING (date_key)""",
)
def refresh_balance(spark, sf_dir):
    """Late rows of two facts: the affected days are those of either."""
    made, used = base.production(spark, sf_dir), base.consumption(spark, sf_dir)
    days, path = base.days_of_events(spark, sf_dir), shared_dir(spark, "balance-mart")
    late_made, late_used = "date_key = 20240110", "date_key BETWEEN 20240118 AND 20240119"
    early = [made.filter(f"NOT ({late_made})"), used.filter(f"NOT ({late_used})")]
    refresh.refresh_mart(marts.daily_energy_balance, path, days, early, days.select("date_key"), ["full_date"])
    affected = refresh.affected_days(made.filter(late_made), used.filter(late_used))
    refresh.refresh_mart(marts.daily_energy_balance, path, days, [made, used], affected, ["full_date"])
    columns = ["full_date", "year", "month", "total_production_kwh", "total_consumption_kwh"]
    return spark.read.parquet(path).select(*columns)


_REPORT = "table_name string, n_rows long, first_key int, last_key int, filled long"


@query(
    "counted_loads",
    """SELECT 'booking_fact' AS table_name, count(*) AS n_rows, min(date_key) AS first_key, max(date_key) AS last_key,
              count(reservation_no) AS filled FROM {booking_fact}
       UNION ALL SELECT 'device_fact', count(*), min(date_key), max(date_key), count(ac_power_w) FROM {device}
       UNION ALL SELECT 'no_rows', 0, NULL, NULL, 0""",
)
def counted_loads(spark, sf_dir):
    """The load report comes from the writes of the two facts, and of one that is empty."""
    bookings, readings = base.booking_fact(spark, sf_dir)[0], base.device(spark, sf_dir)[0]
    loads = {
        "booking_fact": (bookings, "reservation_no"),
        "device_fact": (readings, "ac_power_w"),
        "no_rows": (readings.filter("date_key < 0"), "ac_power_w"),
    }
    report = []
    for name, (rows, measure) in loads.items():
        counts = {"first_key": F.min("date_key"), "last_key": F.max("date_key"), "filled": F.count(measure)}
        seen = sinks.write_counted(rows, shared_dir(spark, name), counts, partition_by=["year", "month"])
        report.append((name, seen["n_rows"], seen["first_key"], seen["last_key"], seen["filled"]))
    return local_frame(spark, report, _REPORT)


def bucketed_slots(spark, sf_dir, buckets=8):
    """Slots of three facts that are bucketed by day and time of day."""
    tables = []
    for name in ("consumption", "production", "environment"):
        label = f"{name}_{uuid.uuid4().hex}"
        rows = getattr(base, name)(spark, sf_dir)
        tables.append(sinks.write_bucketed(rows, label, shared_dir(spark, label), ["date_key", "time_key"], buckets))
    return marts.energy_slots(*tables)


query(
    "bucketed_slots",
    """SELECT date_key, time_key, c.delta_kwh AS consumption_kwh, p.delta_kwh AS production_kwh, temperature_c, humidity_pct
       FROM {consumption} c LEFT JOIN {production} p USING (date_key, time_key)
       LEFT JOIN {environment} e USING (date_key, time_key)""",
)(bucketed_slots)


def pruned_bookings(spark, sf_dir):
    """Bookings of the twelfth week of every year since 1996, from a fact in folders by year and month."""
    rows, days = base.booking_fact(spark, sf_dir)[0], base.days_of_orders(spark, sf_dir)
    path = shared_dir(spark, "bookings-by-month")
    sinks.write_table(rows, path, partition_by=["year", "month"])
    wanted = days.filter("week_of_year = 12 AND year >= 1996")
    return reports.during(spark.read.schema(rows.schema).parquet(path), wanted)


@query(
    "pruned_by_calendar",
    """SELECT date_key, count(*) AS n_bookings, CAST(sum(duration_minutes) AS BIGINT) AS minutes
       FROM {booking_fact} JOIN {order_days} USING (date_key) WHERE week_of_year = 12 AND year >= 1996 GROUP BY 1""",
)
def pruned_by_calendar(spark, sf_dir):
    found = pruned_bookings(spark, sf_dir).groupBy("date_key")
    return found.agg(F.count(F.lit(1)).alias("n_bookings"), F.sum("duration_minutes").cast("long").alias("minutes"))
