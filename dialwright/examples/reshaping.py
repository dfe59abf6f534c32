"""Wide/long reshaping and interval expansion."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialwright.examples import base
from dialwright.examples.registry import cte, query
from dialwright.functions.keys import date_key
from dialwright.operators import reshape
from dialwright.operators.occupancy import occupancy
from dialwright.plans import reports

EVENT_TYPES = ["view", "click", "error", "signup", "purchase"]


def wide(spark, sf_dir):
    rows = base.table(spark, sf_dir, "events").select(
        "user_id", date_key("ts").alias("date_key"), "event_type", base.cents().alias("reading")
    )
    names = {t: f"{t}_mean" for t in EVENT_TYPES}
    return reshape.pivot_measures(rows, ["user_id", "date_key"], "event_type", "reading", names)


cte(
    "wide",
    "SELECT user_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, "
    + ", ".join(
        f"avg(CAST(round(value * 100) AS BIGINT)) FILTER (WHERE event_type = '{t}') AS {t}_mean" for t in EVENT_TYPES
    )
    + " FROM events GROUP BY 1, 2",
)


@query("pivot_measures", "SELECT user_id, date_key, " + ", ".join(f"round({t}_mean, 6) AS {t}_mean" for t in EVENT_TYPES) + " FROM {wide}")
def pivot_measures(spark, sf_dir):
    return wide(spark, sf_dir).withColumns({f"{t}_mean": F.round(f"{t}_mean", 6) for t in EVENT_TYPES})


@query(
    "unpivot_groups",
    " UNION ALL ".join(
        f"""SELECT l_orderkey, l_linenumber, l_partkey, {i} AS unit_id, CAST({q} AS DOUBLE) AS pac,
            CAST({s} AS INTEGER) AS status FROM lineitem"""
        for i, (q, s) in enumerate(
            [("l_quantity", "l_linenumber"), ("l_extendedprice", "l_suppkey"), ("l_discount", "l_partkey")], 1
        )
    ),
)
def unpivot_groups(spark, sf_dir):
    groups = {
        1: {"pac": "l_quantity", "status": "l_linenumber"},
        2: {"pac": "l_extendedprice", "status": "l_suppkey"},
        3: {"pac": "l_discount", "status": "l_partkey"},
    }
    return reshape.unpivot_groups(
        base.table(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber", "l_partkey"],
        "unit_id",
        groups,
        {"pac": "double", "status": "int"},
    )


def interval_bookings(spark, sf_dir):
    """Bookings with start and end as timestamps; starts are not always on a slot."""
    b = base.bookings(spark, sf_dir)

    def at(minutes):
        return F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))

    shift = F.col("booking_id") % 3 * 5
    return b.select(
        "booking_id",
        "room_no",
        at(F.col("start_time_key") + shift).alias("start_at"),
        at(F.col("end_time_key") + shift).alias("end_at"),
    )


cte(
    "interval_bookings",
    """SELECT booking_id, room_no,
       o_orderdate + to_minutes(start_time_key + booking_id % 3 * 5) AS start_at,
       o_orderdate + to_minutes(end_time_key + booking_id % 3 * 5) AS end_at FROM {bookings}""",
)
cte(
    "booking_slots",
    """SELECT booking_id, room_no, slot FROM (
         SELECT booking_id, room_no, end_at,
           unnest(generate_series(time_bucket(INTERVAL '15 minutes', start_at), end_at, INTERVAL '15 minutes')) AS slot
         FROM {interval_bookings}) WHERE slot < end_at""",
)


@query("booking_slots", "SELECT booking_id, room_no, slot FROM {booking_slots}")
def booking_slots(spark, sf_dir):
    return reshape.explode_slots(interval_bookings(spark, sf_dir), "start_at", "end_at").drop("start_at", "end_at")


@query(
    "booking_slots_inclusive",
    """SELECT booking_id, room_no, unnest(generate_series(time_bucket(INTERVAL '15 minutes', start_at),
         time_bucket(INTERVAL '15 minutes', end_at), INTERVAL '15 minutes')) AS slot FROM {interval_bookings}""",
)
def booking_slots_inclusive(spark, sf_dir):
    slots = reshape.explode_slots(interval_bookings(spark, sf_dir), "start_at", "end_at", end_inclusive=True)
    return slots.drop("start_at", "end_at")


@query(
    "occupancy_15min",
    """SELECT slot, count(DISTINCT room_no) AS rooms_occupied,
       round(count(DISTINCT room_no) / (SELECT count(DISTINCT room_no) FROM {bookings}), 6) AS room_occupation_pct
       FROM {booking_slots} GROUP BY slot""",
)
def occupancy_15min(spark, sf_dir):
    used = occupancy(interval_bookings(spark, sf_dir), "room_no", "start_at", "end_at")
    return used.withColumn("room_occupation_pct", F.round("room_occupation_pct", 6))


@query(
    "room_heatmap",
    "SELECT room_no, "
    + ", ".join(f"count(*) FILTER (WHERE hour(slot) = {h}) AS h{h:02d}" for h in range(24))
    + " FROM {booking_slots} GROUP BY room_no",
)
def room_heatmap(spark, sf_dir):
    slots = reshape.explode_slots(interval_bookings(spark, sf_dir), "start_at", "end_at")
    return reports.room_heatmap(slots, "room_no", "slot")
