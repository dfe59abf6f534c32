"""Text and scalar functions on text derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialwright.examples import base
from dialwright.examples.registry import query
from dialwright.functions import calendar, keys, measures, text
from dialwright.sources.readers import json_rows


@query(
    "french_dates",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders""",
)
def french_dates(spark, sf_dir):
    """Every tenth text names an impossible day and gives NULL."""
    good = base.french_day("o_orderdate")
    bad = F.concat(F.lit("31 févr. "), F.year("o_orderdate").cast("string"))
    raw = F.when(F.col("o_orderkey") % 10 != 0, good).otherwise(bad)
    return base.table(spark, sf_dir, "orders").select("o_orderkey", text.month_text_date(raw).alias("day"))


@query(
    "sensor_timestamps",
    """SELECT event_id, date_trunc(CASE WHEN event_id % 3 = 0 THEN 'minute' ELSE 'second' END, ts) AS parsed FROM events""",
)
def sensor_timestamps(spark, sf_dir):
    """Two- and four-digit years, with and without seconds."""
    day = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "dd.MM.yyyy")).otherwise(F.date_format("ts", "dd.MM.yy"))
    clock = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "HH:mm")).otherwise(F.date_format("ts", "HH:mm:ss"))
    noisy = F.concat(F.lit('"'), day, F.lit(' "'))
    rows = base.table(spark, sf_dir, "events").select("event_id", noisy.alias("day"), clock.alias("clock"))
    return text.with_timestamp(rows, "day", "clock", "parsed").select("event_id", "parsed")


@query(
    "first_number",
    """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 2 = 0 THEN -value ELSE value END AS number FROM events""",
)
def first_number(spark, sf_dir):
    sign = F.when(F.col("event_id") % 2 == 0, "-").otherwise("")
    good = F.concat(F.lit("ca. "), sign, F.col("value").cast("decimal(12,2)").cast("string"), F.lit(" kWh"))
    raw = F.when(F.col("event_id") % 7 == 0, F.lit("n/a")).otherwise(good)
    return base.table(spark, sf_dir, "events").select("event_id", text.first_number(raw).alias("number"))


@query("strip_noise", "SELECT c_custkey, c_name FROM customer")
def strip_noise(spark, sf_dir):
    noisy = F.concat(F.lit('\u0000"'), F.col("c_name"), F.lit('"\u0000\r'))
    return base.table(spark, sf_dir, "customer").select("c_custkey", text.strip_noise(noisy).alias("c_name"))


@query(
    "clock_minutes",
    "SELECT booking_id, CASE WHEN booking_id % 9 <> 0 THEN start_time_key END AS minutes FROM {bookings}",
)
def clock_minutes(spark, sf_dir):
    label = base.clock_text("start_time_key")
    short = F.regexp_replace(label, "^0", "")
    raw = F.when(F.col("booking_id") % 9 == 0, F.lit("later")).when(F.col("booking_id") % 2 == 0, short).otherwise(label)
    return base.bookings(spark, sf_dir).select("booking_id", keys.minutes_of_clock(raw).alias("minutes"))


@query(
    "booking_timestamps",
    "SELECT booking_id, o_orderdate + to_minutes(start_time_key) AS start_at, CAST(duration_minutes AS INTEGER) AS duration FROM {bookings}",
)
def booking_timestamps(spark, sf_dir):
    b = base.bookings(spark, sf_dir)
    return b.select(
        "booking_id",
        text.at_clock("day", base.clock_text("start_time_key")).alias("start_at"),
        (F.col("end_time_key") - F.col("start_time_key")).alias("duration"),
    )


@query("clock_on_day", "SELECT event_id, TIMESTAMP '2023-02-20' + (ts - date_trunc('day', ts)) AS moved FROM events")
def clock_on_day(spark, sf_dir):
    day = F.lit("2023-02-20").cast("date")
    return base.table(spark, sf_dir, "events").select("event_id", text.on_day(day, "ts").alias("moved"))


@query(
    "date_keys",
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CAST(CAST(o_orderdate AS DATE) - 1 AS VARCHAR) AS day_before FROM orders""",
)
def date_keys(spark, sf_dir):
    key = keys.date_key("o_orderdate")
    day = keys.key_to_date(key)
    return base.table(spark, sf_dir, "orders").select(
        "o_orderkey", key.alias("date_key"), day.alias("day"), calendar.day_before(day).alias("day_before")
    )


@query(
    "time_features",
    """SELECT event_id, hour(ts) AS hour, minute(ts) AS minute, month(ts) AS month, dayofweek(ts) + 1 AS day_of_week,
       CAST(dayofweek(ts) IN (0, 6) AS INTEGER) AS is_weekend, CAST(dayofweek(ts) NOT IN (0, 6) AS INTEGER) AS is_academic_day,
       hour(ts) * 4 + minute(ts) // 15 AS quarter_hour FROM events""",
)
def time_features(spark, sf_dir):
    return calendar.add_time_features(base.table(spark, sf_dir, "events").select("event_id", "ts"), "ts").drop("ts")


@query("mask_people", "SELECT c_custkey, sha256(c_name) AS person, sha256('pepper' || c_name) AS salted FROM customer")
def mask_people(spark, sf_dir):
    return base.table(spark, sf_dir, "customer").select(
        "c_custkey", text.pseudonym("c_name").alias("person"), text.pseudonym("c_name", "pepper").alias("salted")
    )


@query(
    "parse_codes",
    f"""SELECT booking_id, room_code, wing, floor, room_number, room_type FROM (
         SELECT booking_id, {base.ROOM_CODE_SQL} AS room_code
         FROM (SELECT booking_id, room_no AS n FROM {{bookings}})) JOIN {{room_dim}} USING (room_code)""",
)
def parse_codes(spark, sf_dir):
    rows = base.bookings(spark, sf_dir).select("booking_id", base.room_code("room_no").alias("room_code"))
    parts = text.room_parts("room_code", f"{base.BUILDING}.")
    return rows.withColumn("parts", parts).select("booking_id", "room_code", "parts.*")


@query(
    "initials",
    """SELECT p_partkey, upper(left(p_name, 1) || left(split_part(p_name, ' ', 2), 1)) || left(p_type, 1) AS code FROM part""",
)
def initials(spark, sf_dir):
    name = F.concat_ws("  ", "p_name", "p_type")
    return base.table(spark, sf_dir, "part").select("p_partkey", text.initials(name).alias("code"))


@query("unit_names", "SELECT s_suppkey, 'INV-' || CASE WHEN s_suppkey < 10 THEN '0' ELSE '' END || s_suppkey AS unit_name FROM supplier")
def unit_names(spark, sf_dir):
    return base.table(spark, sf_dir, "supplier").select("s_suppkey", text.unit_name("s_suppkey").alias("unit_name"))


@query(
    "priced",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(l_quantity * 0.15, 4) AS DOUBLE) AS cost FROM lineitem",
)
def priced(spark, sf_dir):
    return base.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", measures.priced("l_quantity").alias("cost")
    )


@query(
    "safe_ratio",
    """SELECT o_orderkey, round(o_custkey / nullif(CAST(o_orderkey % 4 AS DOUBLE), 0), 6) AS ratio,
       coalesce(round(o_custkey / nullif(CAST(o_orderkey % 4 AS DOUBLE), 0), 6), 0) AS ratio0 FROM orders""",
)
def safe_ratio(spark, sf_dir):
    a, b = F.col("o_custkey").cast("double"), (F.col("o_orderkey") % 4).cast("double")
    return base.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.round(measures.safe_div(a, b), 6).alias("ratio"),
        F.round(measures.safe_div(a, b, 0.0), 6).alias("ratio0"),
    )


@query(
    "wape",
    """SELECT l_returnflag, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS month_key,
       round(CAST(sum(abs(CAST(round(l_extendedprice * 100) AS BIGINT) - CAST(round(l_quantity * 90000) AS BIGINT))) AS DOUBLE)
         / CAST(sum(CAST(round(l_quantity * 90000) AS BIGINT)) AS DOUBLE), 6) AS wape
       FROM lineitem GROUP BY 1, 2""",
)
def wape(spark, sf_dir):
    predicted = F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("double")
    actual = F.round(F.col("l_quantity") * 90000).cast("bigint").cast("double")
    month_key = (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("month_key")
    return base.table(spark, sf_dir, "lineitem").groupBy("l_returnflag", month_key).agg(
        measures.wape(predicted, actual).alias("wape")
    )


@query(
    "sums_by_condition",
    """SELECT o_custkey, CAST(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(round(o_totalprice * 100) AS BIGINT) END), 0) AS BIGINT) AS finished,
       CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(round(o_totalprice * 100) AS BIGINT) END) AS BIGINT) AS urgent,
       max(CAST(o_orderstatus = 'P' AS INTEGER)) AS any_pending FROM orders GROUP BY 1""",
)
def sums_by_condition(spark, sf_dir):
    amount = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return base.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        measures.sum0(F.when(F.col("o_orderstatus") == "F", amount)).alias("finished"),
        measures.sum_if(amount, F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        measures.any_flag(F.col("o_orderstatus") == "P").alias("any_pending"),
    )


@query(
    "traffic_light",
    """SELECT event_id, CASE WHEN p >= 85 THEN 'green' WHEN p >= 75 THEN 'orange' ELSE 'red' END AS three,
       CASE WHEN p >= 85 THEN 'green' ELSE 'red' END AS two FROM (SELECT event_id, user_id % 101 AS p FROM events)""",
)
def traffic_light(spark, sf_dir):
    percent = F.col("user_id") % 101
    return base.table(spark, sf_dir, "events").select(
        "event_id", measures.band(percent).alias("three"), measures.band(percent, orange=None).alias("two")
    )


@query(
    "recurrence_flag",
    "SELECT o_orderkey, o_orderkey % 3 = 0 OR o_orderkey % 4 = 0 AS is_recurring FROM orders",
)
def recurrence_flag(spark, sf_dir):
    first = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate"))
    last = F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderdate"))
    return base.table(spark, sf_dir, "orders").select("o_orderkey", measures.recurring(first, last).alias("is_recurring"))


@query(
    "json_rows",
    "SELECT user_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM events GROUP BY 1, 2",
)
def json_rows_query(spark, sf_dir):
    events = base.table(spark, sf_dir, "events")
    tagged = F.concat(F.lit("["), F.regexp_replace("props", r"\}$", F.concat(F.lit(', "user": '), F.col("user_id").cast("string"), F.lit("}"))), F.lit("]"))
    rows = json_rows(events.select(tagged.alias("doc")), "doc", "k: int, user: bigint")
    return rows.groupBy(F.col("user").alias("user_id"), "k").agg(F.count(F.lit(1)).alias("n"))


@query(
    "route_files",
    """SELECT p_partkey, CASE WHEN contains(p_name, 'red') THEN 'consumption' WHEN contains(p_name, 'hot') THEN 'temperature'
       WHEN contains(p_name, 'blue') THEN 'humidity' ELSE 'others' END AS route FROM part""",
)
def route_files(spark, sf_dir):
    name = F.regexp_replace(F.regexp_replace(F.regexp_replace("p_name", "red", "Conso"), "hot", "TEMP"), "blue", "humi")
    return base.table(spark, sf_dir, "part").select("p_partkey", text.route_of(F.concat(name, F.lit(".csv"))).alias("route"))
