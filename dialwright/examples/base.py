"""The test tables seen as readings, meters, forecasts and bookings.

The columns of the star schema are derived from the given tables by arithmetic
on their keys, the same way in Spark and in the checking SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dialwright import fixed_values as fv
from dialwright.examples.registry import cte
from dialwright.functions.keys import date_key, floor_minutes
from dialwright.operators import dimensions
from dialwright.operators.aggregates import bounds
from dialwright.plans import facts
from dialwright.session import local_frame, shared_dir
from dialwright.sources.readers import is_missing
from dialwright.sources.sinks import write_table

Frames = DataFrame | tuple[DataFrame, ...]

UNIT_SCHEMA = (
    "unit_key bigint, unit_id int, unit_name string, rated_kwp decimal(18,4), string_count int, "
    "roof_section string, install_date date, is_active boolean"
)
STATUS_SCHEMA = (
    "status_key bigint, status_code int, status_label string, status_category string, "
    "is_failure boolean, needs_maintenance boolean"
)
SITE_SCHEMA = (
    "site_key bigint, site_name string, site_description string, is_synthetic boolean, "
    "latitude double, longitude double, altitude_m int, country string"
)
MEASURE_SCHEMA = (
    "measure_key bigint, measure_code string, measure_name string, category string, unit string, "
    "description string, is_production_driver boolean"
)
DIVISION_SCHEMA = (
    "division_key bigint, division_code string, division_name string, school_name string, is_active boolean"
)
ROOM_SCHEMA = (
    "room_key bigint, room_code string, room_full_name string, campus string, building string, wing string, floor int, "
    "room_number string, room_type string, nominal_capacity int, is_active boolean"
)
MODEL_SCHEMA = "model_key bigint, model_code string, model_name string, model_type string"
BUILDING = "HQ-1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """A layer boundary: the rows as a table in the shared folder."""
    path = shared_dir(df.sparkSession, label)
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_LAYERS: dict[tuple[str, str, str], list[tuple[str, StructType]]] = {}


def layer(build: Callable[..., Frames]) -> Callable[..., Frames]:
    """Write what ``build(spark, sf_dir)`` returns once per session and read it afterwards.

    Dimensions and facts are tables that many marts share; a mart then scans
    each of them once instead of deriving it from the raw tables again.
    ``.build`` is the plain function.
    """

    @wraps(build)
    def read(spark: SparkSession, sf_dir: str) -> Frames:
        place = (spark.sparkContext.applicationId, sf_dir, build.__name__)
        if place in _LAYERS:
            try:
                frames = [spark.read.schema(schema).parquet(path) for path, schema in _LAYERS[place]]
                return frames[0] if len(frames) == 1 else tuple(frames)
            except AnalysisException as error:
                if not is_missing(error):  # a folder that was cleaned up is built again
                    raise
        built = build(spark, sf_dir)
        tables = []
        for df in built if isinstance(built, tuple) else (built,):
            path = shared_dir(spark, build.__name__)
            write_table(df, path)
            tables.append((path, df.schema))
        _LAYERS[place] = tables
        return read(spark, sf_dir)

    read.build = build
    return read


# --- device readings: every event is one reading of a unit -----------------

STATUS_OF_EVENT = {"view": 0, "click": 6, "error": 14, "signup": 3}


def status_of(event_type: str = "event_type") -> Column:
    code = F.lit(None).cast("int")
    for name, value in STATUS_OF_EVENT.items():
        code = F.when(F.col(event_type) == name, F.lit(value)).otherwise(code)
    return F.coalesce(code, F.lit(99))


def cents(value: str = "value") -> Column:
    """Readings as whole numbers, so that sums do not depend on their order."""
    return F.round(F.col(value) * 100).cast("bigint")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.col("ts").alias("log_timestamp"),
        (F.col("user_id") % 5 + 1).cast("int").alias("unit_id"),
        cents().cast("double").alias("ac_power_w"),
        status_of().alias("status_code"),
    )


cte(
    "readings",
    """SELECT event_id, user_id, ts AS log_timestamp, CAST(user_id % 5 + 1 AS INTEGER) AS unit_id,
       CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE) AS ac_power_w,
       CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 6 WHEN 'error' THEN 14 WHEN 'signup' THEN 3
            ELSE 99 END AS status_code,
       CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS time_key
       FROM events""",
)


def silver_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings in the shape the device log is cleaned to."""
    nothing = F.lit(None).cast("double")
    return readings(spark, sf_dir).select(
        "log_timestamp",
        "unit_id",
        "ac_power_w",
        F.floor(F.col("ac_power_w") / 10).cast("double").alias("daysum"),
        "status_code",
        *[nothing.alias(c) for c in ("pdc1", "pdc2", "udc1", "udc2")],
        (F.col("status_code") == fv.FAILURE_STATUS_CODE).alias("is_failure"),
    )


@layer
def unit_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = local_frame(spark, [], UNIT_SCHEMA)
    return dimensions.load_units(
        empty, readings(spark, sf_dir), "unit_id", fv.NEW_UNIT_RATED_KWP, fv.NEW_UNIT_STRINGS
    )


cte(
    "unit_dim",
    """SELECT unit_id, 'INV-' || lpad(CAST(unit_id AS VARCHAR), 2, '0') AS unit_name, 6.0 AS rated_kwp
       FROM (SELECT DISTINCT unit_id FROM {readings})""",
)


def status_meta(spark: SparkSession) -> DataFrame:
    return local_frame(
        spark,
        fv.STATUS_CODES,
        "status_code int, status_label string, status_category string, is_failure boolean, needs_maintenance boolean",
    )


def unknown_status(spark: SparkSession) -> DataFrame:
    return local_frame(spark, [(fv.UNKNOWN_STATUS_KEY, *fv.UNKNOWN_STATUS)], STATUS_SCHEMA)


@layer
def status_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = local_frame(spark, [], STATUS_SCHEMA)
    return dimensions.load_statuses(
        empty, readings(spark, sf_dir), "status_code", status_meta(spark), unknown_status(spark)
    )


cte(
    "status_dim",
    """SELECT status_code,
       CASE status_code WHEN 0 THEN 'OK / Standby' WHEN 6 THEN 'Producing' WHEN 14 THEN 'Error'
            WHEN 99 THEN 'Unknown' ELSE 'Code ' || status_code END AS status_label,
       CASE status_code WHEN 0 THEN 'OK' WHEN 6 THEN 'Running' WHEN 14 THEN 'Error' ELSE 'Unknown' END
            AS status_category,
       status_code = 14 AS is_failure, status_code = 14 AS needs_maintenance
       FROM (SELECT DISTINCT status_code FROM {readings} UNION SELECT 99)""",
)


@layer
def device(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Device fact with the two dimensions it refers to."""
    units, statuses = unit_dim(spark, sf_dir), status_dim(spark, sf_dir)
    rows, _ = facts.device_fact(silver_device(spark, sf_dir), units, statuses)
    return rows, units, statuses


cte(
    "device",
    """SELECT date_key, time_key, unit_id, status_code, ac_power_w, floor(ac_power_w / 10) AS day_energy_kwh,
       status_code = 14 AS is_failure FROM (
         SELECT *, row_number() OVER (PARTITION BY date_key, time_key, unit_id
                                      ORDER BY log_timestamp, status_code, ac_power_w) AS nth FROM {readings})
       WHERE nth = 1""",
)


# --- calendar ---------------------------------------------------------------


@layer
def days_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_date(dimensions.calendar_between(bounds(table(spark, sf_dir, "events"), "ts")))


@layer
def days_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_date(dimensions.calendar_between(bounds(table(spark, sf_dir, "orders"), "o_orderdate")))


_DATE_ATTRIBUTES = """CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS VARCHAR) AS full_date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
       monthname(d) AS month_name, left(monthname(d), 3) AS month_short,
       CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
       CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
       dayofweek(d) IN (0, 6) AS is_weekend, false AS is_holiday, CAST(NULL AS VARCHAR) AS holiday_name,
       CASE WHEN month(d) >= 12 OR month(d) < 3 THEN 'Winter' WHEN month(d) >= 9 THEN 'Autumn'
            WHEN month(d) >= 6 THEN 'Summer' ELSE 'Spring' END AS season,
       CASE WHEN month(d) < 9 THEN (year(d) - 1) || '-' || year(d) ELSE year(d) || '-' || (year(d) + 1) END
            AS academic_year,
       CASE WHEN month(d) >= 9 OR month(d) < 2 THEN 'Autumn' ELSE 'Spring' END AS academic_semester,
       dayofweek(d) NOT IN (0, 6) AS is_academic_day"""

cte(
    "event_days",
    f"""SELECT {_DATE_ATTRIBUTES} FROM (SELECT CAST(unnest(generate_series(
       (SELECT min(ts)::DATE FROM events)::TIMESTAMP, (SELECT max(ts)::DATE FROM events)::TIMESTAMP,
       INTERVAL 1 DAY)) AS DATE) AS d)""",
)
cte(
    "order_days",
    f"""SELECT {_DATE_ATTRIBUTES} FROM (SELECT CAST(unnest(generate_series(
       (SELECT min(o_orderdate)::DATE FROM orders)::TIMESTAMP, (SELECT max(o_orderdate)::DATE FROM orders)::TIMESTAMP,
       INTERVAL 1 DAY)) AS DATE) AS d)""",
)


# --- meters: energy per 15-minute slot of one kind of event ------------------


def slot_energy(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == event_type)
        .groupBy(floor_minutes("ts", 15).alias("ts"))
        .agg(F.sum(cents()).cast("double").alias("delta"), F.max("event_id").cast("double").alias("reading"))
    )


@layer
def production(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.meter_fact(slot_energy(spark, sf_dir, "signup"), "reading", "delta", "retail_value")


@layer
def consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.meter_fact(slot_energy(spark, sf_dir, "purchase"), "reading", "delta", "cost")


def _slot_sql(event_type: str) -> str:
    return f"""SELECT time_bucket(INTERVAL '15 minutes', ts) AS ts,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) AS delta_kwh,
       CAST(max(event_id) AS DOUBLE) AS cumulative_kwh,
       CAST(strftime(time_bucket(INTERVAL '15 minutes', any_value(ts)), '%Y%m%d') AS INTEGER) AS date_key,
       CAST(hour(any_value(ts)) * 60 + minute(any_value(ts)) - minute(any_value(ts)) % 15 AS INTEGER) AS time_key
       FROM events WHERE event_type = '{event_type}' GROUP BY time_bucket(INTERVAL '15 minutes', ts)"""


cte("production", _slot_sql("signup"))
cte("consumption", _slot_sql("purchase"))


def sensor(spark: SparkSession, sf_dir: str, event_type: str, value: str) -> DataFrame:
    """Mean reading per 15-minute slot, as a whole number."""
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == event_type)
        .groupBy(floor_minutes("ts", 15).alias("ts"))
        .agg(F.floor(F.sum(cents()) / F.count(F.lit(1))).cast("double").alias(value))
    )


@layer
def environment(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("double")
    warm = sensor(spark, sf_dir, "click", "actual_temp").withColumn("temp_delta", none)
    damp = sensor(spark, sf_dir, "view", "actual_humidity").withColumn("humidity_delta", none)
    return facts.environment_fact(warm, damp)


def _sensor_sql(event_type: str, value: str) -> str:
    return f"""SELECT time_bucket(INTERVAL '15 minutes', ts) AS ts,
       floor(sum(CAST(round(value * 100) AS BIGINT)) / count(*)) AS {value}
       FROM events WHERE event_type = '{event_type}' GROUP BY 1"""


cte("temperature", _sensor_sql("click", "temperature_c"))
cte("humidity", _sensor_sql("view", "humidity_pct"))
cte(
    "environment",
    """SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS time_key, ts, temperature_c, humidity_pct
       FROM {temperature} FULL JOIN {humidity} USING (ts)""",
)


# --- forecasts: three sites, four measures, 3-hourly ------------------------

MEASURE_OF_EVENT = {
    "view": "PRED_GLOB_ctrl",
    "click": "PRED_T_2M_ctrl",
    "purchase": "PRED_RELHUM_2M_ctrl",
    "signup": "PRED_TOT_PREC_ctrl",
    "error": "PRED_OTHER",
}
SITES = ["North", "South", "East"]
SYNTHETIC_SITE = "Middle"


def raw_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    measure = F.create_map(*[F.lit(x) for pair in MEASURE_OF_EVENT.items() for x in pair])
    marker = F.when(F.col("event_id") % 50 == 0, 99999.0).when(F.col("event_id") % 50 == 1, -99999.0)
    return table(spark, sf_dir, "events").select(
        floor_minutes("ts", 180).alias("Time"),
        F.element_at(measure, F.col("event_type")).alias("Measurement"),
        F.lpad((F.col("event_id") % 4).cast("string"), 2, "0").alias("Prediction"),
        F.lit("x").alias("Unit"),
        F.coalesce(marker, cents().cast("double")).alias("Value"),
        F.element_at(F.array(*[F.lit(s) for s in SITES]), (F.col("user_id") % 3 + 1).cast("int")).alias("Site"),
    )


cte(
    "raw_forecasts",
    """SELECT time_bucket(INTERVAL '3 hours', ts) AS "Time",
       CASE event_type WHEN 'view' THEN 'PRED_GLOB_ctrl' WHEN 'click' THEN 'PRED_T_2M_ctrl'
            WHEN 'purchase' THEN 'PRED_RELHUM_2M_ctrl' WHEN 'signup' THEN 'PRED_TOT_PREC_ctrl'
            ELSE 'PRED_OTHER' END AS "Measurement",
       lpad(CAST(event_id % 4 AS VARCHAR), 2, '0') AS "Prediction", 'x' AS "Unit",
       CASE event_id % 50 WHEN 0 THEN 99999.0 WHEN 1 THEN -99999.0
            ELSE CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE) END AS "Value",
       CASE user_id % 3 WHEN 0 THEN 'North' WHEN 1 THEN 'South' ELSE 'East' END AS "Site"
       FROM events""",
)
cte(
    "forecasts",
    """SELECT "Time", "Measurement", "Prediction", "Unit",
       avg(CASE WHEN abs("Value") <> 99999.0 THEN "Value" END) AS "Value", 'Middle' AS "Site"
       FROM {raw_forecasts} WHERE "Site" IN ('North', 'South')
       GROUP BY "Time", "Measurement", "Prediction", "Unit\"""",
)


def site_meta(spark: SparkSession) -> DataFrame:
    rows = [
        ("Middle", "Average of the two coast stations", True, 56.4, 10.9, 21, None),
        ("South", "Harbour mast", False, 55.7, 12.6, 9, "DK"),
        ("North", "Lighthouse mast", False, 57.1, 9.2, 33, "DK"),
    ]
    return local_frame(
        spark,
        rows,
        "site_name string, site_description string, is_synthetic boolean, latitude double, longitude double, altitude_m int, country string",
    )


def measure_meta(spark: SparkSession) -> DataFrame:
    return local_frame(
        spark,
        fv.FORECAST_MEASURES,
        "measure_code string, measure_name string, category string, unit string, is_production_driver boolean",
    )


# --- bookings: every order books a room --------------------------------------


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = 480 + (F.col("o_orderkey") * 7 % 40) * 15
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("booking_id"),
        F.col("o_orderdate").cast("date").alias("day"),
        date_key("o_orderdate").alias("date_key"),
        start.cast("int").alias("start_time_key"),
        (start + 15 * (1 + F.col("o_orderkey") % 8)).cast("int").alias("end_time_key"),
        (15 * (1 + F.col("o_orderkey") % 8)).cast("int").alias("duration_minutes"),
        (F.col("o_custkey") % 40).cast("int").alias("room_no"),
        (F.col("o_custkey") % 5).cast("int").alias("division_no"),
        F.col("o_orderdate"),
    )


cte(
    "bookings",
    """SELECT o_orderkey AS booking_id, CAST(o_orderdate AS DATE) AS day,
       CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(480 + (o_orderkey * 7 % 40) * 15 AS INTEGER) AS start_time_key,
       CAST(480 + (o_orderkey * 7 % 40) * 15 + 15 * (1 + o_orderkey % 8) AS INTEGER) AS end_time_key,
       CAST(15 * (1 + o_orderkey % 8) AS INTEGER) AS duration_minutes,
       CAST(o_custkey % 40 AS INTEGER) AS room_no, CAST(o_custkey % 5 AS INTEGER) AS division_no,
       o_orderdate FROM orders""",
)


def room_code(number: Column | str) -> Column:
    """Codes of every kind the parser knows."""
    number = F.col(number) if isinstance(number, str) else number
    wing = F.element_at(F.array(*[F.lit(w) for w in "NSEW"]), (number % 4 + 1).cast("int"))
    base = F.concat(wing, (F.floor(number / 4) % 5).cast("string"), F.lpad(number.cast("string"), 2, "0"))
    special = (
        F.when(number == 0, "Foyer")
        .when(number == 1, "SUM")
        .when(number % 10 == 2, F.concat(F.lit("Aula "), (number % 7).cast("string")))
        .when(number % 10 == 3, F.concat(base, F.lit("-Comodal")))
        .otherwise(base)
    )
    return F.concat(F.lit(f"{BUILDING}."), special)


ROOM_CODE_SQL = """'HQ-1.' || CASE WHEN n = 0 THEN 'Foyer' WHEN n = 1 THEN 'SUM'
       WHEN n % 10 = 2 THEN 'Aula ' || (n % 7)
       ELSE substr('NSEW', n % 4 + 1, 1) || ((n // 4) % 5) || lpad(CAST(n AS VARCHAR), 2, '0')
            || CASE WHEN n % 10 = 3 THEN '-Comodal' ELSE '' END END"""

DIVISIONS = ["School of Applied Health", "Business School", "Engineering", "Social Work", "Arts and Design"]


def division_name(number: Column | str) -> Column:
    number = F.col(number) if isinstance(number, str) else number
    return F.element_at(F.array(*[F.lit(d) for d in DIVISIONS]), (number + 1).cast("int"))


DIVISION_SQL = "CASE n WHEN 0 THEN 'School of Applied Health' WHEN 1 THEN 'Business School' WHEN 2 THEN 'Engineering' WHEN 3 THEN 'Social Work' ELSE 'Arts and Design' END"


def division_meta(spark: SparkSession) -> DataFrame:
    return local_frame(
        spark,
        [("Engineering", "ENG", "Faculty of Engineering", True), ("Business School", "BUS", "Faculty of Business", True)],
        "division_name string, division_code string, school_name string, is_active boolean",
    )


def room_dim(silver: DataFrame) -> DataFrame:
    empty = local_frame(silver.sparkSession, [], ROOM_SCHEMA)
    return dimensions.load_rooms(empty, silver, "Nom", "Main", BUILDING)


def division_dim(silver: DataFrame) -> DataFrame:
    spark = silver.sparkSession
    return dimensions.load_divisions(
        local_frame(spark, [], DIVISION_SCHEMA), silver, "Division", division_meta(spark)
    )


cte(
    "room_dim",
    f"""SELECT room_code, b AS base,
       CASE WHEN b = 'Foyer' THEN 'Foyer' WHEN b = 'SUM' THEN 'Seminar' WHEN contains(b, 'Aula') THEN 'Auditorium'
            WHEN contains(b, 'Comodal') THEN 'Comodal' ELSE 'Classroom' END AS room_type,
       CASE WHEN numbered THEN left(b, 1) END AS wing,
       CASE WHEN numbered THEN CAST(substr(b, 2, 1) AS INTEGER) END AS floor,
       CASE WHEN numbered THEN regexp_extract(b, '^[A-Z]\\d(\\d+)', 1) END AS room_number
       FROM (SELECT *, substr(room_code, 6) AS b,
                    NOT contains(room_code, 'Aula') AND regexp_matches(substr(room_code, 6), '^[A-Z]\\d\\d') AS numbered
             FROM (SELECT DISTINCT {ROOM_CODE_SQL} AS room_code FROM (SELECT room_no AS n FROM {{bookings}})))""",
)
cte(
    "division_dim",
    f"""SELECT division_name,
       CASE division_name WHEN 'Engineering' THEN 'ENG' WHEN 'Business School' THEN 'BUS'
            WHEN 'School of Applied Health' THEN 'SOAH' WHEN 'Social Work' THEN 'SW' ELSE 'AAD' END AS division_code,
       CASE division_name WHEN 'Engineering' THEN 'Faculty of Engineering'
            WHEN 'Business School' THEN 'Faculty of Business' ELSE division_name END AS school_name
       FROM (SELECT DISTINCT {DIVISION_SQL} AS division_name FROM (SELECT division_no AS n FROM {{bookings}}))""",
)


def french_day(ts: Column | str) -> Column:
    """Date as the booking export writes it, ``8 janv. 2023``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    token = F.element_at(F.array(*[F.lit(m) for m in fv.FRENCH_MONTHS]), F.month(ts))
    return F.concat_ws(" ", F.dayofmonth(ts).cast("string"), token, F.year(ts).cast("string"))


def clock_text(minutes: Column | str) -> Column:
    minutes = F.col(minutes) if isinstance(minutes, str) else minutes
    return F.format_string("%02d:%02d", F.floor(minutes / 60).cast("int"), (minutes % 60).cast("int"))


def silver_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings as text, the way they leave the booking system."""
    b = bookings(spark, sf_dir)
    recurring = F.col("booking_id") % 3 == 0
    return b.select(
        room_code("room_no").alias("Nom"),
        french_day("o_orderdate").alias("Date"),
        clock_text("start_time_key").alias("Heure_Debut"),
        clock_text("end_time_key").alias("Heure_Fin"),
        (F.col("booking_id") % 50).cast("string").alias("Numero"),
        division_name("division_no").alias("Division"),
        F.when(recurring, french_day("o_orderdate")).alias("Date_Recurrence_Debut"),
        F.when(recurring, french_day(F.date_add("o_orderdate", 70))).alias("Date_Recurrence_Fin"),
        F.col("booking_id").cast("string").alias("Remarque"),
    )


BOOKING_COLUMNS = {
    "room": "Nom",
    "division": "Division",
    "day": "Date",
    "start": "Heure_Debut",
    "end": "Heure_Fin",
    "recurrence_start": "Date_Recurrence_Debut",
    "recurrence_end": "Date_Recurrence_Fin",
    "reservation_no": "Numero",
    "remark": "Remarque",
}


@layer
def booking_fact(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    silver = stored(silver_bookings(spark, sf_dir), "silver-bookings")
    rooms, divisions = room_dim(silver), division_dim(silver)
    rows, _ = facts.booking_fact(silver, rooms, divisions, BOOKING_COLUMNS)
    return rows, rooms, divisions


cte(
    "booking_fact",
    f"""SELECT * FROM (
       SELECT date_key, start_time_key, end_time_key, duration_minutes,
         (SELECT c FROM (SELECT {ROOM_CODE_SQL} AS c FROM (SELECT room_no AS n))) AS room_code,
         (SELECT c FROM (SELECT {DIVISION_SQL} AS c FROM (SELECT division_no AS n))) AS division_name,
         CAST(nullif(booking_id % 50, 0) AS INTEGER) AS reservation_no,
         booking_id % 3 = 0 AS is_recurring,
         CASE WHEN booking_id % 3 = 0 THEN day END AS recurrence_start,
         CASE WHEN booking_id % 3 = 0 THEN CAST(day + INTERVAL 70 DAY AS DATE) END AS recurrence_end,
         CAST(booking_id AS VARCHAR) AS remark
       FROM {{bookings}})
       QUALIFY row_number() OVER (PARTITION BY date_key, start_time_key, room_code, reservation_no
         ORDER BY end_time_key, division_name, recurrence_start NULLS FIRST, recurrence_end NULLS FIRST, remark) = 1""",
)

