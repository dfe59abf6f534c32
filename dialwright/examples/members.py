"""Dimension loads, effective dating and calendars."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialwright.examples import base
from dialwright.examples.registry import cte, query
from dialwright.functions.keys import assign_keys, date_key
from dialwright.functions.text import code_label
from dialwright.operators import dimensions
from dialwright.operators.aggregates import bounds
from dialwright.session import local_frame


@query(
    "assign_keys",
    """SELECT c_name, 1000 + row_number() OVER (ORDER BY substr(md5(c_name), 1, 3), c_name) AS customer_key
       FROM customer""",
)
def assign_keys_query(spark, sf_dir):
    names = base.table(spark, sf_dir, "customer").select("c_name")
    return assign_keys(names, ["c_name"], "customer_key", 1000)


@query(
    "unit_dimension",
    """SELECT unit_id, unit_name, rated_kwp, 2 AS string_count, CAST(NULL AS VARCHAR) AS roof_section,
       CAST(NULL AS VARCHAR) AS install_date, true AS is_active FROM {unit_dim}""",
)
def unit_dimension(spark, sf_dir):
    return base.unit_dim(spark, sf_dir).drop("unit_key")


@query(
    "status_dimension",
    """SELECT status_code, status_label, status_category, is_failure, needs_maintenance,
       CASE WHEN status_code = 99 THEN 99 END AS fixed_key FROM {status_dim}""",
)
def status_dimension(spark, sf_dir):
    fixed = F.when(F.col("status_code") == 99, F.col("status_key")).alias("fixed_key")
    return base.status_dim(spark, sf_dir).select(
        "status_code", "status_label", "status_category", "is_failure", "needs_maintenance", fixed
    )


@query(
    "site_dimension",
    """SELECT * FROM (VALUES ('East', 'Station East', false, NULL, NULL, NULL, 'CH'),
         ('Middle', 'Average of the two coast stations', true, 56.4, 10.9, 21, 'CH'),
         ('North', 'Lighthouse mast', false, 57.1, 9.2, 33, 'DK'),
         ('South', 'Harbour mast', false, 55.7, 12.6, 9, 'DK'))
         t(site_name, site_description, is_synthetic, latitude, longitude, altitude_m, country)
       WHERE site_name = 'Middle' OR site_name IN (SELECT "Site" FROM {raw_forecasts})""",
)
def site_dimension(spark, sf_dir):
    raw = base.raw_forecasts(spark, sf_dir)
    empty = local_frame(spark, [], base.SITE_SCHEMA)
    return dimensions.load_sites(empty, raw, "Site", base.site_meta(spark), [base.SYNTHETIC_SITE]).drop("site_key")


@query(
    "measure_dimension",
    """SELECT m AS measure_code,
       CASE m WHEN 'PRED_GLOB_ctrl' THEN 'Horizontal global irradiance' WHEN 'PRED_T_2M_ctrl' THEN 'Air temperature at 2 m'
         WHEN 'PRED_RELHUM_2M_ctrl' THEN 'Relative humidity at 2 m' WHEN 'PRED_TOT_PREC_ctrl' THEN 'Total precipitation'
         ELSE m END AS measure_name,
       CASE m WHEN 'PRED_GLOB_ctrl' THEN 'Solar' WHEN 'PRED_T_2M_ctrl' THEN 'Temperature'
         WHEN 'PRED_RELHUM_2M_ctrl' THEN 'Humidity' WHEN 'PRED_TOT_PREC_ctrl' THEN 'Precipitation'
         ELSE 'Unknown' END AS category,
       CASE m WHEN 'PRED_GLOB_ctrl' THEN 'Watt/m2' WHEN 'PRED_T_2M_ctrl' THEN '°C'
         WHEN 'PRED_RELHUM_2M_ctrl' THEN 'Percent' WHEN 'PRED_TOT_PREC_ctrl' THEN 'Kg/m2' ELSE 'x' END AS unit,
       'New code found in the data.' AS description,
       m = 'PRED_GLOB_ctrl' AS is_production_driver
       FROM (SELECT DISTINCT "Measurement" AS m FROM {raw_forecasts})""",
)
def measure_dimension(spark, sf_dir):
    raw = base.raw_forecasts(spark, sf_dir)
    empty = local_frame(spark, [], base.MEASURE_SCHEMA)
    return dimensions.load_measures(empty, raw, "Measurement", "Unit", base.measure_meta(spark)).drop("measure_key")


@query("division_dimension", "SELECT division_name, division_code, school_name, true AS is_active FROM {division_dim}")
def division_dimension(spark, sf_dir):
    return base.division_dim(base.silver_bookings(spark, sf_dir)).drop("division_key")


@query(
    "room_dimension",
    """SELECT room_code, room_code AS room_full_name, 'Main' AS campus, 'HQ-1' AS building, wing, floor, room_number, room_type,
       CAST(NULL AS INTEGER) AS nominal_capacity, true AS is_active FROM {room_dim}""",
)
def room_dimension(spark, sf_dir):
    return base.room_dim(base.silver_bookings(spark, sf_dir)).drop("room_key")


@query(
    "dim_upsert",
    """SELECT c_custkey, c_name, c_mktsegment, CASE WHEN c_acctbal > 2000 THEN c_custkey + 1 ELSE
         (SELECT max(c_custkey + 1) FROM customer WHERE c_acctbal > 2000)
         + row_number() OVER (PARTITION BY c_acctbal > 2000 ORDER BY substr(md5(CAST(c_custkey AS VARCHAR)), 1, 3), c_custkey)
         END AS customer_key FROM customer""",
)
def dim_upsert(spark, sf_dir):
    customers = base.table(spark, sf_dir, "customer")
    existing = customers.filter("c_acctbal > 2000").select(
        "c_custkey", "c_name", "c_mktsegment", (F.col("c_custkey") + 1).alias("customer_key")
    )
    return dimensions.insert_new(existing, customers, ["c_custkey"], "customer_key")


@query(
    "ensure_member",
    """SELECT n_nationkey, n_name FROM nation WHERE n_regionkey < 3 UNION ALL SELECT DISTINCT c_nationkey, 'added'
       FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)""",
)
def ensure_member(spark, sf_dir):
    nations = base.table(spark, sf_dir, "nation").filter("n_regionkey < 3").select("n_nationkey", "n_name")
    wanted = base.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n_nationkey"), F.lit("added").alias("n_name"))
    return dimensions.ensure_member(nations, wanted.distinct(), ["n_nationkey"])


def _parts(spark, sf_dir):
    parts = base.table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size")
    old = parts.filter("p_size > 20")
    changed = F.when(F.col("p_brand") == "Brand#4", F.lit("REWORKED")).otherwise(F.col("p_type"))
    new = parts.filter("p_type <> 'ECONOMY'").withColumns({"p_type": changed, "p_size": F.col("p_size") + 100})
    return old, new


_BOTH_PARTS = """SELECT coalesce(o.p_partkey, n.p_partkey) AS p_partkey, o.p_partkey AS old_key, n.p_partkey AS new_key,
       o.p_type AS old_type, n.p_type AS new_type, o.p_brand AS old_brand, n.p_brand AS new_brand,
       o.p_size AS old_size, n.p_size AS new_size FROM (SELECT * FROM part WHERE p_size > 20) o
       FULL JOIN (SELECT p_partkey, CASE WHEN p_brand = 'Brand#4' THEN 'REWORKED' ELSE p_type END AS p_type, p_brand,
                         p_size + 100 AS p_size FROM part WHERE p_type <> 'ECONOMY') n ON o.p_partkey = n.p_partkey"""
cte("both_parts", _BOTH_PARTS)


@query(
    "upsert_on_change",
    """SELECT p_partkey, CASE WHEN old_key IS NULL OR new_type <> old_type THEN new_type ELSE old_type END AS p_type,
       coalesce(old_brand, new_brand) AS p_brand,
       CASE WHEN old_key IS NULL OR new_type <> old_type THEN new_size ELSE old_size END AS p_size FROM {both_parts}""",
)
def upsert_on_change(spark, sf_dir):
    old, new = _parts(spark, sf_dir)
    return dimensions.upsert_on_change(old, new, ["p_partkey"], ["p_type"], ["p_type", "p_size"])


@query(
    "merge_by_key",
    """SELECT p_partkey, coalesce(new_type, old_type) AS p_type, coalesce(new_brand, old_brand) AS p_brand,
       coalesce(new_size, old_size) AS p_size FROM {both_parts}""",
)
def merge_by_key(spark, sf_dir):
    old, new = _parts(spark, sf_dir)
    return dimensions.merge_by_key(old, new, ["p_partkey"])


cte(
    "segments",
    """SELECT c_custkey, c_mktsegment AS segment, DATE '2024-01-01' AS valid_from, CAST(NULL AS DATE) AS valid_to
       FROM customer WHERE c_acctbal > 2000
       UNION ALL SELECT c_custkey, 'OLD', DATE '2023-01-01', DATE '2023-12-31' FROM customer WHERE c_acctbal > 5000""",
)
cte(
    "new_segments",
    """SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN 'MOVED' ELSE c_mktsegment END AS segment,
       DATE '2024-06-01' AS valid_from FROM customer WHERE c_mktsegment <> 'MACHINERY'""",
)


@query(
    "scd2_history",
    """SELECT c_custkey, segment, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to FROM (
         SELECT * FROM {segments} WHERE valid_to IS NOT NULL
         UNION ALL
         SELECT s.c_custkey, s.segment, s.valid_from, CASE WHEN n.segment <> s.segment THEN DATE '2024-05-31' END
         FROM {segments} s LEFT JOIN {new_segments} n ON n.c_custkey = s.c_custkey WHERE s.valid_to IS NULL
         UNION ALL
         SELECT n.c_custkey, n.segment, n.valid_from, NULL FROM {new_segments} n
         LEFT JOIN (SELECT * FROM {segments} WHERE valid_to IS NULL) s ON s.c_custkey = n.c_custkey
         WHERE s.c_custkey IS NULL OR s.segment <> n.segment)""",
)
def scd2_history(spark, sf_dir):
    customers = base.table(spark, sf_dir, "customer")

    def day(text):
        return F.lit(text).cast("date")

    current = customers.filter("c_acctbal > 2000").select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), day("2024-01-01").alias("valid_from"), day(None).alias("valid_to")
    )
    past = customers.filter("c_acctbal > 5000").select(
        "c_custkey", F.lit("OLD").alias("segment"), day("2023-01-01").alias("valid_from"), day("2023-12-31").alias("valid_to")
    )
    segment = F.when(F.col("c_nationkey") < 5, F.lit("MOVED")).otherwise(F.col("c_mktsegment"))
    incoming = customers.filter("c_mktsegment <> 'MACHINERY'").select(
        "c_custkey", segment.alias("segment"), day("2024-06-01").alias("valid_from")
    )
    return dimensions.scd2(current.unionByName(past), incoming, ["c_custkey"], ["segment"])


# Two loads of priorities per customer; the second comes after the first but is dated into and around it.
cte(
    "first_load",
    """SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, max(o_orderpriority) AS priority FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1, 2""",
)
cte(
    "second_load",
    """SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, max(o_orderpriority) AS priority FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1, 2""",
)
cte(
    "first_lines",
    """SELECT * FROM (SELECT *, lag(priority) OVER (PARTITION BY o_custkey ORDER BY day) AS before FROM {first_load})
       WHERE priority IS DISTINCT FROM before""",
)
cte(
    "all_cuts",
    """SELECT o_custkey, day, priority FROM {second_load} UNION ALL
       SELECT o_custkey, day, priority FROM {first_lines} ANTI JOIN {second_load} USING (o_custkey, day)""",
)


@query(
    "scd2_timeline",
    """SELECT o_custkey, priority, CAST(day AS VARCHAR) AS valid_from,
         CAST(CAST(lead(day) OVER (PARTITION BY o_custkey ORDER BY day) - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS valid_to
       FROM (SELECT *, lag(priority) OVER (PARTITION BY o_custkey ORDER BY day) AS before FROM {all_cuts})
       WHERE priority IS DISTINCT FROM before""",
)
def scd2_timeline(spark, sf_dir):
    """Many changes per customer in each of two loads, the second one back-dated into the lines of the first."""
    orders = base.table(spark, sf_dir, "orders").withColumn("valid_from", F.col("o_orderdate").cast("date"))
    empty = local_frame(spark, [], "o_custkey bigint, priority string, valid_from date, valid_to date")
    state = empty
    for load in (orders.filter("o_orderkey % 3 = 0"), orders.filter("o_orderkey % 3 <> 0")):
        changes = load.select("o_custkey", F.col("o_orderpriority").alias("priority"), "valid_from")
        state = dimensions.scd2_timeline(state, changes, ["o_custkey"], ["priority"])
    return state


@query(
    "dim_date",
    "SELECT d.*, coalesce(n, 0) AS n_orders FROM {order_days} d LEFT JOIN (SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS full_date, count(*) AS n FROM orders GROUP BY 1) USING (full_date)",
)
def dim_date(spark, sf_dir):
    orders = base.table(spark, sf_dir, "orders")
    days = dimensions.dim_date(dimensions.calendar_between(bounds(orders, "o_orderdate")))
    counts = orders.groupBy(date_key("o_orderdate").alias("date_key")).agg(F.count(F.lit(1)).alias("n"))
    joined = days.join(counts, "date_key", "left")
    return joined.withColumn("n_orders", F.coalesce("n", F.lit(0))).drop("n")


@query(
    "dim_time",
    """SELECT event_id, lpad(CAST(h AS VARCHAR), 2, '0') || ':' || lpad(CAST(m AS VARCHAR), 2, '0') AS time_label,
       h AS hour, m AS minute, (h * 60 + m) // 15 AS quarter_hour_slot, (h * 60 + m) // 30 AS half_hour_slot, h AS hour_slot,
       CASE WHEN h >= 18 THEN 'Evening' WHEN h >= 12 THEN 'Afternoon' WHEN h >= 6 THEN 'Morning' ELSE 'Night' END AS time_period,
       h >= 8 AND h < 18 AS is_business_hour, h * 60 + m >= 510 AND h * 60 + m < 1020 AS is_lecture_hour
       FROM (SELECT event_id, CAST(hour(ts) AS INTEGER) AS h, CAST(minute(ts) AS INTEGER) AS m FROM events)""",
)
def dim_time(spark, sf_dir):
    keyed = base.table(spark, sf_dir, "events").select(
        "event_id", (F.hour("ts") * 60 + F.minute("ts")).alias("time_key")
    )
    return keyed.join(dimensions.dim_time(spark), "time_key").drop("time_key")


@query(
    "status_labels",
    """SELECT event_id, CASE code WHEN 0 THEN 'OK / Standby' WHEN 6 THEN 'Producing' WHEN 14 THEN 'Error'
       ELSE coalesce('Code ' || code, 'Unknown') END AS label FROM (
         SELECT event_id, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 6 WHEN 'error' THEN 14
                WHEN 'signup' THEN 3 END AS code FROM events)""",
)
def status_labels(spark, sf_dir):
    code = F.when(F.col("event_type") != "purchase", base.status_of())
    rows = base.table(spark, sf_dir, "events").select("event_id", code.alias("status_code"))
    meta = base.status_meta(spark).select("status_code", "status_label")
    named = dimensions.with_metadata(rows, meta, "status_code", {"status_label": code_label("status_code")})
    return named.select("event_id", F.col("status_label").alias("label"))


