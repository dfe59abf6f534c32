"""Joins, set operations and row-level access."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialwright.examples import base
from dialwright.session import local_frame
from dialwright.examples.registry import query
from dialwright.functions.keys import date_key, floor_minutes
from dialwright.operators import access, aggregates, joins, scans


@query(
    "lookup_default",
    """SELECT event_id, coalesce(s_nationkey, 99) AS nation FROM events
       LEFT JOIN (SELECT s_suppkey, s_nationkey FROM supplier WHERE s_acctbal > 5000) ON s_suppkey = user_id % 100""",
)
def lookup_default(spark, sf_dir):
    rows = base.table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 100).alias("unit"))
    dim = base.table(spark, sf_dir, "supplier").filter("s_acctbal > 5000").withColumnRenamed("s_nationkey", "nation")
    return joins.lookup_key(rows, dim, {"unit": "s_suppkey"}, ["nation"], {"nation": 99}).drop("unit")


@query(
    "lookup_trimmed",
    "SELECT o_orderkey, c_nationkey FROM orders JOIN customer ON c_custkey = o_custkey",
)
def lookup_trimmed(spark, sf_dir):
    name = F.concat(F.lit("  Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.lit(" "))
    rows = base.table(spark, sf_dir, "orders").select("o_orderkey", name.alias("customer"))
    customers = base.table(spark, sf_dir, "customer")
    return joins.lookup_key(rows, customers, {"customer": "c_name"}, ["c_nationkey"], trim=True).drop("customer")


@query(
    "new_members",
    "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')",
)
def new_members(spark, sf_dir):
    dim = base.table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'").withColumnRenamed("c_custkey", "o_custkey")
    return joins.new_members(base.table(spark, sf_dir, "orders"), dim, ["o_custkey"])


@query("align_outer", "SELECT ts, temperature_c, humidity_pct FROM {temperature} FULL JOIN {humidity} USING (ts)")
def align_outer(spark, sf_dir):
    warm = base.sensor(spark, sf_dir, "click", "temperature_c")
    return joins.align_outer(warm, base.sensor(spark, sf_dir, "view", "humidity_pct"), ["ts"])


@query(
    "join_on_time",
    "SELECT ts, temperature_c, humidity_pct FROM {temperature} JOIN {humidity} USING (ts)",
)
def join_on_time(spark, sf_dir):
    warm = base.sensor(spark, sf_dir, "click", "temperature_c")
    return joins.join_on(warm, base.sensor(spark, sf_dir, "view", "humidity_pct"), ["ts"])


@query(
    "join_default",
    "SELECT ts, temperature_c, coalesce(humidity_pct, 0.0) AS humidity_pct FROM {temperature} LEFT JOIN {humidity} USING (ts)",
)
def join_default(spark, sf_dir):
    warm = base.sensor(spark, sf_dir, "click", "temperature_c")
    damp = base.sensor(spark, sf_dir, "view", "humidity_pct")
    return joins.join_default(warm, damp, ["ts"], {"humidity_pct": 0.0})


@query(
    "star_join",
    """SELECT o_orderkey, c_mktsegment, n_name, r_name FROM orders JOIN customer ON c_custkey = o_custkey
       JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
)
def star_join(spark, sf_dir):
    orders = base.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    dims = [
        (base.table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey"), "c_custkey", ["c_mktsegment", "n_nationkey"]),
        (base.table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey"), "n_nationkey", ["n_name", "r_regionkey"]),
        (base.table(spark, sf_dir, "region"), "r_regionkey", ["r_name"]),
    ]
    return joins.star_join(orders, dims).select("o_orderkey", "c_mktsegment", "n_name", "r_name")


@query(
    "scaffold_days",
    """SELECT s_suppkey, CAST(d AS VARCHAR) AS day FROM supplier, (SELECT CAST(unnest(generate_series(
       (SELECT min(ts) FROM events)::DATE::TIMESTAMP, (SELECT max(ts) FROM events)::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d)""",
)
def scaffold_days(spark, sf_dir):
    span = aggregates.bounds(base.table(spark, sf_dir, "events"), "ts")
    suppliers = base.table(spark, sf_dir, "supplier").select("s_suppkey")
    return joins.scaffold_days(suppliers, span.select("lo").scalar(), span.select("hi").scalar())


@query(
    "left_join_filtered",
    """SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders
       ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'""",
)
def left_join_filtered(spark, sf_dir):
    customers = base.table(spark, sf_dir, "customer").select("c_custkey")
    orders = base.table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    keep = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    return joins.left_join_filtered(customers, orders, ["c_custkey"], keep).select("c_custkey", "o_orderkey")


@query(
    "scalar_lookup",
    "SELECT c_custkey, c_name FROM customer WHERE c_nationkey = (SELECT n_nationkey FROM nation WHERE n_name = 'NATION_7')",
)
def scalar_lookup(spark, sf_dir):
    key = joins.scalar_lookup(base.table(spark, sf_dir, "nation"), "n_nationkey", F.col("n_name") == "NATION_7")
    return base.table(spark, sf_dir, "customer").filter(F.col("c_nationkey") == key).select("c_custkey", "c_name")


@query(
    "join_agg",
    """SELECT c_custkey, n_orders, last_order FROM customer LEFT JOIN (
         SELECT o_custkey AS c_custkey, count(*) AS n_orders, CAST(max(o_orderdate) AS TIMESTAMP) AS last_order
         FROM orders GROUP BY 1) USING (c_custkey)""",
)
def join_agg(spark, sf_dir):
    customers = base.table(spark, sf_dir, "customer").select("c_custkey")
    orders = base.table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    aggs = [F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_order")]
    return joins.join_agg(customers, orders, ["c_custkey"], aggs)


@query(
    "price_at",
    """SELECT o_orderkey, price FROM orders LEFT JOIN (
         SELECT make_date(y, 1, 1) AS valid_from, CASE WHEN y < (SELECT max(year(o_orderdate)) FROM orders)
                THEN make_date(y, 12, 31) END AS valid_to, CAST(y - 1980 AS DOUBLE) / 100 AS price
         FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE year(o_orderdate) <> 1996))
       ON CAST(o_orderdate AS DATE) >= valid_from AND (valid_to IS NULL OR CAST(o_orderdate AS DATE) <= valid_to)""",
)
def price_at(spark, sf_dir):
    orders = base.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    year = F.year("o_orderdate")
    years = orders.select(year.alias("y")).filter("y <> 1996").distinct()
    last = orders.agg(F.max(year)).scalar()
    tariff = years.select(
        F.make_date("y", F.lit(1), F.lit(1)).alias("valid_from"),
        F.when(F.col("y") < last, F.make_date("y", F.lit(12), F.lit(31))).alias("valid_to"),
        ((F.col("y") - 1980).cast("double") / 100).alias("price"),
    )
    return joins.price_at(orders, tariff, "o_orderdate", "price", "valid_from", "valid_to").drop("o_orderdate")


@query(
    "price_by_tariff",
    """SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN 0.2 WHEN CAST(o_orderdate AS DATE) < DATE '1996-07-01' THEN 0.1
       ELSE 0.15 END AS price FROM orders""",
)
def price_by_tariff(spark, sf_dir):
    """Two named tariffs in force at once: each order finds its own."""
    rows = [("even", "1990-01-01", None, 0.2), ("odd", "1990-01-01", "1996-06-30", 0.1), ("odd", "1996-07-01", None, 0.15)]
    tariff = local_frame(spark, rows, "name string, f string, t string, price double").select(
        "name", F.col("f").cast("date").alias("valid_from"), F.col("t").cast("date").alias("valid_to"), "price"
    )
    kind = F.when(F.col("o_custkey") % 2 == 0, "even").otherwise("odd")
    orders = base.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", kind.alias("kind"))
    priced = joins.price_at(orders, tariff, "o_orderdate", "price", "valid_from", "valid_to", by={"kind": "name"})
    return priced.select("o_orderkey", "price")


@query(
    "price_at_instant",
    """SELECT e.event_id, e.unit_id, p.price FROM (SELECT event_id, user_id % 5 + 1 AS unit_id, ts FROM events WHERE event_type = 'click') e
       ASOF LEFT JOIN (
         SELECT user_id % 5 + 1 AS unit_id, time_bucket(INTERVAL '1 hour', ts) AS valid_from,
           CASE WHEN hour(max(ts)) <> 7 THEN CAST(max(event_id) AS BIGINT) END AS price
         FROM events WHERE event_type = 'view' GROUP BY 1, 2) p
       ON e.unit_id = p.unit_id AND e.ts >= p.valid_from""",
)
def price_at_instant(spark, sf_dir):
    """Hourly tariffs of five units: a price holds until the unit's next one, the last is open, those of 7 o'clock are missing."""
    events = base.table(spark, sf_dir, "events").withColumn("unit_id", F.col("user_id") % 5 + 1)
    hourly = events.filter("event_type = 'view'").groupBy("unit_id", floor_minutes("ts", 60).alias("valid_from"))
    prices = hourly.agg(F.max("event_id").alias("price")).withColumn("back", -F.unix_micros(F.col("valid_from").cast("timestamp")))
    lines = scans.with_previous(prices, ["unit_id"], ["back"], "valid_from", "valid_to").drop("back")
    lines = lines.filter(F.hour("valid_from") != 7)
    clicks = events.filter("event_type = 'click'").select("event_id", "unit_id", "ts")
    priced = joins.price_at_instant(clicks, lines, "ts", "price", "valid_from", "valid_to", by={"unit_id": "unit_id"})
    return priced.drop("ts")


def _grants(spark, sf_dir):
    return base.table(spark, sf_dir, "nation").select(
        F.concat(F.lit("user_"), F.col("n_regionkey").cast("string")).alias("login"),
        F.col("n_nationkey").cast("bigint").alias("division"),
        F.lit("Director").alias("role"),
    )


def _owned(spark, sf_dir):
    return base.table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 25).alias("division"))


@query(
    "row_filter",
    """SELECT o_orderkey, o_custkey % 25 AS division FROM orders
       WHERE o_custkey % 25 IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""",
)
def row_filter(spark, sf_dir):
    return access.row_filter(_owned(spark, sf_dir), _grants(spark, sf_dir), "user_1", "division", {"director"})


@query("row_filter_privileged", "SELECT o_orderkey, o_custkey % 25 AS division FROM orders")
def row_filter_privileged(spark, sf_dir):
    return access.row_filter(_owned(spark, sf_dir), _grants(spark, sf_dir), "user_1", "division", {"technician"})


@query(
    "add_grant",
    """SELECT login, division, role FROM (
         SELECT 'user_' || n_regionkey AS login, CAST(n_nationkey AS BIGINT) AS division, 'Director' AS role FROM nation
         UNION ALL
         SELECT DISTINCT 'user_' || (c_custkey % 7), CAST(c_nationkey AS BIGINT), 'Teacher' FROM customer
         WHERE c_mktsegment <> 'MACHINERY' AND NOT EXISTS (SELECT 1 FROM nation
           WHERE n_nationkey = c_nationkey AND n_regionkey = c_custkey % 7))""",
)
def add_grant(spark, sf_dir):
    request = base.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("user_"), (F.col("c_custkey") % 7).cast("string")).alias("login"),
        F.col("c_nationkey").cast("bigint").alias("division"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "Technician").otherwise("Teacher").alias("role"),
    )
    return access.add_grant(_grants(spark, sf_dir), request, {"Technician"})


@query(
    "backfill",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND c_acctbal IS NOT NULL THEN c_acctbal
         ELSE o_totalprice END AS amount FROM orders
       LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey""",
)
def backfill(spark, sf_dir):
    orders = base.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").alias("amount")
    )
    actuals = base.table(spark, sf_dir, "customer").filter("c_acctbal > 0").withColumnRenamed("c_custkey", "o_custkey")
    filled = joins.backfill(orders, actuals, ["o_custkey"], {"amount": "c_acctbal"}, F.col("o_orderstatus") == "F")
    return filled.drop("o_custkey", "o_orderstatus")


@query(
    "union_predictions",
    """SELECT o_orderkey AS id, o_totalprice AS made, CAST(NULL AS DOUBLE) AS used FROM orders
       UNION ALL SELECT c_custkey, NULL, c_acctbal FROM customer""",
)
def union_predictions(spark, sf_dir):
    made = base.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("made"))
    used = base.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("used"))
    return joins.union_kinds([made, used])


@query(
    "affected_dates",
    """SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM orders
       UNION SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) FROM lineitem""",
)
def affected_dates(spark, sf_dir):
    ordered = base.table(spark, sf_dir, "orders").select(date_key("o_orderdate").alias("date_key"))
    shipped = base.table(spark, sf_dir, "lineitem").select(date_key("l_shipdate").alias("date_key"))
    return joins.union_distinct([ordered, shipped])


@query(
    "missing_files",
    """SELECT DISTINCT 'orders-' || o_orderkey || '.csv' AS file_name FROM orders
       WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def missing_files(spark, sf_dir):
    def name(key):
        return F.concat(F.lit("orders-"), F.col(key).cast("string"), F.lit(".csv")).alias("file_name")

    source = base.table(spark, sf_dir, "orders").select(name("o_orderkey"))
    done = base.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(name("l_orderkey"))
    return joins.missing_from(source, done, ["file_name"])


@query(
    "floor_slots",
    "SELECT event_id, time_bucket(INTERVAL '15 minutes', ts) AS slot, time_bucket(INTERVAL '3 hours', ts) AS block FROM events",
)
def floor_slots(spark, sf_dir):
    return base.table(spark, sf_dir, "events").select(
        "event_id", floor_minutes("ts", 15).alias("slot"), floor_minutes("ts", 180).alias("block")
    )
