"""Incremental loads, idempotent re-runs, integrity checks and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialwright.examples import base, marts
from dialwright.examples.registry import query
from dialwright.functions.keys import date_key
from dialwright.operators import aggregates, increments, quality
from dialwright.plans import facts
from dialwright.session import shared_dir
from dialwright.sources import sinks

_DAY_KEY = "CAST(strftime(ts, '%Y%m%d') AS INTEGER)"


def _events(spark, sf_dir):
    return base.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")


def _keyed(df):
    return df.withColumn("date_key", date_key("ts"))


@query("watermark", f"SELECT event_type, max({_DAY_KEY}) AS mark, (SELECT max({_DAY_KEY}) FROM events) AS overall FROM events GROUP BY 1")
def watermark(spark, sf_dir):
    rows = base.table(spark, sf_dir, "events").withColumn("date_key", date_key("ts"))
    per_type = rows.groupBy("event_type").agg(F.max("date_key").alias("mark"))
    return per_type.withColumn("overall", increments.watermark(rows))


@query("after_watermark", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-16'")
def after_watermark(spark, sf_dir):
    return increments.after_watermark(_events(spark, sf_dir), "ts", 20240115).select("event_id")


@query(
    "incremental_append",
    f"SELECT event_id, user_id, {_DAY_KEY} AS date_key FROM events WHERE {_DAY_KEY} > 20240115",
)
def incremental_append(spark, sf_dir):
    events = _events(spark, sf_dir)
    loaded = _keyed(events).filter("date_key <= 20240115")
    rows = facts.load_increment(events, "ts", loaded, ["event_id"], _keyed)
    return rows.select("event_id", "user_id", "date_key")


@query(
    "late_lookback",
    f"""SELECT event_id, user_id, {_DAY_KEY} AS date_key FROM events
        WHERE {_DAY_KEY} > 20240115 OR ({_DAY_KEY} > 20240110 AND event_type = 'signup')""",
)
def late_lookback(spark, sf_dir):
    """Signups of loaded days arrive late; those of the reopened days are found."""
    events = base.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    loaded = _keyed(events).filter("date_key <= 20240115 AND event_type <> 'signup'")
    rows = facts.load_increment(events, "ts", loaded, ["event_id"], _keyed, lookback_days=5)
    return rows.select("event_id", "user_id", "date_key")


@query(
    "replace_run",
    """SELECT user_id, event_id, CASE WHEN user_id % 3 = 1 THEN -1.0 ELSE value END AS value, CAST(user_id % 3 AS INTEGER) AS run_key FROM events""",
)
def replace_run(spark, sf_dir):
    """Three runs are stored; run 1 is stored again and replaces only itself."""
    rows = base.table(spark, sf_dir, "events").select(
        "user_id", "event_id", "value", (F.col("user_id") % 3).cast("int").alias("run_key")
    )
    path = shared_dir(spark, "replace-run")
    sinks.replace_partition(rows, path, ["run_key"])
    sinks.replace_partition(rows.filter("run_key = 1").withColumn("value", F.lit(-1.0)), path, ["run_key"])
    return spark.read.schema(rows.schema).parquet(path)


@query("replace_empty_run", "SELECT event_id, CAST(user_id % 3 AS INTEGER) AS run_key FROM events WHERE user_id % 3 <> 1")
def replace_empty_run(spark, sf_dir):
    """Three runs are stored; run 1 is loaded again, yields nothing now and is cleared."""
    rows = base.table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 3).cast("int").alias("run_key"))
    path = shared_dir(spark, "replace-run")
    sinks.replace_partition(rows, path, ["run_key"])
    sinks.replace_partition(rows.filter("false"), path, ["run_key"], runs=[{"run_key": 1}])
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "staged_overwrite",
    "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'EVEN' ELSE c_mktsegment END AS segment FROM customer",
)
def staged_overwrite(spark, sf_dir):
    """A table is replaced by a state computed from itself."""
    path = shared_dir(spark, "staged")
    sinks.write_table(base.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment")), path)
    stored = spark.read.parquet(path)
    segment = F.when(F.col("c_custkey") % 2 == 0, F.lit("EVEN")).otherwise(F.col("segment"))
    sinks.staged_overwrite(stored.withColumn("segment", segment), path)
    return spark.read.parquet(path)


@query(
    "fk_violations",
    "SELECT o_custkey, count(*) AS n_rows FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') GROUP BY 1",
)
def fk_violations(spark, sf_dir):
    customers = base.table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    return quality.fk_violations(base.table(spark, sf_dir, "orders"), customers, "o_custkey", "c_custkey")


@query(
    "pk_violations",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def pk_violations(spark, sf_dir):
    return quality.pk_violations(base.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "load_summary",
    """SELECT model_code, count(*) AS n_rows, min(full_date) AS first_day, max(full_date) AS last_day,
       count(actual_production_kwh) AS production_actuals, count(actual_consumption_kwh) AS consumption_actuals
       FROM {backfilled} JOIN {event_days} USING (date_key) GROUP BY 1""",
)
def load_summary(spark, sf_dir):
    rows, models = marts.backfilled(spark, sf_dir)
    dated = rows.join(models.select("model_key", "model_code"), "model_key").join(
        base.days_of_events(spark, sf_dir).select("date_key", "full_date"), "date_key"
    )
    filled = {"production_actuals": "actual_production_kwh", "consumption_actuals": "actual_consumption_kwh"}
    return quality.load_summary(dated, ["model_code"], "full_date", filled)


@query(
    "table_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ("events", "orders", "lineitem", "customer")
    ),
)
def table_counts(spark, sf_dir):
    names = ("events", "orders", "lineitem", "customer")
    return quality.table_counts({t: base.table(spark, sf_dir, t) for t in names})


@query(
    "freshness",
    """SELECT CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS last_day,
       CAST(date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-05') AS INTEGER) AS age_days,
       date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-05') > 2 AS is_stale FROM events""",
)
def freshness(spark, sf_dir):
    return quality.freshness(base.table(spark, sf_dir, "events"), "ts", F.lit("2024-02-05"))


@query(
    "bounds",
    "SELECT user_id, min(ts) AS lo, max(ts) AS hi FROM events GROUP BY 1",
)
def bounds(spark, sf_dir):
    return aggregates.bounds(base.table(spark, sf_dir, "events"), "ts", ["user_id"])


@query(
    "count_if",
    """SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS errors,
       count(*) FILTER (WHERE value > 100) AS large FROM events GROUP BY 1""",
)
def count_if(spark, sf_dir):
    conditions = {"errors": F.col("event_type") == "error", "large": F.col("value") > 100}
    return aggregates.count_if(base.table(spark, sf_dir, "events"), ["user_id"], conditions)


@query(
    "count_distinct",
    "SELECT o_orderpriority, count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY 1",
)
def count_distinct(spark, sf_dir):
    return aggregates.count_distinct(base.table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_custkey", "n_customers")


@query(
    "earliest_latest",
    """SELECT room_no, min(lpad(CAST(start_time_key // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(start_time_key % 60 AS VARCHAR), 2, '0')) AS first_label,
       max(lpad(CAST(end_time_key // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(end_time_key % 60 AS VARCHAR), 2, '0')) AS last_label
       FROM {bookings} GROUP BY 1""",
)
def earliest_latest(spark, sf_dir):
    labelled = base.bookings(spark, sf_dir).select(
        "room_no",
        base.clock_text("start_time_key").alias("first_label"),
        base.clock_text("end_time_key").alias("last_label"),
    )
    return aggregates.earliest_latest(labelled, ["room_no"], "first_label", "last_label")


@query(
    "days_with_failures",
    "SELECT count(DISTINCT CAST(ts AS DATE)) AS n_days FROM events WHERE event_type = 'error'",
)
def days_with_failures(spark, sf_dir):
    rows = base.table(spark, sf_dir, "events").select("event_type", date_key("ts").alias("date_key"))
    return aggregates.days_with(rows, F.col("event_type") == "error", "date_key", "n_days")
