"""Projections, filters, sentinels and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialwright import fixed_values as fv
from dialwright.examples import base
from dialwright.examples.registry import query
from dialwright.functions.keys import floor_minutes
from dialwright.operators import clean, joins
from dialwright.plans import facts, silver

_VALUE = "CAST(round(value * 100) AS BIGINT)"


@query(
    "select_typed",
    """SELECT event_id AS id, TRY_CAST(substr(props, 7, 2) AS INTEGER) AS k, CAST(user_id AS VARCHAR) AS user_name,
       TRY_CAST(event_type AS INTEGER) AS no_number FROM events""",
)
def select_typed(spark, sf_dir):
    events = base.table(spark, sf_dir, "events").withColumn("k_text", F.substring("props", 7, 2))
    return clean.select_typed(
        events,
        [
            ("event_id", "id", "bigint"),
            ("k_text", "k", "int"),
            ("user_id", "user_name", "string"),
            ("event_type", "no_number", "int"),
        ],
    )


@query(
    "require_not_null",
    "SELECT event_id, user_id FROM events WHERE nullif(user_id % 7, 0) IS NOT NULL AND nullif(event_id % 5, 0) IS NOT NULL",
)
def require_not_null(spark, sf_dir):
    holes = base.table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.nullif(F.col("user_id") % 7, F.lit(0)).alias("a"),
        F.nullif(F.col("event_id") % 5, F.lit(0)).alias("b"),
    )
    return clean.require_not_null(holes, ["a", "b"]).select("event_id", "user_id")


@query(
    "regex_filter",
    r"SELECT o_orderkey, o_orderpriority FROM orders WHERE regexp_matches(o_orderpriority, '^[12]-') AND regexp_matches(o_orderstatus, '[FO]')",
)
def regex_filter(spark, sf_dir):
    orders = base.table(spark, sf_dir, "orders")
    return clean.matching(orders, {"o_orderpriority": r"^[12]-", "o_orderstatus": "[FO]"}).select(
        "o_orderkey", "o_orderpriority"
    )


@query("prefix_filter", "SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'red')")
def prefix_filter(spark, sf_dir):
    return clean.starting_with(base.table(spark, sf_dir, "part"), "p_name", "red").select("p_partkey", "p_name")


@query("isin_filter", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def isin_filter(spark, sf_dir):
    return clean.one_of(base.table(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"]).select("o_orderkey")


@query(
    "null_sentinel",
    """SELECT "Time", "Measurement", "Site", CASE WHEN abs("Value") <> 99999.0 THEN "Value" END AS "Value"
       FROM {raw_forecasts}""",
)
def null_sentinel(spark, sf_dir):
    rows = base.raw_forecasts(spark, sf_dir).select("Time", "Measurement", "Site", "Value")
    return clean.null_sentinel(rows, "Value", fv.FORECAST_SENTINELS)


@query(
    "drop_sentinel",
    """SELECT "Time", "Measurement", "Site", "Value" FROM {raw_forecasts} WHERE abs("Value") <> 99999.0""",
)
def drop_sentinel(spark, sf_dir):
    rows = base.raw_forecasts(spark, sf_dir).select("Time", "Measurement", "Site", "Value")
    return clean.drop_sentinel(rows, "Value", fv.FORECAST_SENTINELS)


@query(
    "synthetic_site",
    """SELECT "Time", "Measurement", "Prediction", "Unit", round("Value", 6) AS "Value", "Site" FROM {forecasts}""",
)
def synthetic_site(spark, sf_dir):
    mean = silver.synthetic_forecast(base.raw_forecasts(spark, sf_dir), ["North", "South"], base.SYNTHETIC_SITE)
    return mean.withColumn("Value", F.round("Value", 6))


@query("drop_negative", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0")
def drop_negative(spark, sf_dir):
    return clean.drop_negative(base.table(spark, sf_dir, "customer"), "c_acctbal").select("c_custkey", "c_acctbal")


@query(
    "clamp_nonneg",
    "SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS balance FROM customer",
)
def clamp_nonneg(spark, sf_dir):
    rows = base.table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal")).alias("balance")
    )
    return clean.clamp_min(rows, "balance")


@query("zero_as_null", "SELECT o_orderkey, CAST(nullif(o_orderkey % 50, 0) AS INTEGER) AS reservation_no FROM orders")
def zero_as_null(spark, sf_dir):
    rows = base.table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderkey") % 50).cast("string").alias("reservation_no")
    )
    return clean.zero_as_null(rows, "reservation_no")


@query(
    "flag_status",
    "SELECT event_id, coalesce(CASE WHEN user_id % 11 <> 0 THEN event_type END = 'error', false) AS is_failure FROM events",
)
def flag_status(spark, sf_dir):
    code = F.when(F.col("user_id") % 11 != 0, base.status_of())
    rows = base.table(spark, sf_dir, "events").select("event_id", code.alias("code"))
    return clean.flag_equals(rows, "code", fv.FAILURE_STATUS_CODE, "is_failure").drop("code")


@query(
    "with_constants",
    "SELECT c_custkey, 'CH' AS country, CAST(NULL AS DOUBLE) AS actual, 20240131 AS run_date_key FROM customer",
)
def with_constants(spark, sf_dir):
    rows = base.table(spark, sf_dir, "customer").select("c_custkey")
    return clean.with_constants(
        rows, {"country": ("CH", "string"), "actual": (None, "double"), "run_date_key": (20240131, "int")}
    )


@query(
    "dedupe_rows",
    "SELECT DISTINCT user_id, event_type, time_bucket(INTERVAL '15 minutes', ts) AS slot FROM events",
)
def dedupe_rows(spark, sf_dir):
    rows = base.table(spark, sf_dir, "events").select("user_id", "event_type", floor_minutes("ts", 15).alias("slot"))
    return clean.dedupe_rows(rows)


@query(
    "dedupe_latest",
    f"""SELECT event_id, user_id, event_type, {_VALUE} AS reading FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1""",
)
def dedupe_latest(spark, sf_dir):
    rows = base.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", base.cents().alias("reading"), "ts"
    )
    return clean.dedupe_by_key(rows, ["user_id", "event_type"], [F.desc("ts"), "event_id"]).drop("ts")


@query(
    "positive_intervals",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_shipdate > o_orderdate + INTERVAL 60 DAY",
)
def positive_intervals(spark, sf_dir):
    lines = base.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    orders = base.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), (F.col("o_orderdate") + F.expr("interval 60 days")).alias("due")
    )
    both = joins.join_on(lines, orders, ["l_orderkey"])
    return clean.positive_intervals(both, "due", "l_shipdate").drop("due", "l_shipdate")


@query(
    "lookup_reject",
    """SELECT event_id, user_id % 25 AS nation FROM events
       WHERE user_id % 25 NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)""",
)
def lookup_reject(spark, sf_dir):
    nations = base.table(spark, sf_dir, "nation").filter("n_regionkey < 3")
    rows = base.table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 25).alias("nation"))
    keyed = joins.lookup_key(rows, nations, {"nation": "n_nationkey"}, ["n_regionkey"])
    return clean.split_rejects(keyed, ["n_regionkey"])[1].drop("n_regionkey")


@query(
    "rename_columns",
    "SELECT c_custkey AS customer_key, c_name FROM customer",
)
def rename_columns(spark, sf_dir):
    rows = clean.rename_if_present(base.table(spark, sf_dir, "customer"), "c_custkey", "customer_key")
    rows = clean.rename_if_present(rows, "c_custkey", "customer_key")
    return clean.drop_columns(rows, ["c_nationkey", "c_acctbal", "c_mktsegment", "absent"])


@query(
    "stamped_keys",
    """SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS time_key, CAST(year(ts) AS INTEGER) AS year,
       CAST(month(ts) AS INTEGER) AS month FROM events""",
)
def stamped_keys(spark, sf_dir):
    return facts.stamped(base.table(spark, sf_dir, "events").select("event_id", "ts"), "ts").drop("ts")
