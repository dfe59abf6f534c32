"""Raw-file formats: written from the tables by Spark, read back and cleaned."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialwright.examples import base, marts
from dialwright.examples.registry import query
from dialwright.functions.keys import floor_minutes
from dialwright.plans import features, silver
from dialwright.session import shared_dir
from dialwright.sources import files, readers, sinks


def _sensor_text(spark, sf_dir):
    """Events as a sensor export: dotted dates, units after numbers, a junk line per hundred."""
    junk = F.col("event_id") % 100 == 0
    day = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "dd.MM.yyyy")).otherwise(F.date_format("ts", "dd.MM.yy"))
    amount = F.concat(F.col("value").cast("decimal(12,2)").cast("string"), F.lit(" kWh"))
    return base.table(spark, sf_dir, "events").select(
        F.when(junk, "footer").otherwise(day).alias("Datum"),
        F.when(junk, "-").otherwise(F.date_format("ts", "HH:mm:ss")).alias("Zeit"),
        F.lit("kWh").alias("Einheit"),
        amount.alias("Wert"),
        amount.alias("Variation"),
    )


_SENSOR_SQL = """SELECT DISTINCT date_trunc('second', ts) AS ts, value AS reading, value AS variation
       FROM events WHERE event_id % 100 <> 0"""


def _utf16_readings(spark, sf_dir):
    path = shared_dir(spark, "sensor")
    writer = _sensor_text(spark, sf_dir).write.option("header", True).option("sep", ";").option("quoteAll", True)
    writer.option("encoding", "UTF-16LE").csv(path)
    return readers.read_sensor_csv(spark, path, "reading", "variation")


@query("read_sensor_utf16", _SENSOR_SQL)
def read_sensor_utf16(spark, sf_dir):
    return silver.sensor_readings(_utf16_readings(spark, sf_dir), "reading", "variation")


_METER_SQL = """SELECT ts, reading, {expression} AS variation FROM ({source})
       WINDOW w AS (ORDER BY ts, reading)"""


@query(
    "silver_meter",
    _METER_SQL.format(
        expression="CASE WHEN reading >= lag(reading) OVER w THEN round(reading - lag(reading) OVER w, 4) END",
        source=_SENSOR_SQL,
    ),
)
def silver_meter(spark, sf_dir):
    rows = silver.meter_readings(_utf16_readings(spark, sf_dir), "reading", "variation")
    return rows.withColumn("variation", F.round("variation", 4))


@query(
    "silver_sensor",
    _METER_SQL.format(expression="round(reading - lag(reading) OVER w, 4)", source=_SENSOR_SQL),
)
def silver_sensor(spark, sf_dir):
    rows = silver.instant_readings(_utf16_readings(spark, sf_dir), "reading", "variation")
    return rows.withColumn("variation", F.round("variation", 4))


@query(
    "read_positional",
    """SELECT log_timestamp, unit_id, ac_power_w, CAST(NULL AS DOUBLE) AS daysum, status_code,
       CAST(NULL AS DOUBLE) AS pdc1, CAST(NULL AS DOUBLE) AS pdc2, CAST(NULL AS DOUBLE) AS udc1, CAST(NULL AS DOUBLE) AS udc2,
       coalesce(status_code = 14, false) AS is_failure FROM (
         SELECT DISTINCT date_trunc('minute', ts) AS log_timestamp FROM events)
       CROSS JOIN (SELECT CAST(unnest(generate_series(1, 5)) AS INTEGER) AS unit_id)
       LEFT JOIN (SELECT date_trunc('minute', log_timestamp) AS log_timestamp, unit_id, sum(ac_power_w) AS ac_power_w,
                         CAST(max(status_code) AS INTEGER) AS status_code FROM {readings} GROUP BY 1, 2)
         USING (log_timestamp, unit_id)""",
)
def read_positional(spark, sf_dir):
    """The wide device log: one line per minute, one column group per unit."""
    rows = base.readings(spark, sf_dir).withColumn("minute", floor_minutes("log_timestamp", 1))
    aggregates = []
    for unit in range(1, 6):
        mine = F.col("unit_id") == unit
        aggregates += [
            F.sum(F.when(mine, F.col("ac_power_w"))).alias(f"pac_{unit}"),
            F.max(F.when(mine, F.col("status_code"))).alias(f"status_{unit}"),
        ]
    lines = rows.groupBy("minute").agg(*aggregates)
    names = silver.device_log_names()
    cells = {"date_raw": F.date_format("minute", "yyyy-MM-dd"), "time_raw": F.date_format("minute", "HH:mm:ss")}
    wide = lines.select(*[cells.get(n, F.col(n) if n in lines.columns else F.lit("")).alias(n) for n in names])
    path = shared_dir(spark, "device-log")
    wide.write.option("header", True).option("sep", ";").csv(path)
    return silver.device_readings(readers.read_positional_csv(spark, path, names))


@query("read_csv", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def read_csv(spark, sf_dir):
    """Two deliveries that order their columns differently."""
    path = shared_dir(spark, "csv")
    customers = base.table(spark, sf_dir, "customer")
    first = customers.filter("c_custkey % 2 = 0").select("c_custkey", "c_name", "c_acctbal")
    second = customers.filter("c_custkey % 2 = 1").select("c_acctbal", "c_mktsegment", "c_custkey", "c_name")
    for rows in (first, second):
        rows.write.mode("append").option("header", True).csv(path)
    return readers.read_csv(spark, path, "c_custkey bigint, c_name string, c_acctbal double")


@query(
    "masked_bookings",
    """SELECT 'HQ-1.R' || (o_orderkey % 30) AS "Nom", sha256('Person ' || (o_custkey % 90)) AS professor_masked,
       CAST(o_orderkey AS VARCHAR) AS "Numero" FROM orders WHERE o_orderkey % 4 <> 0""",
)
def masked_bookings(spark, sf_dir):
    """A TSV export with quotes inside its cells; a quarter of the rooms lies elsewhere."""
    building = F.when(F.col("o_orderkey") % 4 == 0, "HQ-2.R").otherwise("HQ-1.R")
    room = F.concat(F.lit('"'), building, (F.col("o_orderkey") % 30).cast("string"), F.lit('"'))
    rows = base.table(spark, sf_dir, "orders").select(
        room.alias("Nom"),
        F.concat(F.lit("Person "), (F.col("o_custkey") % 90).cast("string")).alias("Professeur"),
        F.col("o_orderkey").cast("string").alias("Numero"),
    )
    path = shared_dir(spark, "bookings")
    rows.write.option("header", True).option("sep", "\t").option("quote", "").csv(path)
    raw = readers.read_tsv_unquoted(spark, path)
    return silver.masked_bookings(raw, "Nom", "HQ-1", {"Professeur": "professor_masked"})


@query(
    "predictions_file",
    """SELECT ts, max(CASE WHEN v < 0 THEN 0 ELSE v END) AS predicted FROM (
         SELECT date_trunc('second', ts) AS ts, value - 50 AS v FROM events WHERE event_id % 13 <> 0) GROUP BY 1""",
)
def predictions_file(spark, sf_dir):
    """Predictions with negative values, repeated and unreadable timestamps."""
    stamp = F.when(F.col("event_id") % 13 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    rows = base.table(spark, sf_dir, "events").select(
        stamp.alias("timestamp"), (F.col("value") - 50).alias("predicted"), "event_id"
    )
    path = shared_dir(spark, "predictions")
    for part in (rows.filter("event_id % 2 = 0"), rows.filter("event_id % 2 = 1").select("predicted", "timestamp")):
        part.drop("event_id").write.mode("append").option("header", True).csv(path)
    return silver.predictions(readers.read_validated(spark, path, ["timestamp", "predicted"]), "predicted")


@query(
    "file_names",
    "SELECT 'orders.parquet' AS file_name, o_orderstatus, count(*) AS n FROM orders GROUP BY 2",
)
def file_names(spark, sf_dir):
    named = files.with_file_name(base.table(spark, sf_dir, "orders"))
    return named.groupBy("file_name", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("csv_export", "SELECT * FROM {export}")
def csv_export(spark, sf_dir):
    """The flat export as one clean file; its size is bounded by days x units x statuses."""
    report = marts.export(spark, sf_dir)
    folder = shared_dir(spark, "export")
    sinks.export_csv(report, folder, single=True)
    sinks.promote_part(spark, folder, f"{folder}.csv")
    return readers.read_csv(spark, f"{folder}.csv", report.schema)


@query(
    "route_partitions",
    """SELECT CASE WHEN event_type = 'view' THEN 'temperature' WHEN event_type = 'click' THEN 'humidity'
       WHEN event_type = 'purchase' THEN 'consumption' ELSE 'others' END AS route, event_id FROM events""",
)
def route_partitions(spark, sf_dir):
    """Rows are stored under the folder their file name calls for."""
    names = F.create_map(*[F.lit(x) for x in ("view", "Room_TEMP.csv", "click", "room_humi.csv", "purchase", "CONSO.csv")])
    file_name = F.coalesce(F.try_element_at(names, F.col("event_type")), F.lit("PV.csv"))
    rows = base.table(spark, sf_dir, "events").select("event_id", file_name.alias("file_name"))
    path = shared_dir(spark, "routes")
    sinks.write_table(files.route_by_filename(rows).drop("file_name"), path, partition_by=["route"])
    return spark.read.schema("event_id bigint, route string").parquet(path)


@query(
    "positional_rejects",
    "SELECT CAST(event_id AS VARCHAR) || ';' || event_type AS line FROM events WHERE event_id % 7 = 0",
)
def positional_rejects(spark, sf_dir):
    """Lines that lack a cell come back as rejects; the others load."""
    events = base.table(spark, sf_dir, "events")
    number = F.col("event_id").cast("string")
    line = F.concat_ws(";", number, "event_type", F.when(F.col("event_id") % 7 != 0, F.col("user_id").cast("string")))
    path = shared_dir(spark, "short-lines")
    # Written as one cell under a header, so that every file starts with one.
    lines = events.select(line.alias("n;n;n"))
    lines.write.option("header", True).option("quote", "").option("sep", "\t").csv(path)
    return readers.positional_rejects(spark, path, ["a", "b", "c"]).select("line")


@query(
    "listed_new_files",
    "SELECT DISTINCT 'event_type=' || event_type AS folder FROM events WHERE event_type NOT IN ('view', 'click')",
)
def listed_new_files(spark, sf_dir):
    """Files of a real folder whose delivery has not been ingested yet."""
    path = shared_dir(spark, "deliveries")
    events = base.table(spark, sf_dir, "events").select("event_id", "event_type")
    sinks.write_table(events, path, partition_by=["event_type"])
    listing = files.list_files(spark, path, "*.parquet").withColumn("folder", F.element_at(F.split("path", "/"), -2))
    done = events.filter("event_type IN ('view', 'click')").select(F.concat(F.lit("event_type="), "event_type").alias("folder"))
    return files.new_files(listing.filter("length > 0"), done, "folder").select("folder").distinct()


@query("repeated_headers", "SELECT CAST(event_id AS VARCHAR) AS n0, event_type AS kind, CAST(user_id AS VARCHAR) AS n2 FROM events")
def repeated_headers(spark, sf_dir):
    """A header that names two columns alike: one gets its position, one a meaning."""
    events = base.table(spark, sf_dir, "events")
    lines = F.concat_ws("\t", F.col("event_id").cast("string"), "event_type", F.col("user_id").cast("string"))
    path = shared_dir(spark, "repeated-headers")
    # One cell per line under a header that reads as three.
    events.select(lines.alias("n\tx\tn")).write.option("header", True).option("quote", "").option("sep", "|").csv(path)
    return readers.read_tsv_unquoted(spark, path, meanings={1: "kind"})


@query(
    "config_round_trip",
    """SELECT c_nationkey AS code, CASE WHEN c_nationkey % 2 = 0 THEN 'new' ELSE 'old' END AS name, count(*) AS kept
       FROM customer GROUP BY c_nationkey""",
)
def config_round_trip(spark, sf_dir):
    """A JSON configuration is written, merged by key and read back; a missing one gives the default."""
    rows = base.table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("code")).agg(F.count(F.lit(1)).alias("kept"))
    path = shared_dir(spark, "config")
    sinks.write_config(rows.withColumn("name", F.lit("old")), path, ["code"])
    sinks.write_config(rows.filter("code % 2 = 0").select("code", F.lit("new").alias("name")), path, ["code"])
    schema = "code int, name string, kept bigint"
    nothing = rows.select("code", F.lit("default").alias("name"), "kept").filter("false")
    missing = readers.read_config(spark, f"{path}-absent", schema, nothing)
    return spark.read.schema(schema).json(path).unionByName(missing)


@query(
    "text_timestamps",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS \"timestamp\" FROM events",
)
def text_timestamps(spark, sf_dir):
    return features.as_text_timestamp(base.table(spark, sf_dir, "events").select("ts", "event_id"))
