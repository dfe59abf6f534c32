"""Structured Streaming over the events file, run until it is drained."""

from __future__ import annotations

from pyspark.sql import functions as F

from dialwright.examples import base
from dialwright.examples.registry import query
from dialwright.examples.series import METER_SQL
from dialwright.functions.keys import date_key
from dialwright.session import shared_dir
from dialwright.sources.sinks import write_table
from dialwright.streaming import ingest


def events_stream(spark, sf_dir):
    schema = base.table(spark, sf_dir, "events").schema
    return ingest.file_stream(spark, sf_dir, schema, pattern="events.parquet")


@query("stream_ingest", "SELECT event_id, user_id, event_type, value FROM events")
def stream_ingest(spark, sf_dir):
    out, checkpoint = shared_dir(spark, "ingest"), shared_dir(spark, "ingest-checkpoint")
    stream = events_stream(spark, sf_dir).select("event_id", "user_id", "event_type", "value")
    ingest.ingest_new_files(stream, out, checkpoint)
    # A second run finds nothing new.
    ingest.ingest_new_files(stream, out, checkpoint)
    return spark.read.parquet(out)


@query("stream_dedupe", "SELECT event_id, user_id, ts FROM events")
def stream_dedupe(spark, sf_dir):
    out, checkpoint = shared_dir(spark, "dedupe"), shared_dir(spark, "dedupe-checkpoint")
    once = events_stream(spark, sf_dir).select("event_id", "user_id", "ts")
    twice = once.union(events_stream(spark, sf_dir).select("event_id", "user_id", "ts"))
    ingest.ingest_new_files(ingest.dedupe_stream(twice, "ts", ["event_id"], "1 hour"), out, checkpoint)
    return spark.read.parquet(out)


@query(
    "stream_tumbling",
    """SELECT time_bucket(INTERVAL '15 minutes', ts) AS window_start,
       time_bucket(INTERVAL '15 minutes', ts) + INTERVAL 15 MINUTE AS window_end, event_type, count(*) AS n,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1, 2, 3
       HAVING window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
)
def stream_tumbling(spark, sf_dir):
    """Only windows the watermark has closed are written."""
    out, checkpoint = shared_dir(spark, "tumbling"), shared_dir(spark, "tumbling-checkpoint")
    aggregates = {"n": F.count(F.lit(1)), "total": F.sum(base.cents())}
    windows = ingest.tumbling(events_stream(spark, sf_dir), "ts", ["event_type"], aggregates, "10 minutes")
    ingest.ingest_new_files(windows, out, checkpoint)
    return spark.read.parquet(out)


def deliveries(parts, folder):
    """Write each part as one delivery with Spark's own partitions; gives the number of files of a delivery."""
    tasks = 4
    for part in parts:
        write_table(part.repartition(tasks), folder, "append")
    return tasks


@query("stream_meter_delta", METER_SQL)
def stream_meter_delta(spark, sf_dir):
    """The events in four deliveries; every ninth reading is in the delivery after the one it belongs to."""
    folder, out, checkpoint = (shared_dir(spark, f"meter-{part}") for part in ("in", "out", "checkpoint"))
    events = base.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", base.cents().alias("reading"))
    week = F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(3))
    delivery = F.least(week + F.when(F.col("event_id") % 9 == 0, 1).otherwise(0), F.lit(3))
    files = deliveries([events.filter(delivery == number) for number in range(4)], folder)
    stream = ingest.file_stream(spark, folder, events.schema, files_per_batch=files)
    names = (["user_id"], "ts", "reading")
    buckets = max(32, events.count() // 50_000)  # each key of the state holds about as many readings at any size
    ingest.stream_meter_delta(stream, *names, out, checkpoint, tie=["event_id"], delay="9 days", buckets=buckets)
    waiting = ingest.pending_meter_delta(spark, checkpoint, *names, tie=["event_id"])
    return spark.read.parquet(out).drop("is_late").unionByName(waiting).drop("ts")


@query(
    "stream_upsert",
    """SELECT user_id, event_type, CAST(max(event_id) AS BIGINT) AS event_id,
       CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key FROM events GROUP BY user_id, event_type, date_key""",
)
def stream_upsert(spark, sf_dir):
    """Latest event per user, type and day; only the touched days are rewritten."""
    key = ["date_key", "user_id", "event_type"]
    out, checkpoint = shared_dir(spark, "upsert"), shared_dir(spark, "upsert-checkpoint")

    def merge(batch, current):
        rows = batch if current is None else batch.unionByName(current)
        return rows.groupBy(*key).agg(F.max("event_id").alias("event_id"))

    events = base.table(spark, sf_dir, "events")
    folder = shared_dir(spark, "upsert-in")
    # Three deliveries, the first of them empty.
    files = deliveries([events.filter("false"), events.filter("event_id % 3 = 0"), events.filter("event_id % 3 > 0")], folder)
    arriving = ingest.file_stream(spark, folder, events.schema, files_per_batch=files)
    stream = arriving.select("event_id", "user_id", "event_type", date_key("ts").alias("date_key"))
    ingest.upsert_batches(stream, out, checkpoint, ["date_key"], merge)
    return spark.read.schema("user_id bigint, event_type string, event_id bigint, date_key int").parquet(out)
