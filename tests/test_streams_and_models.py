"""Streams give what batches give, batch by batch; models train and score."""

from __future__ import annotations

import datetime as dt
import threading
from pathlib import Path

from pyspark.sql import functions as F

from dialwright.operators import timeseries
from dialwright.plans import features, forecast
from dialwright.session import local_frame, shared_dir
from dialwright.sources.sinks import write_table
from dialwright.streaming import ingest


def three_files(spark, sf_dir):
    """The events in three files, in time order."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "user_id", "ts", F.round(F.col("value") * 100).cast("bigint").alias("reading")
    )
    folder = shared_dir(spark, "events")
    edges = ["2024-01-01", "2024-01-11", "2024-01-21", "2024-02-01"]
    for low, high in zip(edges, edges[1:]):
        part = events.filter((F.col("ts") >= F.lit(low).cast("timestamp_ntz")) & (F.col("ts") < F.lit(high).cast("timestamp_ntz")))
        write_table(part.coalesce(1), folder, "append")
    return events, folder


def test_meter_delta_over_several_batches(spark, sf_dir):
    events, folder = three_files(spark, sf_dir)
    out, checkpoint = shared_dir(spark, "out"), shared_dir(spark, "checkpoint")
    stream = ingest.file_stream(spark, folder, events.schema, files_per_batch=1)
    names = (["user_id"], "ts", "reading")
    ingest.stream_meter_delta(stream, *names, out, checkpoint, tie=["event_id"])
    columns = ["event_id", "delta"]
    emitted = spark.read.parquet(out)
    assert emitted.filter("is_late").count() == 0
    # Without a delay only the newest millisecond waits.
    waiting = ingest.pending_meter_delta(spark, checkpoint, *names, tie=["event_id"])
    assert waiting.count() <= 1
    got = emitted.select(columns).unionByName(waiting.select(columns))
    expected = timeseries.meter_delta(events, *names, tie=["event_id"])
    assert got.exceptAll(expected.select(columns)).count() == 0
    assert got.count() == expected.count()


def test_late_readings_wait_for_their_place(spark):
    folder, out, checkpoint = (shared_dir(spark, n) for n in ("in", "out", "checkpoint"))
    schema = "s int, ts timestamp_ntz, reading bigint"
    at = lambda text: dt.datetime.fromisoformat(f"2024-01-01T{text}")
    files = [
        [(1, at("08:00"), 10), (1, at("08:30"), 20), (None, at("08:10"), 1)],
        [(1, at("08:15"), 15), (1, at("10:00"), 30), (None, at("08:20"), None)],
        [(1, at("08:05"), 11), (1, at("11:00"), 33), (None, at("09:00"), 7)],
    ]
    names = (["s"], "ts", "reading")
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for rows_ in files:
        write_table(local_frame(spark, rows_, schema).coalesce(1), folder, "append")
        stream = ingest.file_stream(spark, folder, schema, files_per_batch=1)
        ingest.stream_meter_delta(stream, *names, out, checkpoint, delay="20 minutes")
    found = spark.read.parquet(out).collect()
    emitted = sorted((r["ts"].strftime("%H:%M"), r["delta"]) for r in found if r["s"] == 1 and not r["is_late"])
    assert emitted == [("08:00", None), ("08:15", 5), ("08:30", 5), ("10:00", 10)]
    assert [(r["s"], r["reading"], r["delta"]) for r in found if r["is_late"]] == [(1, 11, None)]
    # Readings without a series are a series; a missing value has no delta, and none follows it.
    assert sorted((r["ts"].strftime("%H:%M"), r["delta"]) for r in found if r["s"] is None) == [("08:10", None), ("08:20", None), ("09:00", None)]
    waiting = ingest.pending_meter_delta(spark, checkpoint, *names).collect()
    assert [(r["ts"].strftime("%H:%M"), r["delta"]) for r in waiting] == [("11:00", 3)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider


def test_many_series_share_the_buckets_of_the_state(spark):
    folder, out, checkpoint = (shared_dir(spark, n) for n in ("in", "out", "checkpoint"))
    # 300 series, some of them without a name; times of the second delivery overlap those of the first.
    rows = spark.range(3000).selectExpr(
        "nullif(id % 30, 3) AS meter",
        "if(id % 10 = 4, null, concat('p', id % 10 + id % 300 div 30)) AS part",
        "id AS event_id",
        "if(id % 11 = 5, null, timestampadd(SECOND, cast(id div 300 * 600 + id % 7 * 60 AS int), timestamp_ntz'2024-01-01')) AS ts",
        "if(id % 13 = 6, null, 1152921504606846977 + id % 600 * 3) AS reading",
        "cast(id AS decimal(20,3)) / 7 AS price",
        "timestamp_seconds(id) AS sent",
        "if(id % 5 = 0, null, id / 3) AS level",
    )
    names = (["meter", "part"], "ts", "reading")
    for turn in range(3):
        write_table(rows.filter(f"least(event_id div 1000 + if(event_id % 9 = 0, 1, 0), 2) = {turn}").coalesce(2), folder, "append")
        stream = ingest.file_stream(spark, folder, rows.schema)
        ingest.stream_meter_delta(stream, *names, out, checkpoint, tie=["event_id"], delay="3 hours", buckets=4)
    emitted = spark.read.parquet(out)
    # The first readings without a time come out at once; those of later deliveries are older than what has come out.
    late = emitted.filter("is_late")
    assert late.count() > 0 and late.filter("ts IS NOT NULL OR delta IS NOT NULL").count() == 0
    with ingest._state_in_rocksdb(spark):
        assert spark.read.format("statestore").option("path", checkpoint).load().count() <= 4
    waiting = ingest.pending_meter_delta(spark, checkpoint, *names, tie=["event_id"])
    assert waiting.count() > 0
    got = emitted.filter("NOT is_late").drop("is_late").unionByName(waiting)
    expected = timeseries.meter_delta(rows.join(late.select("event_id"), "event_id", "left_anti"), *names, tie=["event_id"])
    assert got.schema["sent"].dataType == rows.schema["sent"].dataType
    assert got.count() == expected.count() == 3000 - late.count()
    assert got.exceptAll(expected.select(got.columns)).count() == 0


def test_new_files_are_read_once(spark, sf_dir):
    events, folder = three_files(spark, sf_dir)
    out, checkpoint = shared_dir(spark, "ingested"), shared_dir(spark, "checkpoint")
    stream = ingest.file_stream(spark, folder, events.schema)
    ingest.ingest_new_files(stream, out, checkpoint)
    write_table(events.limit(7).coalesce(1), folder, "append")
    ingest.ingest_new_files(stream, out, checkpoint)
    assert spark.read.parquet(out).count() == events.count() + 7


def test_upsert_over_several_batches(spark, sf_dir):
    events, folder = three_files(spark, sf_dir)
    write_table(events.filter("event_id % 10 = 0").coalesce(1), folder, "append")
    out, checkpoint = shared_dir(spark, "upserted"), shared_dir(spark, "checkpoint")

    def merge(batch, current):
        rows = batch if current is None else batch.unionByName(current)
        return rows.groupBy("part", "user_id").agg(F.max("event_id").alias("event_id"))

    stream = ingest.file_stream(spark, folder, events.schema, files_per_batch=1)
    keyed = stream.select("user_id", "event_id", (F.col("user_id") % 4).cast("int").alias("part"))
    ingest.upsert_batches(keyed, out, checkpoint, ["part"], merge)
    expected = events.groupBy("user_id").agg(F.max("event_id").alias("event_id"))
    got = spark.read.parquet(out).select("user_id", "event_id")
    # What was merged aside is gone once it has been swapped in.
    assert not list(Path(checkpoint.removeprefix("file:") + "-merged").glob("batch=*"))
    assert got.exceptAll(expected).count() == 0 and got.count() == expected.count()


def test_models_train_select_and_score(spark):
    rows = spark.range(400).select(
        (F.col("id") % 24).cast("int").alias("hour"),
        (F.col("id") % 7).cast("int").alias("day_of_week"),
        # A plane in both features: only the linear model can fit it exactly.
        ((F.col("id") % 24) * 3.0 + (F.col("id") % 7) * 5.0 - 10).alias("kwh"),
        F.timestamp_seconds("id").alias("ts"),
    )
    model = forecast.train_gbt(rows, ["hour", "day_of_week"], "kwh", trees=5)
    scored = forecast.predict(model, rows)
    assert scored.filter("predicted < 0").count() == 0 and scored.count() == 400
    holes = rows.withColumn("hour", F.when(F.col("kwh") > 20, F.col("hour")))
    assert forecast.predict(forecast.train_gbt(holes, ["hour", "day_of_week"], "kwh", trees=2), holes).filter("predicted IS NOT NULL").count() == 400
    scores, best = forecast.select_model(rows, ["hour", "day_of_week"], "kwh", folds=2, trees=2)
    ranked = scores.orderBy("rmse").collect()
    assert len(ranked) == 4 and ranked[0]["is_best"] and not any(r["is_best"] for r in ranked[1:])
    assert ranked[0]["algorithm"] == "linear_regression"
    assert best.transform(rows).count() == 400


def test_training_rows_take_as_few_tasks_as_their_number_allows(spark, monkeypatch):
    rows = spark.range(400).selectExpr("id", "id * 2.0 AS kwh").repartition(50)
    with forecast._kept(rows) as kept:
        assert kept.rdd.getNumPartitions() == 1 and kept.count() == 400
    monkeypatch.setattr(forecast, "_ROWS_PER_TASK", 100)
    with forecast._kept(rows) as kept:
        assert kept.rdd.getNumPartitions() == 4 and kept.distinct().count() == 400
    with forecast._kept(rows.filter("false")) as kept:
        assert kept.count() == 0


def test_candidates_are_fitted_side_by_side(spark, monkeypatch):
    rows = spark.range(200).selectExpr("cast(id % 24 AS int) AS hour", "id % 24 * 3.0 + id % 5 AS kwh", "timestamp_seconds(id) AS ts")
    threads, build = [], forecast._pipeline

    def watched(*args):
        threads.append(threading.get_ident())
        return build(*args)

    monkeypatch.setattr(forecast, "_pipeline", watched)
    found = {}
    for parallelism in (1, 3):
        threads.clear()
        scores, _ = forecast.select_model(rows, ["hour"], "kwh", folds=2, trees=2, parallelism=parallelism)
        found[parallelism] = sorted((r.algorithm, round(r.rmse, 9), r.is_best) for r in scores.collect())
        # Eight fits to judge by in the pool, and the winner outside of it.
        assert len(threads) == 9 and len(set(threads[:-1])) == parallelism
    assert found[1] == found[3] and len(found[1]) == 4


def test_feature_export_has_text_timestamps(spark):
    df = spark.sql("SELECT timestamp_ntz'2023-03-01 00:15:00' AS ts, 1 AS x")
    assert features.as_text_timestamp(df).collect()[0]["timestamp"] == "2023-03-01 00:15:00"


def test_naive_takes_the_value_a_season_before(spark):
    rows = spark.sql("""SELECT * FROM VALUES (timestamp'2024-01-01 00:00', 1, 10.0), (timestamp'2024-01-01 12:00', 1, 20.0),
        (timestamp'2024-01-02 00:00', 1, 30.0), (timestamp'2024-01-02 13:00', 1, null), (timestamp'2024-01-03 14:00', 1, 5.0),
        (timestamp'2024-01-02 01:00', 2, 7.0) AS t(ts, meter, kwh)""")
    naive = forecast.seasonal_naive(rows, "kwh", by=["meter"])
    found = [float(r.naive) if r.naive is not None else None for r in naive.orderBy("meter", "ts").collect()]
    assert found == [None, None, 10.0, 20.0, 30.0, None]
    report = forecast.skill(naive.withColumn("exact", F.col("kwh")), "kwh", ["exact"], against="naive").first()
    assert (report.n_scored, report.exact_rmse, report.exact_skill) == (2, 0.0, 1.0)
    nothing = forecast.skill(naive.filter("false").withColumn("exact", F.col("kwh")), "kwh", ["exact"], against="naive").first()
    assert nothing.n_scored == 0 and nothing.exact_skill is None


def test_boosted_trees_beat_naive_and_mean_where_the_features_tell(spark):
    hour = F.hour("ts")
    light = F.when(hour.between(7, 18), F.sin((hour - 6) * 0.25) * (400 + F.pmod(F.xxhash64(F.to_date("ts")), F.lit(400))))
    rows = spark.sql("SELECT explode(sequence(timestamp'2024-01-01', timestamp'2024-02-09', INTERVAL 1 HOUR)) AS ts").withColumns(
        {"light": F.coalesce(light, F.lit(0.0)), "temp": F.pmod(F.xxhash64("ts"), F.lit(20)).cast("double")}
    )
    rows = rows.withColumn("kwh", F.col("light") * 0.02 + F.col("temp") * 0.01)
    train, test = forecast.time_split(forecast.seasonal_naive(rows, "kwh"), "ts", "2024-01-31")
    model = forecast.train_gbt(train, ["light", "temp"], "kwh", trees=10)
    scored = forecast.predict(model, test, "gbt").withColumn("mean", train.agg(F.avg("kwh").alias("mean")).scalar())
    found = forecast.skill(scored, "kwh", ["gbt", "mean"], against="naive").first()
    assert found.n_scored == 9 * 24 - 23 and found.gbt_skill > 0.5 and found.gbt_rmse < 0.5 * found.mean_rmse
