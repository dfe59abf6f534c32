"""Windows over series: equality with plain windows, and the shape of the plans."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dialwright.functions.keys import assign_keys, floor_minutes
from dialwright.operators import increments, reshape, scans, timeseries
from dialwright.operators.aggregates import bounds
from dialwright.session import local_frame

T0 = dt.datetime(2023, 3, 1, 8, 0)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark, sf_dir):
    """A third of all readings belongs to one series; some values and keys are missing."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(7)).when(F.col("event_id") % 17 == 0, F.lit(None)).otherwise(F.col("user_id"))
    value = F.when(F.col("event_id") % 5 != 0, F.round(F.col("value") * 100).cast("bigint"))
    return events.select("event_id", "ts", hot.cast("bigint").alias("series"), value.alias("v"))


@pytest.mark.parametrize("segments", [1, 7, None])
@pytest.mark.parametrize("series", [["series"], []])
def test_deltas_equal_plain_windows(skewed, series, segments):
    w = Window.partitionBy(*series).orderBy("ts", "event_id")
    previous = F.lag("v").over(w)
    expected = skewed.select("event_id", F.when(F.col("v") >= previous, F.col("v") - previous).alias("d"))
    mine = timeseries.meter_delta(skewed, series, "ts", "v", "d", ["event_id"], segments).select("event_id", "d")
    assert mine.exceptAll(expected).count() == 0 and mine.count() == expected.count()
    expected = skewed.select("event_id", (F.col("v") - previous).alias("d"))
    mine = timeseries.sensor_delta(skewed, series, "ts", "v", "d", ["event_id"], segments).select("event_id", "d")
    assert mine.exceptAll(expected).count() == 0 and mine.count() == expected.count()


@pytest.mark.parametrize("segments", [1, 7, None])
def test_fills_equal_plain_windows(skewed, segments):
    w = Window.partitionBy("series").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    expected = skewed.select("event_id", F.last("v", ignorenulls=True).over(w).alias("v"))
    mine = timeseries.fill_forward(skewed, ["series"], "ts", ["v"], tie=["event_id"], segments=segments)
    assert mine.select("event_id", "v").exceptAll(expected).count() == 0
    expected = skewed.select("event_id", F.round(F.avg("v").over(w), 6).alias("v"))
    mine = timeseries.fill_forward(skewed, ["series"], "ts", ["v"], "running_mean", ["event_id"], segments)
    assert mine.select("event_id", F.round("v", 6).alias("v")).exceptAll(expected).count() == 0


def test_unknown_fill_mode(skewed):
    with pytest.raises(ValueError, match="unknown fill mode"):
        timeseries.fill_forward(skewed, [], "ts", ["v"], "linear")


@pytest.mark.parametrize("mode,expected", [("last", [1.0, 1.0, 4.0]), ("running_mean", [1.0, 1.0, 2.5])])
def test_fill_modes(spark, mode, expected):
    df = local_frame(spark, [(at(0), 1.0), (at(15), None), (at(30), 4.0)], "ts timestamp_ntz, v double")
    assert [r["v"] for r in timeseries.fill_forward(df, [], "ts", ["v"], mode).orderBy("ts").collect()] == expected


def test_meter_reset(spark):
    df = local_frame(spark, [(at(15 * i), v) for i, v in enumerate((10, 15, 3, 7))], "ts timestamp_ntz, v int")
    assert [r["delta"] for r in timeseries.meter_delta(df, [], "ts", "v").orderBy("ts").collect()] == [None, 5, None, 4]


def test_asof_equals_brute_force(skewed):
    left, right = skewed.filter("event_id % 2 = 0").drop("v"), skewed.filter("event_id % 2 = 1")
    lefts, rights = left.collect(), right.collect()
    for tolerance in (None, 240):
        mine = timeseries.asof_join(left, right, ["series"], "ts", ["v"], tolerance, ["event_id"], 5)
        got = {r["event_id"]: r["v"] for r in mine.collect()}
        assert len(got) == len(lefts)
        for l in lefts:
            candidates = [r for r in rights if r["series"] == l["series"] and r["ts"] <= l["ts"]]
            best = max(candidates, key=lambda r: (r["ts"], r["event_id"]), default=None)
            if best and tolerance and l["ts"] - best["ts"] > dt.timedelta(minutes=tolerance):
                best = None
            assert got[l["event_id"]] == (best["v"] if best else None)


def test_no_raw_row_passes_a_single_task(skewed):
    """The only unpartitioned exchange carries one row per segment."""
    text = plan(timeseries.meter_delta(skewed, [], "ts", "v", tie=["event_id"]))
    after = [text.split("\n")[i + 1] for i, line in enumerate(text.split("\n")) if "SinglePartition" in line]
    assert after and all("Aggregate(key" in line and "__segment" in line for line in after)
    assert "SinglePartition" not in plan(timeseries.meter_delta(skewed, ["series"], "ts", "v", tie=["event_id"]))


@pytest.mark.parametrize("order", [["ts", "event_id"], ["ts"]])
def test_a_hot_series_is_split_evenly(skewed, order):
    """A third of all rows in one series, in one hour or in one instant: no segment above three times the median."""
    hour = F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("event_id") % (3600 if len(order) > 1 else 1))
    hot = skewed.withColumn("ts", F.when(F.col("series") == 7, hour).otherwise(F.col("ts")))
    sizes = [r["count"] for r in scans.segmented(hot, ["series"], order, 16).groupBy(scans.SEGMENT).count().collect()]
    assert len(sizes) >= 12 and max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2]


def test_running_sums(skewed):
    w = Window.partitionBy("series").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    expected = skewed.select("event_id", F.sum("v").over(w).alias("total"), F.count(F.lit(1)).over(w).alias("n"))
    placed = scans.segmented(skewed, ["series"], ["ts", "event_id"], 9)
    mine = scans.running_sums(placed, ["series"], ["ts", "event_id"], {"total": F.col("v"), "n": F.lit(1)}).select("event_id", "total", "n")
    assert mine.exceptAll(expected).count() == 0 and mine.count() == expected.count()


def test_watermark_range_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert "GreaterThanOrEqual(ts,2024-01-16T00:00)" in plan(increments.after_watermark(events, "ts", 20240115))
    loaded = events.select(F.lit(20240115).alias("date_key"))
    late = increments.after_watermark(events, "ts", loaded)
    late.collect()
    # The bare column beside a finished scalar: the scan puts its value into the pushed filter.
    assert re.search(r"DataFilters: \[isnotnull\(ts#\d+\), \(ts#\d+ >= (Reused)?Subquery", plan(late))


def test_group_limit_on_both_sides_of_the_shuffle(skewed):
    assert plan(timeseries.first_per_group(skewed, ["series"], ["ts", "event_id"])).count("WindowGroupLimit") == 2


def test_half_open_and_inclusive_slots(spark):
    df = local_frame(
        spark,
        [(1, at(0), at(60)), (2, at(5), at(20)), (3, at(0), at(0)), (4, at(30), at(0)), (5, at(0), at(3 * 1440))],
        "id int, a timestamp_ntz, b timestamp_ntz",
    )

    def counts(inclusive):
        slots = reshape.explode_slots(df, "a", "b", end_inclusive=inclusive).groupBy("id").count()
        return {r["id"]: r["count"] for r in slots.collect()}

    assert counts(False) == {1: 4, 2: 2, 5: 3 * 96}
    assert counts(True) == {1: 5, 2: 2, 3: 1, 5: 3 * 96 + 1}


def test_grid_starts_at_the_first_value(spark):
    df = local_frame(spark, [("a", at(7)), ("a", at(7 + 3000)), ("b", at(1))], "k string, ts timestamp_ntz")
    grid = reshape.time_grid(bounds(df, "ts", ["k"]), "lo", "hi", "ts", 15)
    rows = sorted(tuple(r) for r in grid.collect())
    assert rows == [("a", at(7 + 15 * i)) for i in range(201)] + [("b", at(1))]


def test_unpivot_then_pivot_is_the_identity(spark, sf_dir):
    wide = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.monotonically_increasing_id().alias("id"), "l_quantity", "l_discount"
    )
    groups = {"q": {"m": "l_quantity"}, "d": {"m": "l_discount"}}
    long = reshape.unpivot_groups(wide, ["id"], "unit", groups, {"m": "double"})
    back = reshape.pivot_measures(long, ["id"], "unit", "m", {"q": "l_quantity", "d": "l_discount"})
    assert back.exceptAll(wide).count() == 0 and back.count() == wide.count()


def test_floor_keeps_local_clock_time(spark):
    df = local_frame(spark, [(dt.datetime(1901, 5, 6, 7, 59, 59, 999999),), (at(15),)], "ts timestamp_ntz")
    rows = [r[0] for r in df.select(floor_minutes("ts", 15)).collect()]
    assert rows == [dt.datetime(1901, 5, 6, 7, 45), at(15)]


def test_assigned_keys_are_dense_and_stable(spark, sf_dir):
    names = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_name")
    first = {r["c_name"]: r["k"] for r in assign_keys(names, ["c_name"], "k", 10).collect()}
    again = {r["c_name"]: r["k"] for r in assign_keys(names.repartition(7), ["c_name"], "k", 10).collect()}
    assert first == again and sorted(first.values()) == list(range(11, 11 + len(first)))
