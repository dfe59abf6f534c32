"""Partial refreshes, counts from the write, bucketed joins and pruning: files and plans."""

from __future__ import annotations

import glob
import os

from pyspark.sql import functions as F

from dialwright.examples import base, refreshes
from dialwright.plans import refresh
from dialwright.session import shared_dir
from dialwright.sources import sinks


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_untouched_partitions_keep_their_files(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-04-30')) AS full_date").selectExpr(
        "cast(date_format(full_date, 'yyyyMMdd') as int) as date_key", "full_date", "year(full_date) as year", "month(full_date) as month"
    )
    fact = days.filter("date_key % 3 <> 0").select("date_key", F.lit(1).alias("n")).cache()
    late = "date_key IN (20240210, 20240411)"
    path = shared_dir(spark, "mart")

    def build(calendar, rows):
        return calendar.join(rows.groupBy("date_key").agg(F.sum("n").alias("n")), "date_key")

    everything = days.select("date_key")
    assert len(refresh.refresh_mart(build, path, days, [fact.filter(f"NOT ({late})")], everything)) == 4
    before = files(path)
    replaced = refresh.refresh_mart(build, path, days, [fact], refresh.affected_days(fact.filter(late), fact.filter("n > 1")))
    assert sorted((p["year"], p["month"]) for p in replaced) == [(2024, 2), (2024, 4)]
    after = files(path)
    for name in before:
        assert (name in after and after[name] == before[name]) == ("month=1" in name or "month=3" in name)
    whole = build(days, fact)
    assert sorted(spark.read.parquet(path).select(*whole.columns).collect()) == sorted(whole.collect())
    assert refresh.refresh_mart(build, path, days, [fact], fact.filter("n > 1").select("date_key")) == []
    assert files(path) == after
    # A month that lost all its rows is cleared.
    gone = fact.filter("date_key NOT BETWEEN 20240301 AND 20240331")
    refresh.refresh_mart(build, path, days, [gone], spark.createDataFrame([(20240305,)], "date_key int"))
    assert {r.month for r in spark.read.parquet(path).select("month").distinct().collect()} == {1, 2, 4}


def test_second_load_replaces_only_its_months(spark, sf_dir):
    replaced = refreshes.refreshed_occupation(spark, sf_dir, shared_dir(spark, "mart"))
    months = {(p["year"], p["month"]) for p in replaced}
    assert (1995, 3) in months and all(m == (1995, 3) or m >= (2001, 4) for m in months)


def test_stretches_join_neighbouring_periods(spark):
    days = spark.createDataFrame([(d, d // 10) for d in range(10, 80)], "date_key int, month int")
    hit = spark.createDataFrame([(15,), (21,), (45,), (46,), (99,)], "date_key int")
    assert refresh._stretches(refresh.touched_periods(days, hit, ["month"]).collect()) == [(10, 29), (40, 49)]


def test_counts_come_from_one_job(spark):
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "")
    seen = sinks.write_counted(spark.range(1000), shared_dir(spark, "t"), {"odd": F.count_if(F.col("id") % 2 == 1)})
    assert seen == {"n_rows": 1000, "odd": 500} and len(jobs.getJobIdsForGroup("counted")) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    empty = sinks.write_counted(spark.range(10).filter("id < 0"), shared_dir(spark, "t"), {"most": F.max("id")})
    assert empty == {"n_rows": 0, "most": None}


def test_bucketed_facts_meet_without_a_shuffle(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        slots = refreshes.bucketed_slots(spark, sf_dir)
        slots.count()
        plan = slots._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") >= 2 and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def scans(node):
    """The file scans of an executed plan, those inside finished stages too."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return scans(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return scans(node.plan())
    below = [scans(node.children().apply(i)) for i in range(node.children().size())]
    return ([node] if kind == "FileSourceScanExec" else []) + sum(below, [])


def test_calendar_filter_prunes_folders(spark, sf_dir):
    found = refreshes.pruned_bookings(spark, sf_dir)
    months = {(r.date_key // 10000, r.date_key // 100 % 100) for r in found.collect()}
    assert months and all(year >= 1996 and month == 3 for year, month in months)
    plan = found._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    read = [s.metrics().apply("numFiles").value() for s in scans(plan) if "division_key" in s.output().toString()]
    stored = base.booking_fact(spark, sf_dir)[0].select(F.floor(F.col("date_key") / 100)).distinct().count()
    assert len(months) <= read[0] <= 2 * len(months) and stored > 10 * len(months)
