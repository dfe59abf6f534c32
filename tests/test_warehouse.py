"""Dimension and fact loads: idempotence, effective dating, regression of known traps."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dialwright import fixed_values as fv
from dialwright.examples import base
from dialwright.functions.keys import date_key
from dialwright.operators import access, dimensions, increments, joins, quality
from dialwright.plans import facts, marts
from dialwright.session import local_frame, shared_dir
from dialwright.sources import sinks

D = dt.date
TARIFF = "name string, price decimal(18,4), valid_from date, valid_to date"


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_dimension_load_twice_equals_once(spark, sf_dir):
    source = base.readings(spark, sf_dir)
    empty = local_frame(spark, [], base.UNIT_SCHEMA)

    def load(dim):
        return dimensions.load_units(dim, source, "unit_id", fv.NEW_UNIT_RATED_KWP, fv.NEW_UNIT_STRINGS)

    once = load(empty)
    assert rows(load(once)) == rows(once)


def test_unknown_status_keeps_key_99(spark):
    meta, unknown = base.status_meta(spark), base.unknown_status(spark)
    source = local_frame(spark, [(c,) for c in (0, 14, 77, None)], "c int")
    dim = dimensions.load_statuses(local_frame(spark, [], base.STATUS_SCHEMA), source, "c", meta, unknown)
    by_code = {r["status_code"]: r for r in dim.collect()}
    assert by_code[99]["status_key"] == 99 and by_code[77]["status_label"] == "Code 77"
    assert len({r["status_key"] for r in by_code.values()}) == 4
    assert rows(dimensions.load_statuses(dim, source, "c", meta, unknown)) == rows(dim)


def test_unknown_status_falls_back_and_unknown_unit_is_rejected(spark):
    units = local_frame(spark, [(1, 1)], "unit_key bigint, unit_id int")
    statuses = local_frame(spark, [(5, 0)], "status_key bigint, status_code int")
    silver = local_frame(
        spark,
        [(dt.datetime(2023, 3, 1), u, 1.0, 1.0, s, None, None, None, None, False) for u, s in ((1, 0), (2, 0))]
        + [(dt.datetime(2023, 3, 1, 1), 1, 1.0, 1.0, 42, None, None, None, None, False)],
        "log_timestamp timestamp_ntz, unit_id int, ac_power_w double, daysum double, status_code int, "
        "pdc1 double, pdc2 double, udc1 double, udc2 double, is_failure boolean",
    )
    good, rejects = facts.device_fact(silver, units, statuses)
    assert sorted(r["status_key"] for r in good.collect()) == [5, 99]
    assert [r["unit_id"] for r in rejects.collect()] == [2]


def test_tariff_history(spark):
    old = local_frame(spark, [("std", 0.15, D(2023, 1, 1), None)], TARIFF.replace("decimal(18,4)", "double"))
    new = local_frame(spark, [("std", 0.20, D(2023, 7, 1))], "name string, price double, valid_from date")
    changed = dimensions.scd2(old, new, ["name"], ["price"])
    assert rows(changed) == [("std", 0.15, D(2023, 1, 1), D(2023, 6, 30)), ("std", 0.2, D(2023, 7, 1), None)]
    assert rows(dimensions.scd2(changed, new, ["name"], ["price"])) == rows(changed)
    first = dimensions.scd2(old.limit(0), new, ["name"], ["price"])
    assert rows(first) == [("std", 0.2, D(2023, 7, 1), None)]
    fact = local_frame(spark, [(i, d) for i, d in enumerate((D(2022, 12, 31), D(2023, 6, 30), D(2023, 7, 1), D(2030, 1, 1)))], "id int, day date")
    priced = joins.price_at(fact, changed, "day", "price", "valid_from", "valid_to")
    assert [r["price"] for r in priced.orderBy("id").collect()] == [None, 0.15, 0.2, 0.2]


def test_tariff_changes_on_the_same_day_and_before(spark):
    schema = "name string, price double, valid_from date"
    old = local_frame(spark, [("a", 1.0, D(2023, 1, 1), None), ("b", 1.0, D(2023, 1, 1), None)], TARIFF.replace("decimal(18,4)", "double"))
    new = local_frame(spark, [("a", 2.0, D(2023, 1, 1)), ("b", 2.0, D(2022, 6, 1))], schema)
    assert rows(dimensions.scd2(old, new, ["name"], ["price"])) == [("a", 2.0, D(2023, 1, 1), None), ("b", 1.0, D(2023, 1, 1), None)]
    assert rows(dimensions.scd2_rejects(old, new, ["name"], ["price"])) == [("b", 2.0, D(2022, 6, 1))]


@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(1, 3), st.integers(0, 9)), max_size=5))
@settings(max_examples=5, deadline=None)
def test_lines_of_a_tariff_never_overlap(spark, changes):
    state = local_frame(spark, [], TARIFF.replace("decimal(18,4)", "double"))
    for name, price, day in changes:
        new = local_frame(spark, [(name, float(price), D(2023, 1, 1) + dt.timedelta(days=day))], "name string, price double, valid_from date")
        found = rows(dimensions.scd2(state, new, ["name"], ["price"]))
        state = local_frame(spark, found, TARIFF.replace("decimal(18,4)", "double"))
        for key in "ab":
            lines = sorted((f, t or D.max) for n, _, f, t in found if n == key)
            assert all(f <= t for f, t in lines) and all(a[1] < b[0] for a, b in zip(lines, lines[1:], strict=False))


def test_two_prices_on_one_day_stop_the_job(spark):
    tariff = local_frame(spark, [("a", 1.0, D(2023, 1, 1), None), ("b", 2.0, D(2023, 1, 1), None)], TARIFF.replace("decimal(18,4)", "double"))
    fact = local_frame(spark, [(1, "a", D(2023, 2, 1)), (2, "b", D(2023, 2, 1)), (3, "c", D(2023, 2, 1))], "id int, kind string, day date")
    with pytest.raises(Exception, match="two prices in force"):
        joins.price_at(fact, tariff, "day", "price", "valid_from", "valid_to").collect()
    priced = joins.price_at(fact, tariff, "day", "price", "valid_from", "valid_to", by={"kind": "name"})
    assert [r["price"] for r in priced.orderBy("id").collect()] == [1.0, 2.0, None]


def test_null_keys_are_not_loaded_again(spark):
    fact = local_frame(spark, [(20230101, 1, None), (20230101, 2, 5)], "date_key int, room int, number int")
    assert increments.incremental_append(fact, fact, ["date_key", "room", "number"]).count() == 0
    dated = fact.withColumns({"year": F.lit(2023), "month": F.lit(1)})
    again = increments.incremental_append(fact, dated, ["date_key", "room", "number"], oldest=F.lit(20230101))
    assert again.count() == 0


def test_upsert_on_change_treats_nulls_as_equal(spark):
    schema = "code string, type string, notes string"
    old = local_frame(spark, [("A", "x", "n"), ("B", None, "n"), ("C", "x", "n")], schema)
    new = local_frame(spark, [("A", "x", "m"), ("B", None, "m"), ("C", "y", "m"), ("D", "z", "m")], schema)
    merged = dimensions.upsert_on_change(old, new, ["code"], ["type"], ["type", "notes"])
    assert rows(merged) == [("A", "x", "n"), ("B", None, "n"), ("C", "y", "m"), ("D", "z", "m")]
    assert rows(dimensions.upsert_on_change(merged, new, ["code"], ["type"], ["type", "notes"])) == rows(merged)


def test_incremental_load_is_idempotent_and_finds_late_rows(spark):
    def frame(days):
        return local_frame(spark, [(i, dt.datetime(2023, 3, d, 12)) for i, d in days], "id int, ts timestamp_ntz")

    def build(df):
        return df.withColumn("date_key", date_key("ts"))

    loaded = build(frame([(1, 1), (2, 2)]))
    source = frame([(1, 1), (2, 2), (3, 2), (4, 3)])
    plain = facts.load_increment(source, "ts", loaded, ["id"], build)
    assert [r["id"] for r in plain.collect()] == [4]
    late = facts.load_increment(source, "ts", loaded, ["id"], build, lookback_days=1)
    assert sorted(r["id"] for r in late.collect()) == [3, 4]
    after = loaded.unionByName(late)
    again = facts.load_increment(source, "ts", after, ["id"], build, lookback_days=3)
    assert again.count() == 0
    nothing = loaded.limit(0)
    everything = facts.load_increment(source, "ts", nothing, ["id"], build)
    assert everything.count() == 4


def test_a_failing_watermark_read_raises(spark):
    with pytest.raises(Exception):
        increments.watermark(spark.read.parquet("/nowhere/at/all"))


def test_energy_balance_does_not_multiply_slots(spark):
    days = dimensions.dim_date(local_frame(spark, [(D(2023, 3, 1),), (D(2023, 3, 2),)], "day date"))
    slots = local_frame(spark, [(20230301, 15 * i, 1.0) for i in range(96)], "date_key int, time_key int, delta_kwh double")
    balance = {str(r["full_date"]): r for r in marts.daily_energy_balance(days, slots, slots).collect()}
    assert balance["2023-03-01"]["total_production_kwh"] == 96.0
    assert balance["2023-03-01"]["self_sufficiency_ratio"] == 1.0
    assert balance["2023-03-02"]["total_consumption_kwh"] == 0.0


def test_shares_of_a_unit_add_up(spark, sf_dir):
    from dialwright.examples.dashboards import status_share

    sums = status_share(spark, sf_dir).groupBy("unit_name").agg(F.sum("share_pct").alias("s")).collect()
    assert all(abs(r["s"] - 100) < 0.01 for r in sums)


def test_fact_keys_are_unique_and_refer_to_dimensions(spark, sf_dir):
    rows_, units, statuses = base.device(spark, sf_dir)
    assert quality.pk_violations(rows_, ["date_key", "time_key", "unit_key"]).count() == 0
    assert quality.fk_violations(rows_, units, "unit_key").count() == 0
    assert quality.fk_violations(rows_, statuses, "status_key").count() == 0
    assert quality.fk_violations(rows_, base.days_of_events(spark, sf_dir), "date_key").count() == 0


def test_run_replacement_leaves_other_runs(spark):
    path = shared_dir(spark, "runs")
    frame = local_frame(spark, [(1, "a"), (2, "b"), (2, "c")], "run int, v string")
    sinks.replace_partition(frame, path, ["run"])
    for _ in range(2):
        sinks.replace_partition(local_frame(spark, [(2, "d")], "run int, v string"), path, ["run"])
    assert rows(spark.read.parquet(path).select("run", "v")) == [(1, "a"), (2, "d")]
    sinks.replace_partition(frame.filter("run = 2"), path, ["run"], runs=[{"run": 1}, {"run": 2}])
    assert rows(spark.read.parquet(path).select("run", "v")) == [(2, "b"), (2, "c")]


def test_counting_while_writing(spark):
    counted, seen = quality.counted(spark.range(5), "load")
    sinks.write_table(counted, shared_dir(spark, "counted"))
    assert seen.get["n_rows"] == 5


def test_backfill_takes_the_requested_models_only(spark):
    keys = "date_key int, time_key int"
    made = local_frame(spark, [(1, 0, 5.0)], f"{keys}, delta_kwh double")
    rows_ = local_frame(
        spark, [(1, 0, m, None, None) for m in (1, 2)],
        f"{keys}, model_key int, actual_production_kwh double, actual_consumption_kwh double",
    )
    everywhere = facts.backfill_actuals(rows_, made, made)
    assert [r["actual_production_kwh"] for r in everywhere.collect()] == [5.0, 5.0]
    only = facts.backfill_actuals(rows_, made, made, F.col("model_key") == 1)
    assert sorted(rows(only.select("model_key", "actual_production_kwh"))) == [(1, 5.0), (2, None)]


def test_unlisted_login_sees_nothing(spark):
    data = local_frame(spark, [(1, "x"), (2, "y")], "division bigint, v string")
    grants = local_frame(spark, [("ann", 1, "Director")], "login string, division bigint, role string")
    assert rows(access.row_filter(data, grants, "ann", "division")) == [(1, "x")]
    assert access.row_filter(data, grants, "bob", "division").count() == 0
    assert access.row_filter(data, grants, "bob", "division", {"owner"}).count() == 2


def test_no_plan_pairs_rows_or_calls_python(spark, sf_dir):
    import __spark_entry__ as entry

    for name in ("building_occupation", "price_at", "weather_vs_production", "asof_weather", "occupancy_15min", "forecast_fact"):
        text = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "NestedLoop", "Python", "Pandas"):
            assert word not in text, (name, word)


def test_timeline_of_out_of_order_changes(spark):
    D = dt.date
    schema = "name string, price double, note string, valid_from date, valid_to date"
    old = local_frame(
        spark,
        [("a", 1.0, "n1", D(2023, 1, 1), D(2023, 1, 31)), ("a", 2.0, "n2", D(2023, 3, 1), None), (None, 5.0, "n3", D(2023, 1, 1), None)],
        schema,
    )
    new = local_frame(
        spark,
        [
            ("a", 3.0, D(2023, 3, 20)),  # out of order
            ("a", 9.0, D(2023, 1, 10)),  # splits a closed line
            ("a", 2.0, D(2023, 3, 10)),  # changes nothing
            ("a", 4.0, D(2023, 3, 1)),  # replaces the line of that day
            ("b", 1.0, D(2022, 1, 1)),
            ("b", 1.5, D(2022, 1, 1)),  # two on one day: the larger
            (None, 6.0, D(2022, 12, 1)),
        ],
        "name string, price double, valid_from date",
    )
    found = dimensions.scd2_timeline(old, new, ["name"], ["price"])
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(
        [
            ("a", 1.0, "n1", D(2023, 1, 1), D(2023, 1, 9)),
            ("a", 9.0, None, D(2023, 1, 10), D(2023, 1, 31)),
            ("a", 4.0, None, D(2023, 3, 1), D(2023, 3, 9)),
            ("a", 2.0, None, D(2023, 3, 10), D(2023, 3, 19)),
            ("a", 3.0, None, D(2023, 3, 20), None),
            ("b", 1.5, None, D(2022, 1, 1), None),
            (None, 6.0, None, D(2022, 12, 1), D(2022, 12, 31)),
            (None, 5.0, "n3", D(2023, 1, 1), None),
        ],
        key=repr,
    )
    again = dimensions.scd2_timeline(found, new, ["name"], ["price"])
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, found.collect()), key=repr)
    assert dimensions.scd2_timeline(old, new.limit(0), ["name"], ["price"]).exceptAll(old).count() == 0


def test_price_at_an_instant(spark):
    at = lambda text: dt.datetime.fromisoformat(f"2024-01-01T{text}")
    lines = [("x", at("00:00"), at("06:30"), 1.0), ("x", at("06:30"), at("06:31"), 2.0), ("x", at("07:00"), None, 3.0), ("y", at("05:00"), at("05:00"), 9.0)]
    tariff = local_frame(spark, lines, "name string, f timestamp_ntz, t timestamp_ntz, price double")
    rows = [(1, "x", at("06:29:59")), (2, "x", at("06:30")), (3, "x", at("06:45")), (4, "x", at("23:00")), (5, "y", at("05:00")), (6, None, at("01:00")), (7, "x", None)]
    fact = local_frame(spark, rows, "id int, kind string, ts timestamp_ntz")
    priced = joins.price_at_instant(fact, tariff, "ts", "price", "f", "t", by={"kind": "name"})
    assert {r.id: r.price for r in priced.collect()} == {1: 1.0, 2: 2.0, 3: None, 4: 3.0, 5: None, 6: None, 7: None}
    text = priced._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    double = tariff.unionByName(tariff.filter("price = 3").withColumn("f", F.lit(at("08:00")).cast("timestamp_ntz")))
    with pytest.raises(Exception, match="two values of price"):
        joins.price_at_instant(fact, double, "ts", "price", "f", "t", by={"kind": "name"}).collect()


def test_outer_alignment_of_a_hot_key(spark):
    """Equal to a full join with a third of both sides at one key and missing keys; no full join in the plan."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 != 0, F.col("id"))
    a = spark.range(90).select(key.alias("k"), F.col("id").alias("x"))
    b = spark.range(30, 150).select(key.alias("k"), F.col("id").alias("y"))
    found, expected = joins.align_outer(a, b, ["k"]), a.join(b, ["k"], "full")
    assert found.columns == expected.columns
    assert found.exceptAll(expected).count() == 0 and found.count() == expected.count()
    assert "FullOuter" not in found._jdf.queryExecution().executedPlan().toString()


def test_outer_alignment_is_split_by_aqe(spark):
    """A key that holds most of the left side is read by several tasks."""
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    before = {name: spark.conf.get(name, None) for name in options}
    try:
        for name, value in options.items():
            spark.conf.set(name, value)
        hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
        a = spark.range(0, 60_000, 1, 8).select(hot.alias("k"), F.md5(F.col("id").cast("string")).alias("x"))
        b = spark.range(60_000).select(F.col("id").alias("k"), F.col("id").alias("y"))
        found = joins.align_outer(a, b, ["k"])
        assert len(found.collect()) == a.join(b, ["k"], "full").count()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_predictions_of_an_unknown_model_stop_the_load(spark):
    models = local_frame(spark, [(1, "P")], "model_key bigint, model_code string")
    values = local_frame(spark, [(dt.datetime(2024, 1, 1), 2.0)], "ts timestamp_ntz, value double")
    kinds = [(values, "P", "predicted_production_kwh"), (values, "C", "predicted_consumption_kwh")]
    with pytest.raises(LookupError, match="no model with code C"):
        facts.prediction_fact(kinds, models, 20240102)
    good, rejects = facts.prediction_fact(kinds, models, 20240102, unknown="reject")
    assert (good.count(), [r["model_code"] for r in rejects.collect()]) == (1, ["C"])
    with pytest.raises(ValueError, match="unknown setting"):
        facts.prediction_fact(kinds, models, 20240102, unknown="skip")
