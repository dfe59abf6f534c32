"""Hand-made raw files: encodings, repeated headers, junk lines, sentinels."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from dialwright import fixed_values as fv
from dialwright.functions import keys, measures, text
from dialwright.operators import clean
from dialwright.plans import silver
from dialwright.session import local_frame
from dialwright.sources import files, jdbc, readers, sinks


def values(df, *cols):
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=repr)


def test_utf16_sensor_file_with_bom_and_junk(spark, tmp_path):
    lines = [
        '"Datum";"Zeit";"Einheit";"Wert";"Variation"',
        '"01.03.23";"00:15:00";"kWh";"10 kWh";"10 kWh"',
        '"01.03.2023";"00:30";"kWh";"15.5 kWh";"15.5"',
        '"01.03.2023";"00:45";"kWh";"3 kWh";"3"',
        '"01.03.2023";"01:00";"kWh";"7";"7"',
        '"01.03.2023";"01:00";"kWh";"7";"7"',
        '"Report end";"";"";"";""',
    ]
    (tmp_path / "cons.csv").write_bytes(b"\xff\xfe" + "\r\n".join(lines).encode("utf-16-le"))
    raw = readers.read_sensor_csv(spark, str(tmp_path), "reading", "variation")
    rows = values(silver.meter_readings(raw, "reading", "variation"), "ts", "reading", "variation")
    at = dt.datetime(2023, 3, 1, 0, 15)
    step = dt.timedelta(minutes=15)
    assert rows == [(at, 10.0, None), (at + step, 15.5, 5.5), (at + 2 * step, 3.0, None), (at + 3 * step, 7.0, 4.0)]
    change = values(silver.instant_readings(raw, "reading", "variation"), "ts", "variation")
    assert [v for _, v in change] == [None, 5.5, -12.5, 4.0]


def test_long_utf16_file_is_split_without_loss(spark, tmp_path):
    body = "".join(f"01.03.2023;{h:02d}:{m:02d}:{s:02d};kWh;{h};{s}\n" for h in range(2) for m in range(60) for s in range(60))
    (tmp_path / "a.csv").write_bytes(("d;t;u;v;w\n" + body).encode("utf-16-le"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = readers.read_sensor_csv(spark, str(tmp_path), "v", "w")
        assert raw.rdd.getNumPartitions() > 5
        assert silver.sensor_readings(raw, "v", "w").count() == 7200
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_wide_device_log_with_repeated_headers(spark, tmp_path):
    header = ";".join(["Datum", "Zeit"] + ["INV", "Pac", "DaySum", "Status", "Error", "Pdc1", "Pdc2", "Udc1", "Udc2", "Temp", "Uac"] * 5)
    group = "{u};{p};5;{s};0;1;2;3;4;20;230"
    line = "2023-03-01;00:05:00;" + ";".join(group.format(u=u, p=100 * u, s=s) for u, s in zip(range(1, 6), (0, 6, 14, 77, "")))
    dotted = "01.03.23;00:10:00;" + ";".join(group.format(u=u, p=1, s=0) for u in range(1, 6))
    nodate = ";00:05:00;" + ";".join(group.format(u=u, p=1, s=0) for u in range(1, 6))
    (tmp_path / "min1.csv").write_text("\n".join([header, line, line, dotted, nodate]) + "\n")
    names = silver.device_log_names()
    assert len(names) == 57
    rows = silver.device_readings(readers.read_positional_csv(spark, str(tmp_path), names))
    first = rows.filter(F.col("log_timestamp") == dt.datetime(2023, 3, 1, 0, 5))
    assert values(first, "unit_id", "ac_power_w", "status_code", "is_failure") == [
        (1, 100.0, 0, False),
        (2, 200.0, 6, False),
        (3, 300.0, 14, True),
        (4, 400.0, 77, False),
        (5, 500.0, None, False),
    ]
    assert rows.count() == 10
    assert set(rows.columns) == {
        "log_timestamp", "unit_id", "ac_power_w", "daysum", "status_code", "pdc1", "pdc2", "udc1", "udc2", "is_failure"
    }


def test_positional_reader_keeps_lines_of_another_width_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;a;a\n1;2;3\n1;2\n4;5;6;7\n")
    names = ["x", "y", "z"]
    assert values(readers.read_positional_csv(spark, str(tmp_path), names), *names) == [("1", "2", "3")]
    assert values(readers.positional_rejects(spark, str(tmp_path), names), "line", "file") == [("1;2", "a.csv"), ("4;5;6;7", "a.csv")]
    assert readers.read_positional_csv(spark, str(tmp_path), names).select("x").count() == 1


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a b.csv").write_text("x,y\n1,2\n")
    (tmp_path / "c.csv").write_text("y,z,x\n4,9,3\n")
    assert values(readers.read_csv(spark, str(tmp_path), "x int, y int"), "x", "y") == [(1, 2), (3, 4)]
    assert values(readers.read_validated(spark, str(tmp_path), ["x", "y"]), "x", "y", "z") == [("1", "2", None), ("3", "4", "9")]
    with pytest.raises(ValueError, match=r"missing columns \['z'\]"):
        readers.read_csv(spark, str(tmp_path), "x int, z int")


def test_booking_headers_and_masking(spark, tmp_path):
    header = '"Nom"\t"Date"\t"x"\t"Date de début"\t"Date de fin"' + "\t" + "\t".join(f"c{i}" for i in range(5, 11))
    header += '\t"Date de début"\t"Date de fin"\t"Professeur"'
    row = '"AK-4.E215"\t8 janv. 2023\t-\t08:00\t09:00\t' + "\t".join("-" for _ in range(6)) + "\t\t\tJane"
    other = row.replace("AK-4", "AK-5")
    (tmp_path / "b.csv").write_text("\n".join([header, row, row, other]) + "\n", encoding="utf-8")
    raw = silver.read_bookings(spark, str(tmp_path))
    for position, name in fv.BOOKING_REPEATED_HEADERS.items():
        assert raw.columns[position] == name
    rows = silver.masked_bookings(raw, "Nom", "AK-4", {"Professeur": "professor_masked"}).collect()
    assert len(rows) == 1 and rows[0]["Nom"] == "AK-4.E215" and "Professeur" not in rows[0].asDict()
    assert len(rows[0]["professor_masked"]) == 64


def test_unique_headers_without_meanings():
    assert readers.unique_headers(["a", "b", "a"]) == ["a0", "b", "a2"]


def test_rename_duplicates_by_position(spark):
    df = local_frame(spark, [(1, 2)], "a int, b int")
    assert readers.rename_duplicates(df, {1: "start"}).columns == ["a", "start"]


def test_two_digit_years_and_missing_seconds(spark):
    cells = [
        ("01.03.23", "00:15:00"), ("01.03.2023", "00:15"), ("2023-03-01", "00:15:00"), (" 01.03.23 ", "x00:15"),
        ("31.02.2023", "00:15"), ("01.03.2023", "25:00"), ("n/a", "00:15"), (None, "00:15"),
    ]
    rows = text.with_timestamp(local_frame(spark, cells, "d string, t string"), "d", "t", "ts").collect()
    good = dt.datetime(2023, 3, 1, 0, 15)
    assert [r["ts"] for r in rows] == [good] * 4 + [None] * 4


def test_french_months(spark):
    cells = ["8 janv. 2023", "28 févr. 2023", "29 févr. 2023", "29 févr. 2024", "1 août 2023", "31 déc. 2023", "1 Foo 2023", "", None]
    rows = local_frame(spark, [(c,) for c in cells], "c string").select(text.month_text_date("c").alias("d")).collect()
    d = dt.date
    assert [r["d"] for r in rows] == [
        d(2023, 1, 8), d(2023, 2, 28), None, d(2024, 2, 29), d(2023, 8, 1), d(2023, 12, 31), None, None, None
    ]


def test_clock_text(spark):
    rows = local_frame(spark, [("08:30",), ("9:05",), ("x",), ("12",), (None,), ("25:99",), ("-1:30",), ("24:00",)], "c string")
    assert [r[0] for r in rows.select(keys.minutes_of_clock("c")).collect()] == [510, 545] + [None] * 6


def test_room_codes(spark):
    codes = ["B2.Garden", "B2.W214", "B2.SUM", "B2.E107-Comodal", "B2.N033", "B2.Big Aula", "B2.Foyer"]
    rows = local_frame(spark, [(c,) for c in codes], "c string").select(text.room_parts("c", "B2.").alias("p")).select("p.*")
    assert [tuple(r) for r in rows.collect()] == [
        (None, None, None, "Classroom"),
        ("W", 2, "14", "Classroom"),
        (None, None, None, "Seminar"),
        ("E", 1, "07", "Comodal"),
        ("N", 0, "33", "Classroom"),
        (None, None, None, "Auditorium"),
        (None, None, None, "Foyer"),
    ]


def test_sentinels_leave_the_mean_alone(spark):
    raw = local_frame(
        spark,
        [("t1", "m", "00", "u", 12.0, "A"), ("t1", "m", "00", "u", -99999.0, "B"), ("t2", "m", "00", "u", 99999.0, "A"),
         ("t1", "m", "00", "u", 500.0, "C")],
        "Time string, Measurement string, Prediction string, Unit string, Value double, Site string",
    )
    rows = silver.synthetic_forecast(raw, ["A", "B"], "AB")
    assert values(rows, "Time", "Value", "Site") == [("t1", 12.0, "AB"), ("t2", None, "AB")]


def test_predictions_need_their_columns(spark, tmp_path):
    (tmp_path / "p.csv").write_text("timestamp,value\n2023-03-01 00:15:00,1\n")
    with pytest.raises(ValueError, match=r"missing columns \['predicted'\]"):
        readers.read_validated(spark, str(tmp_path / "p.csv"), ["timestamp", "predicted"])


def test_predictions_are_clamped_and_unique(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        "timestamp,kwh\n2023-03-01 00:15:00,-1\n2023-03-01 00:15:00,-3\nsoon,4\n2023-03-01 00:30:00,oops\n"
    )
    rows = silver.predictions(readers.read_validated(spark, str(tmp_path / "p.csv"), ["timestamp", "kwh"]), "kwh")
    assert values(rows, "ts", "kwh") == [(dt.datetime(2023, 3, 1, 0, 15), 0.0), (dt.datetime(2023, 3, 1, 0, 30), None)]


def test_config_falls_back_only_when_missing(spark, tmp_path):
    default = local_frame(spark, [("standard", 0.15)], "name string, price double")
    assert readers.read_config(spark, str(tmp_path / "none.json"), default.schema, default).collect() == default.collect()
    (tmp_path / "t.json").write_text(json.dumps([{"name": "night", "price": 0.1}, {"name": "day", "price": 0.2}]))
    found = readers.read_config(spark, str(tmp_path / "t.json"), default.schema, default)
    assert values(found, "name", "price") == [("day", 0.2), ("night", 0.1)]
    (tmp_path / "bad.json").write_text("{not json")
    with pytest.raises(Exception):
        readers.read_config(spark, str(tmp_path / "bad.json"), default.schema, default).collect()


def test_config_merge_keeps_fields_and_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "models")
    sinks.write_config(local_frame(spark, [("A", "x", "old")], "code string, type string, notes string"), path, ["code"])
    for _ in range(2):
        sinks.write_config(local_frame(spark, [("A", "y"), ("B", "z")], "code string, type string"), path, ["code"])
    rows = spark.read.json(path)
    assert values(rows, "code", "type", "notes") == [("A", "y", "old"), ("B", "z", None)]


def test_new_files_and_routes(spark, tmp_path):
    for name in ("Site_CONS.csv", "room_temp.csv", "Humi-1.csv", "pv.csv"):
        (tmp_path / name).write_text("a\n")
    listed = files.list_files(spark, str(tmp_path), "*.csv")
    done = local_frame(spark, [("pv.csv",)], "file_name string")
    fresh = files.route_by_filename(files.new_files(listed, done))
    assert values(fresh, "file_name", "route") == [
        ("Humi-1.csv", "humidity"), ("Site_CONS.csv", "consumption"), ("room_temp.csv", "temperature")
    ]


def test_promote_part_fails_without_a_part(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        sinks.promote_part(spark, str(tmp_path / "empty"), str(tmp_path / "out.csv"))


def test_jdbc_options():
    target = jdbc.JdbcTarget("jdbc:x://host/db", {"user": "u"})
    assert target.options() == {"url": "jdbc:x://host/db", "user": "u"}
    assert jdbc.range_options("id", 0, 100, 4)["numPartitions"] == "4"


def test_null_handling_of_small_functions(spark):
    df = local_frame(spark, [(-1.0, "0"), (None, "7"), (2.0, "x")], "v double, n string")
    assert [r[0] for r in df.select(measures.clamp_min("v")).collect()] == [0.0, None, 2.0]
    assert [r[0] for r in df.select(measures.zero_as_null("n")).collect()] == [None, 7, None]
    assert clean.rename_if_present(clean.rename_if_present(df, "v", "w"), "v", "w").columns == ["w", "n"]
    good, bad = clean.split_rejects(df, ["v"])
    assert (good.count(), bad.count()) == (2, 1)
