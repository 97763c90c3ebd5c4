"""Hand-written dirt cases (FIXTURES §B) and the §1.4 fixes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from roadlens.operators import clean as cl
from roadlens.operators import features as ft
from roadlens.schemas import RAW_VIOLATIONS

ROWS = [
    # id, timestamp, location, type, vehicle, severity, fine
    ("a", "2024-01-02 03:04:05", " 12.5, 77.25 ", " Speeding", "Car", "High", " 150 "),
    ("b", "32/13/2025", "10.0,20.0", "Parking", "Bus", "Low", "200"),
    ("c", "05/01/2024 10:00:00", "unknown", None, "Bike", "Medium", "99.50"),
    ("d", "01/13/2024 10:00:00", "-45.0,170.0", "Red Light ", "Auto", "High", "abc"),
    ("e", "2024-01-02 03:04:05", "1,2", "Seat Belt", "Truck", "Low", None),
    ("f", "2024-01-02 03:04:05", "1,2", "Seat Belt", "Truck", "Low", "-3"),
    ("g", "2024-01-02 03:04:05", "1,2", "Seat Belt", "Truck", "Low", "1e3"),
    ("h", "2024-01-02 03:04:05", "1,2", "Seat Belt", "Truck", "Low", ".5"),
    ("i", "13/01/2024 10:00:00", "5", "No Helmet", "Car", "High", "10"),
]


def raw(spark):
    return spark.createDataFrame(ROWS, RAW_VIOLATIONS)


def test_fine_is_strict(spark):
    good = {r["Violation_ID"]: r["Fine_Amount"] for r in cl.good_rows(raw(spark)).collect()}
    assert good == {"a": 150.0, "b": 200.0, "c": 99.5, "i": 10.0}


def test_good_plus_bad_is_input_with_reasons(spark):
    good, bad = cl.good_rows(raw(spark)), cl.bad_rows(raw(spark))
    assert good.count() + bad.count() == len(ROWS)
    reasons = {r["Violation_ID"]: r["reason"] for r in bad.collect()}
    assert reasons == {
        "d": "invalid_fine", "e": "missing_fine", "f": "invalid_fine",
        "g": "invalid_fine", "h": "invalid_fine",
    }


def test_three_format_parse_day_first(spark):
    rows = {r["Violation_ID"]: r["Timestamp"] for r in cl.clean_violations(raw(spark)).collect()}
    assert "b" not in rows  # 32/13/2025
    assert rows["a"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert rows["c"] == dt.datetime(2024, 1, 5, 10, 0)  # dd/MM wins over MM/dd
    assert rows["i"] == dt.datetime(2024, 1, 13, 10, 0)


def test_quarantine_covers_everything_clean_drops(spark):
    r = raw(spark)
    kept = cl.clean_violations(r).count()
    q = {x["Violation_ID"]: x["reason"] for x in cl.quarantine(r).collect()}
    assert kept + len(q) == len(ROWS)
    assert q["b"] == "bad_timestamp"


def test_trim_keeps_nulls(spark):
    t = cl.trim_all(raw(spark)).filter(F.col("Violation_ID") == "c").first()
    assert t["Violation_Type"] is None
    assert cl.trim_all(raw(spark)).filter(F.col("Violation_ID") == "a").first()["Fine_Amount"] == "150"


def test_coordinates_and_cells(spark):
    df = ft.with_grid_cells(ft.with_coordinates(cl.trim_all(raw(spark))))
    got = {r["Violation_ID"]: (r["lat_cell"], r["lon_cell"]) for r in df.collect()}
    assert "c" not in got and "i" not in got  # "unknown" and text with no comma
    assert got["a"] == (0.0, 60.0)
    assert got["d"] == (-40.0, 160.0)  # truncation toward zero


def test_floor_mode_cells(spark):
    df = ft.with_grid_cells(ft.with_coordinates(cl.trim_all(raw(spark))), 20.0, "floor")
    got = {r["Violation_ID"]: (r["lat_cell"], r["lon_cell"]) for r in df.collect()}
    assert got["d"] == (-60.0, 160.0)


def test_normalize_type_keeps_null(spark):
    got = {r["Violation_ID"]: r["Violation_Type"] for r in ft.normalize_type(raw(spark)).collect()}
    assert got["a"] == "Speeding" and got["d"] == "Red Light" and got["c"] is None


def test_time_features_sunday_is_one(spark):
    df = ft.time_features(cl.clean_violations(raw(spark)))
    row = df.filter(F.col("Violation_ID") == "i").first()  # 2024-01-13 is a Saturday
    assert (row["hour"], row["day_of_week"], row["month"]) == (10, 7, 1)


def test_accepted_plus_quarantine_is_input(spark):
    kept, out = cl.accepted_rows(raw(spark)), cl.quarantine(raw(spark))
    ids = sorted([r["Violation_ID"] for r in kept.collect()] + [r["Violation_ID"] for r in out.collect()])
    assert ids == sorted(r[0] for r in ROWS)
    assert kept.count() == cl.clean_violations(raw(spark)).count()


def test_odd_coordinates_are_no_coordinates(spark):
    from roadlens.operators import features as ft

    places = ["1e300,2", "NaN,5", "Infinity,1", "1,-Infinity", "91,0", "0,181", "-90,180", "1.5,-0.5", "unknown", None, "4", ",", "5,"]
    df = spark.createDataFrame([(p,) for p in places], "Location string")
    cells = ft.with_grid_cells(ft.with_coordinates(df), 20.0, "trunc").collect()
    assert [(r.Location, r.lat_cell, r.lon_cell) for r in cells] == [("-90,180", -80.0, 180.0), ("1.5,-0.5", 0.0, 0.0)]
    bad = {r.Location: r.reason for r in cl.bad_locations(df).collect()}
    assert len(bad) == len(places) - 2 and bad["NaN,5"] == "bad_latitude" and bad["1,-Infinity"] == "bad_longitude"
    assert bad[None] == "missing_location" and bad["unknown"] == "not_a_pair"


def test_title_case_after_any_non_letter(spark):
    from roadlens.functions.cleaning import title_case

    texts = ["red-light", "  NO helmet ", "o'neil st2nd", "", "\u00e9t\u00e9 _a1b", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(title_case("t").alias("t"))
    assert [r.t for r in df.collect()] == [None if t is None else t.strip().title() for t in texts]
