"""Aggregates, hotspots, report, sources/sinks and K-means invariants."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from roadlens.operators import aggregates as agg
from roadlens.operators import clusters as ck
from roadlens.operators import hotspots as hs
from roadlens.operators import report as rp
from roadlens.plans import violations as pv
from roadlens.schemas import HOTSPOTS, RAW_VIOLATIONS
from roadlens.session import scratch_path
from roadlens.sinks import writers as w
from roadlens.sources import readers as r


def cells(spark, counts):
    return spark.createDataFrame(
        [(float(i), 0.0, n) for i, n in enumerate(counts)], "lat_cell double, lon_cell double, violation_count bigint"
    )


def test_hotspot_fallback_when_stddev_zero(spark):
    got = hs.hotspots(cells(spark, [2, 2, 2])).collect()
    assert len(got) == 3 and all(g["z_score"] is None for g in got)
    assert hs.hotspots(cells(spark, [1, 1])).count() == 0


def test_hotspot_fallback_single_cell(spark):
    got = hs.hotspots(cells(spark, [5])).collect()
    assert [(g["violation_count"], g["z_score"]) for g in got] == [(5, None)]


def test_hotspot_z_strictly_greater(spark):
    # mean 2, sd 1 -> z of 3 is exactly 1 and is not a hotspot
    got = hs.hotspots(cells(spark, [1, 2, 3])).collect()
    assert got == []
    got = hs.hotspots(cells(spark, [1, 1, 1, 1, 10])).collect()
    assert [g["violation_count"] for g in got] == [10]


def test_empty_hotspots_keep_schema(spark):
    empty = spark.createDataFrame([], HOTSPOTS.simpleString())
    rows = spark.createDataFrame([], "lat_cell double, lon_cell double, Violation_Type string, hour int")
    prof = hs.cell_profile(rows)
    out = hs.combined_hotspots(prof, empty)
    assert out.count() == 0
    assert out.columns == ["lat_cell", "lon_cell", "violation_count", "z_score", "Violation_Type",
                           "violation_type_count", "hour", "hour_count"]


def test_top_violation_tie_break(spark):
    rows = spark.createDataFrame(
        [(0.0, 0.0, "B", 1), (0.0, 0.0, "A", 2), (0.0, 0.0, None, 3), (0.0, 0.0, None, 4)],
        "lat_cell double, lon_cell double, Violation_Type string, hour int",
    )
    prof = hs.cell_profile(rows)
    spots = hs.hotspots(hs.cell_counts(prof))  # one cell, fallback count > 1
    top = hs.top_violation(prof, spots).first()
    assert (top["Violation_Type"], top["violation_type_count"]) == (None, 2)
    peak = hs.peak_hour(prof, spots).first()
    assert peak["hour"] == 1


def test_crosstab_and_profile_sums(spark, sf_dir):
    timed = pv.timed(spark, sf_dir)
    n = timed.count()
    ct = agg.crosstab_hours(timed)
    assert len(ct.columns) == 25
    assert ct.select(sum(F.col(f"`{h}`") for h in range(24)).alias("s")).agg(F.sum("s")).first()[0] == n
    prof = agg.hourly_profile(timed).collect()
    assert [p["hour"] for p in sorted(prof)] == list(range(24))
    assert sum(p["count"] for p in prof) == n


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (10.0,)], "x double")
    h = {r["bin"]: r["count"] for r in agg.histogram(df, "x", 20).collect()}
    assert len(h) == 20 and h[1] == 1 and h[3] == 1 and h[20] == 2
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    h = {r["bin"]: r["count"] for r in agg.histogram(same, "x", 20).collect()}
    assert h[1] == 2 and sum(h.values()) == 2


def test_top_value_ties_and_empty(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "v string")
    assert agg.top_value(df, "v").first() == ("a", 2)
    empty = spark.createDataFrame([], "v string")
    assert agg.top_value(empty, "v").collect()[0][0] is None


def test_filter_report_end_modes(spark):
    df = spark.createDataFrame(
        [("A", "High", "2024-01-01 05:00:00"), ("A", "Low", "2024-01-03 00:00:00"), ("B", "High", "2024-01-03 09:00:00")],
        "Violation_Type string, Severity string, t string",
    ).select("Violation_Type", "Severity", F.col("t").cast("timestamp_ntz").alias("Timestamp"))
    assert rp.filter_report(df).count() == 3  # no date given: all rows
    assert rp.filter_report(df, end="2024-01-03").count() == 3
    assert rp.filter_report(df, end="2024-01-03", end_mode="midnight").count() == 2
    assert rp.filter_report(df, vtype="A", severity="All").count() == 2
    assert rp.filter_report(df, severity="High", start="2024-01-02", end="2024-01-04").count() == 1


def test_key_figures_empty(spark):
    df = spark.createDataFrame([], "Violation_Type string, Severity string, Location string, hour int")
    row = rp.key_figures(df).first()
    assert row["total_records"] == 0 and row["severe_count"] == 0 and row["most_common_type"] is None


def test_json_epoch_millis(spark, tmp_path):
    p = tmp_path / "v.json"
    recs = [
        {"Violation_ID": "x", "Timestamp": 1704164645000, "Location": "1,2", "Violation_Type": "Parking",
         "Vehicle_Type": "Car", "Severity": "Low", "Fine_Amount": 100},
        {"Violation_ID": "y", "Timestamp": "32/13/2025", "Location": "1,2", "Violation_Type": None,
         "Vehicle_Type": "Car", "Severity": "Low", "Fine_Amount": "abc"},
    ]
    p.write_text("\n".join(json.dumps(x) for x in recs))
    got = {x["Violation_ID"]: x for x in r.read_raw_json(spark, str(p)).collect()}
    assert got["x"]["Timestamp"] == "2024-01-02 03:04:05"
    assert got["x"]["Fine_Amount"] == "100"
    assert got["y"]["Timestamp"] == "32/13/2025" and got["y"]["Violation_Type"] is None


def test_missing_result_is_empty_table(spark, tmp_path):
    df = r.read_result_csv(spark, str(tmp_path / "nope"), RAW_VIOLATIONS)
    assert df.count() == 0 and df.columns == list(RAW_VIOLATIONS.names)


def test_require_columns(spark):
    df = spark.createDataFrame([("a",)], "Violation_ID string")
    with pytest.raises(ValueError, match="Timestamp"):
        r.require_columns(df, ["Violation_ID", "Timestamp"])
    assert r.has_column(df, "Violation_ID") and not r.has_column(df, "Location")


def test_csv_keeps_spaces_and_quotes(spark):
    df = spark.createDataFrame([("a", " Speeding", "1.5,2.5", None)], "i string, t string, l string, f string")
    path = w.write_csv(df, scratch_path(spark, "spaces"))
    back = spark.read.schema(df.schema).option("header", True).csv(path).first()
    assert tuple(back) == ("a", " Speeding", "1.5,2.5", None)


def test_write_result_formats(spark):
    df = spark.createDataFrame([("x", 1)], "Location string, Total_Violations bigint")
    paths = w.write_result(df, scratch_path(spark, "result"), ("csv", "parquet", "json"))
    assert set(paths) == {"csv", "parquet", "json"}
    assert all(os.path.isdir(p.replace("file:", "")) for p in paths.values())
    assert spark.read.parquet(paths["parquet"]).first() == ("x", 1)


def test_write_failure_raises(spark, tmp_path):
    df = spark.createDataFrame([("x",)], "a string")
    target = tmp_path / "exists"
    w.write_csv(df, str(target))
    with pytest.raises(Exception):
        w.write_csv(df, str(target), mode="error")


def test_kmeans_invariants(spark, sf_dir):
    rows = pv.located(spark, sf_dir)
    model = ck.fit_clusters(rows, k=5, seed=42)
    counts = {c["cluster"]: c["violation_count"] for c in ck.cluster_counts(model, rows).collect()}
    assert set(counts) <= set(range(5)) and sum(counts.values()) == rows.count()
    centers = [(c["center_Latitude"], c["center_Longitude"]) for c in ck.cluster_centers(spark, model).collect()]
    assigned = ck.cluster_rows(model, rows).collect()
    per = {}
    for a in assigned:
        per[a["cluster"]] = per.get(a["cluster"], 0) + 1
        d = [(a["Latitude"] - x) ** 2 + (a["Longitude"] - y) ** 2 for x, y in centers]
        assert d[a["cluster"]] == pytest.approx(min(d))
    assert per == counts


def test_hotspot_report_outputs(spark, sf_dir):
    out = hs.hotspot_report(pv.located(spark, sf_dir))
    assert set(out) == {"cell_counts", "hotspots", "top_violation", "peak_hour",
                        "structured_hotspots", "combined_hotspots"}
    assert out["combined_hotspots"].count() == out["hotspots"].count()


def test_track_history_counts_up(spark, sf_dir):
    from roadlens.plans import detections as pd_

    hist = pd_.SPARK["track_history"](spark, sf_dir).collect()
    by_track = {}
    for h in hist:
        by_track.setdefault((h["video_id"], h["track_id"]), []).append((h["frame_id"], h["history_len"]))
    for points in by_track.values():
        points.sort()
        assert [n for _, n in points] == list(range(1, len(points) + 1))


def test_month_partitions_prune(spark, sf_dir):
    clean = pv.clean(spark, sf_dir)
    path = w.write_clean_by_month(clean, scratch_path(spark, "by-month"))
    df = r.read_clean_by_month(spark, path, "2024-01-05", "2024-01-10")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan and "PushedFilters: [IsNotNull(Timestamp)" in plan
    want = clean.filter((F.col("Timestamp") >= "2024-01-05") & (F.col("Timestamp") < "2024-01-11")).count()
    assert df.count() == want > 0


def test_missing_input_fails_fast(spark, tmp_path):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        r.read_raw_csv(spark, str(tmp_path / "absent.csv"))
