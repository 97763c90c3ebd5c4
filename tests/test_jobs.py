"""The staged jobs run end to end over files and agree with the registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlens import jobs
from roadlens.plans import violations as pv
from roadlens.schemas import DETECTIONS
from roadlens.session import scratch_path
from roadlens.sinks.writers import write_csv, write_parquet
from roadlens.sources.adapters import raw_detections, raw_violations


def test_violation_jobs(spark, sf_dir):
    raw_path = write_csv(raw_violations(spark, sf_dir), scratch_path(spark, "raw"))
    out = scratch_path(spark, "jobs")
    paths = jobs.ingest(spark, raw_path, out)
    assert set(paths) == {"csv", "parquet", "quarantine"}
    counts = [spark.read.parquet(paths["parquet"]).count(), spark.read.parquet(paths["quarantine"]).count()]
    assert sum(counts) == raw_violations(spark, sf_dir).count() and min(counts) > 0
    written = jobs.analyse(spark, out)
    assert {"hotspots", "combined_hotspots", "cluster_counts", "top_locations"} <= set(written)
    spots = spark.read.parquet(written["hotspots"]["parquet"])
    assert sorted(spots.collect()) == sorted(pv.spots(spark, sf_dir).collect())
    export = jobs.dashboard_export(spark, out, vtype="Speeding")
    rows = spark.read.option("header", True).csv(export["csv"])
    assert {"key_figures", "type_distribution", "top_locations", "types", "severities", "time_bounds"} <= set(export)
    assert rows.count() > 0 and rows.filter(F.col("Violation_Type") != "Speeding").count() == 0


def test_detection_job(spark, sf_dir):
    det = raw_detections(spark, sf_dir).select(*DETECTIONS.names)
    det_path = write_parquet(det, scratch_path(spark, "det"))
    out = jobs.detections(spark, det_path, scratch_path(spark, "det-out"))
    totals = spark.read.option("header", True).csv(out["totals"]).first()
    assert int(totals["detection_rows"]) == spark.read.parquet(out["summary"]).count() > 0
    assert spark.read.parquet(out["paths"]).agg(F.sum("points")).first()[0] == int(totals["detection_rows"])


def test_ingest_of_broken_lines_and_deliveries(spark, tmp_path):
    header = "Fine_Amount,Violation_ID,Timestamp,Location,Violation_Type,Vehicle_Type,Severity"
    (tmp_path / "a.csv").write_text(header + "\n100,V1,2024-01-02 03:04:05,\"1,2\",Speeding,Car,Low\nabc,V2,2024-01-02 03:04:05,x,Speeding,Car,Low\n7,V3\n")
    (tmp_path / "b.csv").write_text("Violation_ID,Severity\nV4,Low\n")
    out = scratch_path(spark, "ingest")
    paths = jobs.ingest(spark, str(tmp_path), out, delivery="d1")
    assert [r.Violation_ID for r in spark.read.parquet(paths["parquet"]).collect()] == ["V1"]
    bad = spark.read.parquet(paths["quarantine"]).collect()
    assert sorted(((r.Violation_ID or "", r.raw_line or "", r.reason.split(":")[0].split(",")[0]) for r in bad)) == [
        ("", "7,V3", "malformed line"), ("", "V4,Low", "missing columns"), ("V2", "", "invalid_fine"),
    ]
    assert [(r.delivery, r.rows) for r in spark.read.parquet(paths["manifest"]).collect()] == [("d1", 1)]


def test_report_cube_equals_direct_reports(spark, sf_dir):
    from roadlens.operators import aggregates as agg
    from roadlens.operators import features as ft
    from roadlens.operators import hotspots as hs
    from roadlens.operators import rollup as ru

    timed = pv.timed(spark, sf_dir)
    cube = ru.report_cube(ft.with_cells_or_null(ft.with_coordinates(timed)))

    def same(a, b):
        rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
        return rows(a) == rows(b.select(*a.columns))

    for col in ["Violation_Type", "Severity", "Vehicle_Type", "Location"]:
        assert same(ru.count_report(cube, col), agg.count_by(timed, col))
    assert same(ru.crosstab_from_counts(ru.type_hour_counts(cube)), agg.crosstab_hours(timed))
    assert same(ru.cell_profile(cube), hs.cell_profile(pv.located(spark, sf_dir)))
    from roadlens.operators import clusters as ck

    assert same(ru.weighted_points(cube), ck.weighted_points(pv.located(spark, sf_dir)))
