"""End-to-end jobs: the reference's stages as Spark jobs over files.

Each job reads its input with an explicit schema, builds the plans from the
operators, and writes every result with the sinks (CSV with header plus
Parquet unless told otherwise). Run from the command line:

    python -m roadlens.jobs ingest     RAW_CSV OUT_DIR
    python -m roadlens.jobs analyse    OUT_DIR          # after ingest
    python -m roadlens.jobs detections DETECTIONS OUT_DIR
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession

from roadlens.operators import aggregates as agg
from roadlens.operators import clean as cl
from roadlens.operators import clusters as ck
from roadlens.operators import detections as dt
from roadlens.operators import features as ft
from roadlens.operators import hotspots as hs
from roadlens.operators import report as rp
from roadlens.operators import rollup as ru
from roadlens.operators.chunked_tracking import tracked_rows
from roadlens.operators.tracking import track_paths
from roadlens.schemas import TRACKED
from roadlens.session import cut_lineage
from roadlens.sinks import writers as w
from roadlens.sinks.months import ingest_months
from roadlens.sources import readers as r
from roadlens.sources.checked_csv import read_checked_csv


def _out(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def ingest(spark: SparkSession, raw_path: str, out: str, fmt: str = "csv", delivery: str | None = None) -> dict[str, str]:
    """Stage 1: read raw violations; every row goes either to the accepted rows
    (CSV + Parquet) or, with a reason, to the quarantine.

    CSV columns are found by each file's header, and lines that can not be read
    go to the quarantine too (``raw_line``, ``source_file``). With ``delivery``,
    a label, the cleaned rows also replace their months in ``by_month``.
    """
    if fmt == "csv":
        rows, broken = read_checked_csv(spark, raw_path)
        raw = rows.drop("source_file")
        bad = cl.quarantine(raw).unionByName(broken, allowMissingColumns=True)
    else:
        raw = r.read_raw_json(spark, raw_path)
        bad = cl.quarantine(raw)
    paths = w.write_result(cl.accepted_rows(raw), _out(out, "cleaned"))
    paths["quarantine"] = w.write_quarantine(bad, _out(out, "quarantine"))
    if delivery is not None:
        paths |= {"by_month": _out(out, "by_month"), "manifest": _out(out, "by_month_manifest")}
        ingest_months(cl.clean_violations(raw), paths["by_month"], paths["manifest"], delivery)
    return paths


def _cleaned(spark: SparkSession, out: str) -> DataFrame:
    good = spark.read.parquet(_out(out, "cleaned/parquet_output"))
    return ft.time_features(cl.with_timestamp(good))


def analyse(spark: SparkSession, out: str, grid: float = 20.0, k: int = 5, seed: int = 42) -> dict[str, dict]:
    """Stages 2-3: crosstab, place totals and top 10, counts, hotspots, clusters.

    The cleaned rows are read once: a GROUPING SETS cube (checkpointed) holds
    every count the reports need, and each report is derived from it.
    """
    rows = ft.with_cells_or_null(ft.with_coordinates(_cleaned(spark, out)), grid)
    cube = ru.report_cube(rows)
    places = ru.count_report(cube, "Location", "Total_Violations")
    results: dict[str, DataFrame] = {
        "type_hour_crosstab": ru.crosstab_from_counts(ru.type_hour_counts(cube)),
        "total_by_location": places,
        "top_locations": agg.top_n(places, "Location", "Total_Violations", 10),
        "by_type": ru.count_report(cube, "Violation_Type"),
        "by_severity": ru.count_report(cube, "Severity"),
        "by_vehicle": ru.count_report(cube, "Vehicle_Type"),
    }
    profile = ru.cell_profile(cube)
    counts = hs.cell_counts(profile)
    spots = cut_lineage(hs.hotspots(counts))
    results.update(
        cell_counts=counts,
        hotspots=spots,
        top_violation=hs.top_violation(profile, spots),
        peak_hour=hs.peak_hour(profile, spots),
        structured_hotspots=hs.structured_hotspots(profile, spots),
        combined_hotspots=hs.combined_hotspots(profile, spots),
    )
    results["bad_locations"] = cl.bad_locations(_cleaned(spark, out))
    points = cut_lineage(ru.weighted_points(cube))
    results["cluster_counts"] = ck.weighted_cluster_counts(ck.fit_weighted(points, k, seed), points)
    return {name: w.write_result(df, _out(out, name)) for name, df in results.items()}


def dashboard_export(
    spark: SparkSession,
    out: str,
    vtype: str | None = None,
    severity: str | None = None,
    start=None,
    end=None,
    end_mode: str = "whole_day",
) -> dict[str, str]:
    """Stage 4: filtered rows (CSV and JSON Lines), the tables of the dashboard, and its filter choices."""
    cleaned = ft.normalize_type(_cleaned(spark, out))
    filtered = rp.filter_report(cleaned, vtype, severity, start, end, end_mode)
    paths = w.write_result(filtered, _out(out, "dashboard/filtered"), ("csv", "json", "parquet"))
    rows = spark.read.parquet(paths["parquet"])  # the tables below read what was filtered once
    places = agg.count_by(rows, "Location", "Total_Violations", drop_null=True)
    tables = {
        "key_figures": rp.key_figures(rows),
        "hourly_profile": agg.hourly_profile(rows),
        "type_distribution": agg.count_by(rows, "Violation_Type", drop_null=True),
        "total_by_location": places,
        "top_locations": agg.top_n(places, "Location", "Total_Violations", 10),
        "types": rp.distinct_values(cleaned, "Violation_Type"),
        "severities": rp.distinct_values(cleaned, "Severity"),
        "time_bounds": rp.time_bounds(cleaned),
    }
    return paths | {name: w.write_csv(df, _out(out, f"dashboard/{name}")) for name, df in tables.items()}


def detections(
    spark: SparkSession, det_path: str, out: str, params: dt.DetectionParams = dt.DetectionParams(),
    fmt: str = "parquet", with_helmets: bool = True,
    helmet_path: str | None = None, rates_path: str | None = None,
) -> dict[str, str]:
    """Stage 5: detections -> tracks -> speeds and rules -> summary and violations.

    ``helmet_path``: a separate table of helmet boxes; ``rates_path``: a Parquet
    table of video_id with fps and / or meters_per_pixel. The evaluated rows
    are written once, and every result is read from them.
    """
    boxes = dt.processed(r.read_detections(spark, det_path, fmt), params)
    followed = cut_lineage(tracked_rows(dt.vehicles(boxes), params.frame_skip, params.iou_threshold))
    tracks = followed.select(*TRACKED.names)
    helmets = r.read_detections(spark, helmet_path, fmt) if helmet_path else None
    rates = spark.read.parquet(rates_path) if rates_path else None
    rows = dt.evaluate(tracks, boxes, params, with_helmets, helmets, rates)
    evaluated = spark.read.parquet(w.write_parquet(rows, _out(out, "evaluated")))
    violations = dt.violations_table(evaluated)
    summary = dt.summary(evaluated)
    return {
        "summary": w.write_parquet(summary, _out(out, "detections_summary")),
        "violations": w.write_csv(violations, _out(out, "violations")),
        "violation_mix": w.write_csv(agg.share(agg.explode_count(violations, "violation_type")),
                                     _out(out, "violation_mix")),
        "speed_histogram": w.write_csv(agg.histogram(summary, "speed_kmph"), _out(out, "speed_histogram")),
        "paths": w.write_parquet(track_paths(followed), _out(out, "track_paths")),
        "totals": w.write_csv(dt.totals(evaluated), _out(out, "detection_totals")),
    }


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="python -m roadlens.jobs")
    sub = ap.add_subparsers(dest="stage", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("raw")
    a.add_argument("out")
    a.add_argument("--format", default="csv", choices=["csv", "json"])
    a.add_argument("--delivery", help="label; the cleaned rows also replace their months")
    b = sub.add_parser("analyse")
    b.add_argument("out")
    c = sub.add_parser("dashboard")
    c.add_argument("out")
    c.add_argument("--type")
    c.add_argument("--severity")
    c.add_argument("--start")
    c.add_argument("--end")
    c.add_argument("--end-mode", default="whole_day", choices=["whole_day", "midnight"])
    d = sub.add_parser("detections")
    d.add_argument("detections")
    d.add_argument("out")
    d.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    d.add_argument("--helmets", help="table of helmet boxes from a separate detector")
    d.add_argument("--rates", help="Parquet table: video_id, fps, meters_per_pixel")
    for f in fields(dt.DetectionParams):
        d.add_argument("--" + f.name.replace("_", "-"), type=type(f.default), default=f.default)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"roadlens-{args.stage}").getOrCreate()
    if args.stage == "ingest":
        print(ingest(spark, args.raw, args.out, args.format, args.delivery))
    elif args.stage == "analyse":
        print(analyse(spark, args.out))
    elif args.stage == "dashboard":
        print(dashboard_export(spark, args.out, args.type, args.severity, args.start, args.end, args.end_mode))
    else:
        params = dt.DetectionParams(**{f.name: getattr(args, f.name) for f in fields(dt.DetectionParams)})
        print(detections(spark, args.detections, args.out, params, args.format, helmet_path=args.helmets, rates_path=args.rates))


if __name__ == "__main__":
    main(sys.argv[1:])
