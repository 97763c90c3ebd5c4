"""Keys over files that do not agree, deliveries that replace each other, positions and exports.

Each builder writes rows of the adapter tables in the shape it is about into a
fresh folder under ``spark.checkpoint.dir`` and returns the source's read of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.operators import aggregates as agg
from roadlens.operators import hotspots as hs
from roadlens.operators.positions import with_position
from roadlens.plans import detections as pd
from roadlens.plans import violations as pv
from roadlens.plans.oracle import VIOLATIONS, with_views
from roadlens.schemas import LOCATION_TOTALS, RAW_VIOLATIONS
from roadlens.session import cut_lineage, scratch_path
from roadlens.sinks import months
from roadlens.sinks import writers as w
from roadlens.sources import readers as r
from roadlens.sources.checked_csv import CheckedCsv, read_checked_csv
from roadlens.sources.parts import read_parts

NAMES = RAW_VIOLATIONS.names


def _number():
    """Record number: the digits of the id."""
    return F.substring("Violation_ID", 2, 20).cast("bigint")


def _checked(s: SparkSession, d: str) -> CheckedCsv:
    """Four deliveries: usual columns, columns turned round, two columns only, and lines with too few or too many fields."""
    raw = pv.raw(s, d)
    base = scratch_path(s, "checked")
    turn = _number() % 4
    w.write_csv(raw.where(turn == 0), f"{base}/usual")
    w.write_csv(raw.where(turn == 1).select(*reversed(NAMES)), f"{base}/turned")
    w.write_csv(raw.where(turn == 2).select("Violation_ID", "Severity"), f"{base}/short")
    line = F.concat("Violation_ID", F.when(_number() % 8 == 3, ",only,three").otherwise(",a,b,c,d,e,f,g,h"))
    # one unquoted column whose name is the usual header, so that every file begins with it
    lines = raw.where(turn == 3).select(line.alias(",".join(NAMES)))
    lines.write.option("header", True).option("sep", "\u0001").csv(f"{base}/broken")
    return read_checked_csv(s, f"{base}/*")


def _delivered(s: SparkSession, d: str) -> tuple[str, str]:
    """Two deliveries over three months: all rows, and then half of the rows of one month again, with another severity."""
    rows = pv.clean(s, d).withColumn("Timestamp", F.col("Timestamp") + F.make_ym_interval(F.lit(0), (_number() % 3).cast("int")))
    path, manifest = scratch_path(s, "months"), scratch_path(s, "manifest")
    months.ingest_months(rows, path, manifest, "first")
    again = rows.where((F.date_format("Timestamp", "yyyy-MM") == "2024-02") & (_number() % 2 == 0)).withColumn("Severity", F.lit("Revised"))
    months.ingest_months(again, path, manifest, "second")
    return path, manifest


def _manifest(s, d):
    return s.read.parquet(_delivered(s, d)[1])


def _merged(s: SparkSession, d: str) -> DataFrame:
    """Place totals in three unlike parts and one that is not there."""
    totals = cut_lineage(agg.count_by(pv.clean(s, d), "Location", "Total_Violations"))
    base = scratch_path(s, "parts")
    share = F.coalesce(F.length("Location") % 3, F.lit(0))
    w.write_parquet(totals.where(share == 0), f"{base}/a")
    w.write_csv(totals.where(share == 1).select(F.lit("x").alias("note"), "Total_Violations", "Location"), f"{base}/b")
    w.write_json(totals.where(share == 2).select("Location"), f"{base}/c")
    parts = {"a": (f"{base}/a", "parquet"), "b": (f"{base}/b", "csv"), "c": (f"{base}/c", "json"), "gone": (f"{base}/gone", "parquet")}
    found = read_parts(s, parts, LOCATION_TOTALS)
    # the folder in the file's path is the part's
    return found.select("Location", "Total_Violations", "part", F.element_at(F.split("source_file", "/"), -2).alias("folder"))


def _ranked_positions(s, d):
    totals = agg.count_by(pv.clean(s, d), "Location", "Total_Violations")
    return with_position(totals, F.col("Total_Violations").desc(), F.col("Location").asc_nulls_last())


def _cell_positions(s, d):
    return with_position(hs.counted_cells(pv.located(s, d)), F.col("lat_cell").asc(), F.col("lon_cell").asc())


def _export(rows, fmt: str):
    """Rows written for a download and read back."""

    def build(s: SparkSession, d: str) -> DataFrame:
        df = rows(s, d)
        if fmt == "csv":
            return r.read_result_csv(s, w.write_csv(df, scratch_path(s, "export")), df.schema)
        return s.read.schema(df.schema).json(w.write_json(df, scratch_path(s, "export")))

    return build


SPARK = {
    "checked_rows": lambda s, d: _checked(s, d).rows.drop("source_file"),
    "checked_broken": lambda s, d: _checked(s, d).broken.drop("source_file"),
    "ingest_by_month": lambda s, d: months.read_months(s, *_delivered(s, d)),
    "ingest_manifest": _manifest,
    "merged_parts": _merged,
    "ranked_positions": _ranked_positions,
    "cell_positions": _cell_positions,
    "export_report_csv": _export(pv.SPARK["filter_report"], "csv"),
    "export_report_json": _export(pv.SPARK["filter_report"], "json"),
    "export_violations_csv": _export(pd.SPARK["detection_violations"], "csv"),
    # what the tracker may join: the threshold of D6
    "iou_matches": lambda s, d: pd.SPARK["iou_pairs"](s, d).where(F.col("iou") >= pd.P.iou_threshold),
}

_N = "CAST(Violation_ID[2:] AS BIGINT)"
_MISSING = ", ".join(c for c in NAMES if c not in ("Violation_ID", "Severity"))
MONTHS = f"""
SELECT * REPLACE (CASE WHEN again THEN 'Revised' ELSE Severity END AS Severity), CASE WHEN again THEN 'second' ELSE 'first' END AS delivery
FROM (SELECT *, month = DATE '2024-02-01' AS again
  FROM (SELECT * REPLACE (ts AS Timestamp), CAST(date_trunc('month', ts) AS DATE) AS month
    FROM (SELECT *, Timestamp + to_months(CAST({_N} % 3 AS INTEGER)) AS ts FROM c)))
WHERE NOT again OR {_N} % 2 = 0
"""

SQL = {
    "checked_rows": with_views(f"SELECT * FROM v WHERE {_N} % 4 IN (0, 1)", v=VIOLATIONS),
    "checked_broken": with_views(
        f"SELECT Violation_ID || ',' || Severity AS raw_line, 'missing columns: {_MISSING}' AS reason FROM v WHERE {_N} % 4 = 2 "
        f"UNION ALL SELECT Violation_ID || CASE WHEN {_N} % 8 = 3 THEN ',only,three' ELSE ',a,b,c,d,e,f,g,h' END, "
        f"'malformed line, fields read: ' || CASE WHEN {_N} % 8 = 3 THEN '3' ELSE '7' END FROM v WHERE {_N} % 4 = 3",
        v=VIOLATIONS,
    ),
    "ingest_by_month": pv._q(f"SELECT {', '.join(NAMES)}, delivery, month AS event_month FROM m", pv._base(m=MONTHS)),
    "ingest_manifest": pv._q(
        "SELECT month AS event_month, delivery, count(*) AS rows, min(Timestamp) AS first_time, max(Timestamp) AS last_time "
        "FROM m GROUP BY ALL",
        pv._base(m=MONTHS),
    ),
    "merged_parts": pv._q(
        "SELECT Location, CASE WHEN p <> 'c' THEN Total_Violations END AS Total_Violations, p AS part, p AS folder "
        f"FROM (SELECT *, ['a', 'b', 'c'][coalesce(length(Location) % 3, 0) + 1] AS p FROM ({pv._LOC_COUNTS}))",
        pv._base(),
    ),
    "ranked_positions": pv._q(
        "SELECT *, row_number() OVER (ORDER BY Total_Violations DESC, Location ASC NULLS LAST) AS position "
        f"FROM ({pv._LOC_COUNTS})",
        pv._base(),
    ),
    "cell_positions": pv._q(
        "SELECT *, row_number() OVER (ORDER BY lat_cell, lon_cell) AS position FROM cells", pv._base(cells=pv.CELLS)
    ),
    "export_report_csv": pv.SQL["filter_report"],
    "export_report_json": pv.SQL["filter_report"],
    "export_violations_csv": pd.SQL["detection_violations"],
    "iou_matches": f"SELECT * FROM ({pd.SQL['iou_pairs']}) WHERE iou >= {pd.P.iou_threshold}",
}
