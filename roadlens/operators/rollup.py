"""Every count report of the violation analysis from one scan.

``report_cube`` aggregates the enriched rows once with ``GROUPING SETS``:
one set per report (type, severity, vehicle, place, type x hour, the
hotspot cell profile, distinct coordinates for K-means). The rows are
expanded per set and combined map-side before a single shuffle, so a
100 TB input is read once instead of once per report; the result is a small
table that each report below filters by its grouping id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.session import cut_lineage

# Column order of the grouping sets; grouping_id bit i (from the left) is set
# when column i is not grouped in a row.
_COLS = ["Violation_Type", "Severity", "Vehicle_Type", "Location", "hour",
         "lat_cell", "lon_cell", "Latitude", "Longitude"]

SETS = {
    "type": ["Violation_Type"],
    "severity": ["Severity"],
    "vehicle": ["Vehicle_Type"],
    "location": ["Location"],
    "type_hour": ["Violation_Type", "hour"],
    "profile": ["lat_cell", "lon_cell", "Violation_Type", "hour"],
    "points": ["Latitude", "Longitude"],
}


def _gid(cols: list[str]) -> int:
    n = len(_COLS)
    return sum(1 << (n - 1 - i) for i, c in enumerate(_COLS) if c not in cols)


def report_cube(rows: DataFrame, materialize: bool = True) -> DataFrame:
    """One aggregate for all reports. ``rows``: clean rows with ``hour``,
    ``Latitude``/``Longitude`` and ``lat_cell``/``lon_cell`` (null when the
    coordinates are not valid)."""
    cube = rows.groupingSets(list(SETS.values()), *_COLS).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid")
    )
    return cut_lineage(cube) if materialize else cube


def _part(cube: DataFrame, name: str) -> DataFrame:
    cols = SETS[name]
    return cube.filter(F.col("gid") == _gid(cols)).select(*cols, "n")


def count_report(cube: DataFrame, col: str, count_name: str = "count") -> DataFrame:
    """Rows per value of type, severity, vehicle or place (null is a group)."""
    name = {"Violation_Type": "type", "Severity": "severity", "Vehicle_Type": "vehicle",
            "Location": "location"}[col]
    return _part(cube, name).withColumnRenamed("n", count_name)


def type_hour_counts(cube: DataFrame) -> DataFrame:
    """Long (type, hour, count) table; ``crosstab_hours`` input."""
    return _part(cube, "type_hour")


def cell_profile(cube: DataFrame) -> DataFrame:
    """The hotspot profile (cells with valid coordinates only)."""
    return _part(cube, "profile").filter(F.col("lat_cell").isNotNull() & F.col("lon_cell").isNotNull())


def weighted_points(cube: DataFrame) -> DataFrame:
    """Distinct valid coordinates with ``weight`` for K-means."""
    return (
        _part(cube, "points")
        .filter(F.col("Latitude").isNotNull() & F.col("Longitude").isNotNull())
        .select("Latitude", "Longitude", F.col("n").cast("double").alias("weight"))
    )


def crosstab_from_counts(counts: DataFrame, row_col: str = "Violation_Type", hour_col: str = "hour") -> DataFrame:
    """The 24-column crosstab from (type, hour, n) counts."""
    key = f"{row_col}_{hour_col}"
    wide = (
        counts.select(F.coalesce(F.col(row_col), F.lit("null")).alias(key), F.col(hour_col), "n")
        .groupBy(key)
        .pivot(hour_col, list(range(24)))
        .agg(F.sum("n"))
    )
    return wide.select(
        key, *[F.coalesce(F.col(f"`{h}`"), F.lit(0)).cast("bigint").alias(str(h)) for h in range(24)]
    )
