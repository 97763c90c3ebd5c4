"""Registered violation queries: Spark builders and their DuckDB oracle text.

Each Spark builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame
over the whole ``events`` table through the violations adapter. The oracle
text starts from the same adapter in DuckDB dialect. Column names match
one to one; floats are rounded to 6 places on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.functions.cleaning import ISO_FORMAT, coordinate, lenient_double, parse_ts
from roadlens.operators import aggregates as agg
from roadlens.operators import clean as cl
from roadlens.operators import features as ft
from roadlens.operators import hotspots as hs
from roadlens.operators import report as rp
from roadlens.plans.oracle import VIOLATIONS, with_views
from roadlens.session import cut_lineage
from roadlens.sources.adapters import raw_violations

# --------------------------------------------------------------------------
# Spark side: shared prefixes
# --------------------------------------------------------------------------


def raw(spark: SparkSession, d: str) -> DataFrame:
    return raw_violations(spark, d)


def clean(spark: SparkSession, d: str) -> DataFrame:
    return cl.clean_violations(raw(spark, d))


def timed(spark: SparkSession, d: str) -> DataFrame:
    return ft.time_features(clean(spark, d))


# Fixed values that must equal the reference's behaviour: 20-degree grid
# cells (truncating), hotspots at z above 1, the top 10 places.
GRID_SIZE = 20.0
Z_THRESHOLD = 1.0
TOP_PLACES = 10


def located(spark: SparkSession, d: str) -> DataFrame:
    return ft.with_grid_cells(ft.with_coordinates(timed(spark, d)), GRID_SIZE, "trunc")


def profile(spark: SparkSession, d: str) -> DataFrame:
    """The (cell, type, hour) counts: the one pass over the rows, checkpointed
    so that every hotspot step after it reads the small table."""
    return cut_lineage(hs.cell_profile(located(spark, d)))


def spots(spark: SparkSession, d: str) -> DataFrame:
    return hs.hotspots(cut_lineage(hs.counted_cells(located(spark, d))), Z_THRESHOLD)


def _on_spots(step):
    """Builder running ``step(profile, hotspots)`` on one shared profile."""

    def build(spark: SparkSession, d: str) -> DataFrame:
        prof = profile(spark, d)
        # the hotspot set (at most one row per cell) is used several times
        return step(prof, cut_lineage(hs.hotspots(hs.cell_counts(prof), Z_THRESHOLD)))

    return build


def _round_cols(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.round(F.col(c), 6).alias(c) if c in cols else F.col(c) for c in df.columns])


# Report parameters used by the registered dashboard queries.
REPORT_TYPE = "Speeding"
REPORT_START = "2024-01-03"
REPORT_END = "2024-01-25"


def _report_rows(spark, d, end_mode="whole_day"):
    return rp.filter_report(timed(spark, d), vtype=REPORT_TYPE, start=REPORT_START, end=REPORT_END, end_mode=end_mode)


def _even_record():
    return F.substr("Violation_ID", F.lit(2)).cast("bigint") % 2 == 0


SPARK = {
    # sources / scans
    "scan_parquet": raw,
    # cleaning
    "trim_all": lambda s, d: cl.trim_all(raw(s, d)),
    "parse_fine": lambda s, d: cl.with_fine(raw(s, d)).select("Violation_ID", "Fine_Amount"),
    "coerce_numeric": lambda s, d: raw(s, d).select(
        "Violation_ID", lenient_double("Fine_Amount").alias("Fine_Amount")
    ),
    "parse_ts_iso": lambda s, d: raw(s, d).select(
        "Violation_ID", parse_ts("Timestamp", [ISO_FORMAT]).alias("Timestamp")
    ),
    "parse_ts_multi": lambda s, d: raw(s, d).select(
        "Violation_ID", parse_ts("Timestamp").alias("Timestamp")
    ),
    "parse_ts_default": lambda s, d: cl.trim_all(raw(s, d)).select(
        "Violation_ID", parse_ts("Timestamp", None).alias("Timestamp_safe")
    ),
    "good_rows": lambda s, d: cl.good_rows(raw(s, d)),
    "bad_rows": lambda s, d: cl.bad_rows(raw(s, d)),
    "clean": clean,
    "quarantine": lambda s, d: cl.quarantine(raw(s, d)),
    "time_features": lambda s, d: timed(s, d).select("Violation_ID", "hour", "day_of_week", "month"),
    "parse_location": lambda s, d: raw(s, d).select(
        "Violation_ID",
        coordinate("Location", 0).alias("Latitude"),
        coordinate("Location", 1).alias("Longitude"),
    ),
    "grid_cells": lambda s, d: located(s, d).select(
        "Violation_ID", "Latitude", "Longitude", "lat_cell", "lon_cell"
    ),
    "normalize_type": lambda s, d: ft.normalize_type(raw(s, d)).select("Violation_ID", "Violation_Type"),
    # aggregates
    "total_count": lambda s, d: agg.total_count(clean(s, d)),
    "by_type": lambda s, d: agg.count_by(clean(s, d), "Violation_Type"),
    "by_severity": lambda s, d: agg.count_by(clean(s, d), "Severity"),
    "by_vehicle": lambda s, d: agg.count_by(clean(s, d), "Vehicle_Type"),
    "by_location": lambda s, d: agg.count_by(clean(s, d), "Location", "Total_Violations"),
    "top_locations": lambda s, d: agg.top_n(
        agg.count_by(clean(s, d), "Location", "Total_Violations"), "Location", "Total_Violations", TOP_PLACES
    ),
    "ranked_locations": lambda s, d: agg.ranked(
        agg.count_by(clean(s, d), "Location", "Total_Violations"), "Location", "Total_Violations"
    ),
    "type_hour_crosstab": lambda s, d: agg.crosstab_hours(timed(s, d)),
    "unpivot_hours": lambda s, d: ft.unpivot_hours(
        agg.crosstab_hours(timed(s, d)), "Violation_Type_hour"
    ),
    "hourly_profile": lambda s, d: agg.hourly_profile(timed(s, d)),
    # two deliveries that share no row: the second, by even record numbers, came without fines
    "union_batches": lambda s, d: raw(s, d).filter(~_even_record()).unionByName(
        raw(s, d).filter(_even_record()).drop("Fine_Amount"), allowMissingColumns=True
    ),
    # hotspots
    "cell_counts": lambda s, d: hs.counted_cells(located(s, d)),
    "cell_stats": lambda s, d: _round_cols(
        hs.cell_stats(hs.counted_cells(located(s, d))), {"mean_count", "std_count"}
    ),
    "cell_zscores": lambda s, d: hs.cell_zscores(cut_lineage(hs.counted_cells(located(s, d)))).drop("_fallback"),
    "hotspots": spots,
    "hotspot_rows": lambda s, d: hs.hotspot_rows(located(s, d), spots(s, d)).select(
        "Violation_ID", "lat_cell", "lon_cell", "Violation_Type", "hour", "violation_count", "z_score"
    ),
    "hotspot_type_counts": _on_spots(hs.hotspot_type_counts),
    "hotspot_hour_counts": _on_spots(hs.hotspot_hour_counts),
    "top_violation": _on_spots(hs.top_violation),
    "hotspot_peak_hour": _on_spots(hs.peak_hour),
    "structured_hotspots": _on_spots(hs.structured_hotspots),
    "combined_hotspots": _on_spots(hs.combined_hotspots),
    # dashboard
    "filter_report": lambda s, d: _report_rows(s, d).select(
        "Violation_ID", "Timestamp", "Location", "Violation_Type", "Severity", "Fine_Amount"
    ),
    "filter_report_midnight": lambda s, d: _report_rows(s, d, "midnight").select(
        "Violation_ID", "Timestamp", "Location", "Violation_Type", "Severity", "Fine_Amount"
    ),
    "bad_locations": lambda s, d: cl.bad_locations(clean(s, d)),
    "accepted_rows": lambda s, d: cl.accepted_rows(raw(s, d)),
    "type_distribution": lambda s, d: agg.count_by(
        rp.filter_report(timed(s, d)), "Violation_Type", drop_null=True
    ),
    "hourly_counts": lambda s, d: agg.count_by(rp.filter_report(timed(s, d)), "hour", drop_null=True),
    "most_common_type": lambda s, d: agg.top_value(
        rp.filter_report(timed(s, d)), "Violation_Type", "most_common_type"
    ),
    "top_location": lambda s, d: agg.top_value(rp.filter_report(timed(s, d)), "Location", "top_location"),
    "peak_hour": lambda s, d: agg.top_value(rp.filter_report(timed(s, d)), "hour", "peak_hour"),
    "severe_count": lambda s, d: rp.severe_count(rp.filter_report(timed(s, d))),
    "key_figures": lambda s, d: rp.key_figures(rp.filter_report(timed(s, d), normalize=True)),
    "distinct_types": lambda s, d: rp.distinct_values(clean(s, d), "Violation_Type"),
    "distinct_severities": lambda s, d: rp.distinct_values(clean(s, d), "Severity"),
    "time_bounds": lambda s, d: rp.time_bounds(clean(s, d)),
}

# --------------------------------------------------------------------------
# DuckDB side
# --------------------------------------------------------------------------

_COLS = ["Violation_ID", "Timestamp", "Location", "Violation_Type", "Vehicle_Type", "Severity", "Fine_Amount"]

TRIM = "SELECT " + ", ".join(f"trim({c}) AS {c}" for c in _COLS) + " FROM v"

FINE = (
    "CASE WHEN regexp_matches(Fine_Amount, '^[0-9]+(\\.[0-9]+)?$') "
    "THEN TRY_CAST(Fine_Amount AS DOUBLE) END"
)
GOOD = f"SELECT * REPLACE ({FINE} AS Fine_Amount) FROM t WHERE ({FINE}) IS NOT NULL"

TS_MULTI = (
    "coalesce(try_strptime(Timestamp, '%Y-%m-%d %H:%M:%S'), "
    "try_strptime(Timestamp, '%d/%m/%Y %H:%M:%S'), try_strptime(Timestamp, '%m/%d/%Y %H:%M:%S'))"
)
CLEAN = f"SELECT * REPLACE ({TS_MULTI} AS Timestamp) FROM g WHERE {TS_MULTI} IS NOT NULL"
TIMED = (
    "SELECT *, CAST(hour(Timestamp) AS INTEGER) AS hour, CAST(dayofweek(Timestamp) + 1 AS INTEGER) AS day_of_week, "
    "CAST(month(Timestamp) AS INTEGER) AS month FROM c"
)
def _coordinate(index: int, limit: int) -> str:
    value = f"TRY_CAST(trim(string_split(Location, ',')[{index}]) AS DOUBLE)"
    return f"CASE WHEN isfinite({value}) AND abs({value}) <= {limit} THEN {value} END"


LAT, LON = _coordinate(1, 90), _coordinate(2, 180)
LOCATED = (
    f"SELECT *, CAST(CAST(trunc(Latitude / 20.0) AS INTEGER) * 20 AS DOUBLE) AS lat_cell, "
    f"CAST(CAST(trunc(Longitude / 20.0) AS INTEGER) * 20 AS DOUBLE) AS lon_cell "
    f"FROM (SELECT *, {LAT} AS Latitude, {LON} AS Longitude FROM tm) "
    f"WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL"
)
CELLS = "SELECT lat_cell, lon_cell, count(*) AS violation_count FROM loc GROUP BY lat_cell, lon_cell"
ZSCORES = (
    "SELECT lat_cell, lon_cell, violation_count, "
    "CASE WHEN sd IS NULL OR sd = 0 THEN NULL ELSE round((violation_count - mean) / sd, 6) END AS z_score, "
    "(sd IS NULL OR sd = 0) AS fallback "
    "FROM cells, (SELECT avg(violation_count) AS mean, stddev_samp(violation_count) AS sd FROM cells)"
)
SPOTS = (
    "SELECT lat_cell, lon_cell, violation_count, z_score FROM z "
    "WHERE CASE WHEN fallback THEN violation_count > 1 ELSE z_score > 1 END"
)
TYPE_COUNTS = (
    "SELECT lat_cell, lon_cell, Violation_Type, count(*) AS violation_type_count FROM loc "
    "WHERE (lat_cell, lon_cell) IN (SELECT (lat_cell, lon_cell) FROM spots) "
    "GROUP BY lat_cell, lon_cell, Violation_Type"
)
HOUR_COUNTS = (
    "SELECT lat_cell, lon_cell, hour, count(*) AS hour_count FROM loc "
    "WHERE (lat_cell, lon_cell) IN (SELECT (lat_cell, lon_cell) FROM spots) "
    "GROUP BY lat_cell, lon_cell, hour"
)
TOP_TYPE = (
    "SELECT lat_cell, lon_cell, Violation_Type, violation_type_count FROM ("
    "SELECT *, row_number() OVER (PARTITION BY lat_cell, lon_cell ORDER BY violation_type_count DESC, "
    "Violation_Type ASC NULLS LAST) AS rn FROM tc) WHERE rn = 1"
)
PEAK = (
    "SELECT lat_cell, lon_cell, hour, hour_count FROM ("
    "SELECT *, row_number() OVER (PARTITION BY lat_cell, lon_cell ORDER BY hour_count DESC, hour ASC) AS rn "
    "FROM hc) WHERE rn = 1"
)

REPORT_FILTER = (
    "SELECT * FROM tm WHERE Violation_Type = '{vtype}' "
    "AND Timestamp >= TIMESTAMP '{start} 00:00:00' AND Timestamp {end}"
)
# No type, severity or date given: all rows.
REPORT_ALL = "SELECT * FROM tm"
TITLE = (
    "CASE WHEN Violation_Type IS NULL THEN NULL ELSE array_to_string(list_transform("
    "regexp_extract_all(lower(trim(Violation_Type)), '\\p{L}+|\\P{L}+'), lambda w: upper(w[1:1]) || w[2:]), '') END"
)


def _base(**extra: str) -> dict[str, str]:
    views = {"v": VIOLATIONS, "t": TRIM, "g": GOOD, "c": CLEAN, "tm": TIMED, "loc": LOCATED}
    views.update(extra)
    return views


def _hot(**extra: str) -> dict[str, str]:
    return _base(cells=CELLS, z=ZSCORES, spots=SPOTS, tc=TYPE_COUNTS, hc=HOUR_COUNTS,
                 tt=TOP_TYPE, ph=PEAK, **extra)


def _q(body: str, views: dict[str, str]) -> str:
    return with_views(body, **views)


_HOURS = ", ".join(f"count(*) FILTER (WHERE hour = {h}) AS \"{h}\"" for h in range(24))
_CROSSTAB = f"SELECT coalesce(Violation_Type, 'null') AS Violation_Type_hour, {_HOURS} FROM tm GROUP BY 1"
_UNPIVOT = " UNION ALL ".join(
    f"SELECT Violation_Type_hour, {h} AS hour, \"{h}\" AS count FROM ct" for h in range(24)
)
_LOC_COUNTS = "SELECT Location, count(*) AS Total_Violations FROM c GROUP BY Location"


def _mode(col: str, alias: str, src: str = "ra") -> str:
    return (
        f"SELECT {col} AS {alias}, count FROM (SELECT {col}, count(*) AS count FROM {src} "
        f"WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY count DESC, {col} ASC LIMIT 1) "
        f"RIGHT JOIN (SELECT 1) ON TRUE"
    )


SQL = {
    "scan_parquet": _q("SELECT * FROM v", {"v": VIOLATIONS}),
    "trim_all": _q("SELECT * FROM t", {"v": VIOLATIONS, "t": TRIM}),
    "parse_fine": _q(f"SELECT Violation_ID, {FINE} AS Fine_Amount FROM v", {"v": VIOLATIONS}),
    "coerce_numeric": _q(
        "SELECT Violation_ID, TRY_CAST(trim(Fine_Amount) AS DOUBLE) AS Fine_Amount FROM v", {"v": VIOLATIONS}
    ),
    "parse_ts_iso": _q(
        "SELECT Violation_ID, try_strptime(Timestamp, '%Y-%m-%d %H:%M:%S') AS Timestamp FROM v",
        {"v": VIOLATIONS},
    ),
    "parse_ts_multi": _q(f"SELECT Violation_ID, {TS_MULTI} AS Timestamp FROM v", {"v": VIOLATIONS}),
    "parse_ts_default": _q(
        "SELECT Violation_ID, TRY_CAST(Timestamp AS TIMESTAMP) AS Timestamp_safe FROM t",
        {"v": VIOLATIONS, "t": TRIM},
    ),
    "good_rows": _q("SELECT * FROM g", {"v": VIOLATIONS, "t": TRIM, "g": GOOD}),
    "bad_rows": _q(
        f"SELECT *, CASE WHEN Fine_Amount IS NULL THEN 'missing_fine' ELSE 'invalid_fine' END AS reason "
        f"FROM t WHERE ({FINE}) IS NULL",
        {"v": VIOLATIONS, "t": TRIM},
    ),
    "clean": _q("SELECT * FROM c", _base()),
    "quarantine": _q(
        f"SELECT * FROM (SELECT *, CASE WHEN Fine_Amount IS NULL THEN 'missing_fine' "
        f"WHEN ({FINE}) IS NULL THEN 'invalid_fine' WHEN {TS_MULTI} IS NULL THEN 'bad_timestamp' END AS reason "
        f"FROM t) WHERE reason IS NOT NULL",
        {"v": VIOLATIONS, "t": TRIM},
    ),
    "time_features": _q("SELECT Violation_ID, hour, day_of_week, month FROM tm", _base()),
    "parse_location": _q(f"SELECT Violation_ID, {LAT} AS Latitude, {LON} AS Longitude FROM v", {"v": VIOLATIONS}),
    "grid_cells": _q("SELECT Violation_ID, Latitude, Longitude, lat_cell, lon_cell FROM loc", _base()),
    "normalize_type": _q(f"SELECT Violation_ID, {TITLE} AS Violation_Type FROM v", {"v": VIOLATIONS}),
    "total_count": _q("SELECT count(*) AS total_count FROM c", _base()),
    "by_type": _q("SELECT Violation_Type, count(*) AS count FROM c GROUP BY 1", _base()),
    "by_severity": _q("SELECT Severity, count(*) AS count FROM c GROUP BY 1", _base()),
    "by_vehicle": _q("SELECT Vehicle_Type, count(*) AS count FROM c GROUP BY 1", _base()),
    "by_location": _q(_LOC_COUNTS, _base()),
    "top_locations": _q(
        f"SELECT * FROM ({_LOC_COUNTS}) ORDER BY Total_Violations DESC, Location ASC NULLS LAST LIMIT 10", _base()
    ),
    "ranked_locations": _q(f"SELECT * FROM ({_LOC_COUNTS})", _base()),
    "type_hour_crosstab": _q(_CROSSTAB, _base()),
    "unpivot_hours": _q(_UNPIVOT, _base(ct=_CROSSTAB)),
    "hourly_profile": _q(
        "SELECT CAST(h.hour AS INTEGER) AS hour, CAST(coalesce(n.count, 0) AS BIGINT) AS count "
        "FROM range(24) AS h(hour) LEFT JOIN (SELECT hour, count(*) AS count FROM tm GROUP BY hour) n "
        "ON h.hour = n.hour",
        _base(),
    ),
    "union_batches": _q(
        "SELECT * REPLACE (CASE WHEN CAST(Violation_ID[2:] AS BIGINT) % 2 = 0 THEN NULL ELSE Fine_Amount END AS Fine_Amount) FROM v",
        {"v": VIOLATIONS},
    ),
    "cell_counts": _q("SELECT * FROM cells", _hot()),
    "cell_stats": _q(
        "SELECT round(avg(violation_count), 6) AS mean_count, round(stddev_samp(violation_count), 6) AS std_count "
        "FROM cells",
        _hot(),
    ),
    "cell_zscores": _q("SELECT lat_cell, lon_cell, violation_count, z_score FROM z", _hot()),
    "hotspots": _q("SELECT * FROM spots", _hot()),
    "hotspot_rows": _q(
        "SELECT l.Violation_ID, l.lat_cell, l.lon_cell, l.Violation_Type, l.hour, s.violation_count, s.z_score "
        "FROM loc l JOIN spots s ON l.lat_cell = s.lat_cell AND l.lon_cell = s.lon_cell",
        _hot(),
    ),
    "hotspot_type_counts": _q("SELECT * FROM tc", _hot()),
    "hotspot_hour_counts": _q("SELECT * FROM hc", _hot()),
    "top_violation": _q("SELECT * FROM tt", _hot()),
    "hotspot_peak_hour": _q("SELECT * FROM ph", _hot()),
    "structured_hotspots": _q(
        "SELECT lat_cell, lon_cell, violation_count, z_score, Violation_Type, hour "
        "FROM tt JOIN ph USING (lat_cell, lon_cell) JOIN spots USING (lat_cell, lon_cell)",
        _hot(),
    ),
    "combined_hotspots": _q(
        "SELECT * FROM spots FULL OUTER JOIN tt USING (lat_cell, lon_cell) "
        "FULL OUTER JOIN ph USING (lat_cell, lon_cell) ORDER BY lat_cell, lon_cell",
        _hot(),
    ),
    "filter_report": _q(
        "SELECT Violation_ID, Timestamp, Location, Violation_Type, Severity, Fine_Amount FROM rf",
        _base(rf=REPORT_FILTER.format(vtype=REPORT_TYPE, start=REPORT_START, end=f"< TIMESTAMP '{REPORT_END} 00:00:00' + INTERVAL 1 DAY")),
    ),
    "filter_report_midnight": _q(
        "SELECT Violation_ID, Timestamp, Location, Violation_Type, Severity, Fine_Amount FROM rf",
        _base(rf=REPORT_FILTER.format(vtype=REPORT_TYPE, start=REPORT_START, end=f"<= TIMESTAMP '{REPORT_END} 00:00:00'")),
    ),
    "bad_locations": _q(
        f"SELECT * FROM (SELECT *, CASE WHEN Location IS NULL THEN 'missing_location' WHEN len(string_split(Location, ',')) < 2 THEN 'not_a_pair' "
        f"WHEN ({LAT}) IS NULL THEN 'bad_latitude' WHEN ({LON}) IS NULL THEN 'bad_longitude' END AS reason FROM c) WHERE reason IS NOT NULL",
        _base(),
    ),
    "accepted_rows": _q(f"SELECT * FROM g WHERE {TS_MULTI} IS NOT NULL", _base()),
    "type_distribution": _q(
        "SELECT Violation_Type, count(*) AS count FROM ra WHERE Violation_Type IS NOT NULL GROUP BY 1",
        _base(ra=REPORT_ALL),
    ),
    "hourly_counts": _q(
        "SELECT hour, count(*) AS count FROM ra WHERE hour IS NOT NULL GROUP BY 1", _base(ra=REPORT_ALL)
    ),
    "most_common_type": _q(_mode("Violation_Type", "most_common_type"), _base(ra=REPORT_ALL)),
    "top_location": _q(_mode("Location", "top_location"), _base(ra=REPORT_ALL)),
    "peak_hour": _q(_mode("hour", "peak_hour"), _base(ra=REPORT_ALL)),
    "severe_count": _q(
        "SELECT count(*) FILTER (WHERE Severity IN ('High', 'Severe', 'Critical')) AS severe_count FROM ra",
        _base(ra=REPORT_ALL),
    ),
    "key_figures": _q(
        "SELECT (SELECT count(*) FROM ran) AS total_records, "
        "(SELECT most_common_type FROM mt) AS most_common_type, "
        "(SELECT peak_hour FROM ph) AS peak_hour, "
        "(SELECT top_location FROM tl) AS top_location, "
        "(SELECT count(*) FROM ran WHERE Severity IN ('High', 'Severe', 'Critical')) AS severe_count",
        _base(
            ra=REPORT_ALL,
            ran=f"SELECT * REPLACE ({TITLE} AS Violation_Type) FROM ra",
            mt=_mode("Violation_Type", "most_common_type", "ran"),
            ph=_mode("hour", "peak_hour", "ran"),
            tl=_mode("Location", "top_location", "ran"),
        ),
    ),
    "distinct_types": _q(
        "SELECT DISTINCT Violation_Type FROM c WHERE Violation_Type IS NOT NULL", _base()
    ),
    "distinct_severities": _q("SELECT DISTINCT Severity FROM c WHERE Severity IS NOT NULL", _base()),
    "time_bounds": _q("SELECT min(Timestamp) AS min_time, max(Timestamp) AS max_time FROM c", _base()),
}
