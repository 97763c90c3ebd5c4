"""Grid hotspots: cell counts, z-scores, top type and peak hour.

Plan shape: the violation rows are aggregated once into a *cell profile*
``(lat_cell, lon_cell, Violation_Type, hour, n)`` with map-side partial
aggregation; every later step (cell counts, statistics, z-scores, top type,
peak hour, joins) runs on that small table. The rows are shuffled once, a
hot cell is combined inside each task, and the global mean/stddev arrive as
a one-row scalar subquery, never through the Python driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.session import cut_lineage

CELL = ["lat_cell", "lon_cell"]


def cell_profile(rows: DataFrame, type_col: str = "Violation_Type", hour_col: str = "hour") -> DataFrame:
    """Counts per (cell, type, hour): the single shuffle of the row data."""
    return rows.groupBy(*CELL, F.col(type_col).alias("Violation_Type"), F.col(hour_col).alias("hour")).agg(
        F.count(F.lit(1)).alias("n")
    )


def counted_cells(rows: DataFrame) -> DataFrame:
    """Violations per non-empty cell straight from the rows, where nothing else needs their profile."""
    return rows.groupBy(*CELL).agg(F.count(F.lit(1)).alias("violation_count"))


def cell_counts(profile: DataFrame) -> DataFrame:
    """Violations per non-empty cell."""
    return profile.groupBy(*CELL).agg(F.sum("n").cast("bigint").alias("violation_count"))


def cell_stats(counts: DataFrame) -> DataFrame:
    """Mean and sample stddev of cell counts; stddev null for one cell."""
    return counts.agg(
        F.mean("violation_count").alias("mean_count"),
        F.stddev_samp("violation_count").alias("std_count"),
    )


def cell_zscores(counts: DataFrame) -> DataFrame:
    """Each cell with ``z_score`` = (n - mean) / sd, null when sd is null or 0.

    z is rounded to 6 places, the precision the reference's decimal result has.
    """
    stats = cell_stats(counts).select(F.struct("mean_count", "std_count").alias("s")).scalar()
    mean, sd = stats.getField("mean_count"), stats.getField("std_count")
    z = F.when(sd.isNull() | (sd == 0), F.lit(None).cast("double")).otherwise(
        F.round((F.col("violation_count") - mean) / sd, 6)
    )
    fallback = sd.isNull() | (sd == 0)
    return counts.select(*CELL, "violation_count", z.alias("z_score"), fallback.alias("_fallback"))


def hotspots(counts: DataFrame, z_threshold: float = 1.0, min_count: int = 1) -> DataFrame:
    """Cells with z strictly above ``z_threshold``; count > ``min_count`` when sd is 0 or null."""
    z = cell_zscores(counts)
    keep = F.when(F.col("_fallback"), F.col("violation_count") > min_count).otherwise(
        F.col("z_score") > z_threshold
    )
    return z.filter(keep).drop("_fallback")


def hotspot_rows(rows: DataFrame, spots: DataFrame) -> DataFrame:
    """Violation rows that fall in a hotspot cell, with the cell's figures.

    A plain join: Catalyst broadcasts the hotspots if they are small, and
    adaptive execution splits a hot cell if they are not.
    """
    return rows.join(spots, CELL)


def _in_hotspots(profile: DataFrame, spots: DataFrame) -> DataFrame:
    return profile.join(spots.select(*CELL), CELL, "left_semi")


def hotspot_type_counts(profile: DataFrame, spots: DataFrame) -> DataFrame:
    """Per hotspot cell: violations per type."""
    return (
        _in_hotspots(profile, spots)
        .groupBy(*CELL, "Violation_Type")
        .agg(F.sum("n").cast("bigint").alias("violation_type_count"))
    )


def hotspot_hour_counts(profile: DataFrame, spots: DataFrame) -> DataFrame:
    """Per hotspot cell: violations per hour."""
    return (
        _in_hotspots(profile, spots)
        .groupBy(*CELL, "hour")
        .agg(F.sum("n").cast("bigint").alias("hour_count"))
    )


def _best(count_col: str, value_col: str, when: Column | None = None) -> Column:
    """The value with the largest count, as (count, value); ties -> smallest value, null last."""
    pick = F.struct((-F.col(count_col)).alias("back"), F.col(value_col).isNull().alias("none"), F.col(value_col).alias("value"))
    return F.min(pick if when is None else F.when(when, pick))


def _first_per_cell(df: DataFrame, count_col: str, value_col: str) -> DataFrame:
    best = df.groupBy(*CELL).agg(_best(count_col, value_col).alias("best"))
    return best.select(*CELL, F.col("best.value").alias(value_col), (-F.col("best.back")).alias(count_col))


def top_violation(profile: DataFrame, spots: DataFrame) -> DataFrame:
    """Most frequent type per hotspot; ties -> smallest type, null last."""
    return _first_per_cell(hotspot_type_counts(profile, spots), "violation_type_count", "Violation_Type")


def peak_hour(profile: DataFrame, spots: DataFrame) -> DataFrame:
    """Busiest hour per hotspot; ties -> earliest hour."""
    return _first_per_cell(hotspot_hour_counts(profile, spots), "hour_count", "hour")


def structured_hotspots(profile: DataFrame, spots: DataFrame) -> DataFrame:
    """Hotspot with its top type and peak hour: three-way inner join."""
    top = top_violation(profile, spots)
    peak = peak_hour(profile, spots)
    return (
        top.join(peak, CELL, "inner")
        .join(spots, CELL, "inner")
        .select(*CELL, "violation_count", "z_score", "Violation_Type", "hour")
    )


def tops_per_hotspot(profile: DataFrame, spots: DataFrame) -> DataFrame:
    """Top type and peak hour of each hotspot in one pass over its profile.

    Grouping sets count per (cell, type) and per (cell, hour); a second
    aggregate picks the best of each kind.
    """
    by_type, by_hour = 0b0001, 0b0010  # grouping_id bits of (lat, lon, type, hour): a set bit is not grouped
    counts = (
        _in_hotspots(profile, spots)
        .groupingSets([[*CELL, "Violation_Type"], [*CELL, "hour"]], *CELL, "Violation_Type", "hour")
        .agg(F.sum("n").cast("bigint").alias("n"), F.grouping_id().alias("gid"))
    )
    best = counts.groupBy(*CELL).agg(
        _best("n", "Violation_Type", F.col("gid") == by_type).alias("t"), _best("n", "hour", F.col("gid") == by_hour).alias("h")
    )
    return best.select(
        *CELL,
        F.col("t.value").alias("Violation_Type"),
        (-F.col("t.back")).alias("violation_type_count"),
        F.col("h.value").alias("hour"),
        (-F.col("h.back")).alias("hour_count"),
    )


def combined_hotspots(profile: DataFrame, spots: DataFrame) -> DataFrame:
    """Hotspots with top type and peak hour and their counts, ordered by cell.

    Both tops come from the hotspots' own rows, so keeping every hotspot keeps every row.
    """
    return spots.join(tops_per_hotspot(profile, spots), CELL, "left").orderBy(*CELL)


def hotspot_report(rows: DataFrame, z_threshold: float = 1.0) -> dict[str, DataFrame]:
    """Every hotspot output from one pass over ``rows``.

    The cell profile is checkpointed, so the rows are read and shuffled once and
    every output below reads the small table.
    """
    profile = cut_lineage(cell_profile(rows))
    counts = cell_counts(profile)
    spots = cut_lineage(hotspots(counts, z_threshold))
    return {
        "cell_counts": counts,
        "hotspots": spots,
        "top_violation": top_violation(profile, spots),
        "peak_hour": peak_hour(profile, spots),
        "structured_hotspots": structured_hotspots(profile, spots),
        "combined_hotspots": combined_hotspots(profile, spots),
    }
