"""Dashboard report: filters, key figures, distinct values.

The reference builds these in pandas after loading whole CSVs into one
process; here each figure is an aggregate over the filtered DataFrame, and
without dates there is no date filter and no second scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.functions.cleaning import SEVERE_LEVELS, is_severe
from roadlens.operators.features import normalize_type

ALL = "All"


def _day_start(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, (dt.date, dt.datetime)):
        value = value.strftime("%Y-%m-%d")
    return F.lit(f"{str(value)[:10]} 00:00:00").cast("timestamp_ntz")


def filter_report(
    df: DataFrame,
    vtype: str | None = None,
    severity: str | None = None,
    start=None,
    end=None,
    end_mode: str = "whole_day",
    ts: str = "Timestamp",
    normalize: bool = False,
) -> DataFrame:
    """Optional equality filters and an inclusive date range.

    ``None`` or ``"All"`` means no filter, and so does a missing date.
    ``end_mode="whole_day"`` keeps all of the end day; ``"midnight"`` stops at
    its first second.
    """
    if end_mode not in ("midnight", "whole_day"):
        raise ValueError(f"unknown end_mode {end_mode!r}")
    if normalize:
        df = normalize_type(df)
    if vtype not in (None, ALL):
        df = df.filter(F.col("Violation_Type") == F.lit(vtype))
    if severity not in (None, ALL):
        df = df.filter(F.col("Severity") == F.lit(severity))
    if start is not None:
        df = df.filter(F.col(ts) >= _day_start(start))
    if end is not None:
        hi = _day_start(end)
        df = df.filter(F.col(ts) <= hi if end_mode == "midnight" else F.col(ts) < F.timestamp_add("DAY", F.lit(1), hi))
    return df


def severe_count(df: DataFrame, levels=SEVERE_LEVELS) -> DataFrame:
    """Rows whose severity is in the severe list."""
    return df.agg(F.count_if(is_severe("Severity", levels)).alias("severe_count"))


def key_figures(df: DataFrame) -> DataFrame:
    """One row: total, most common type, peak hour, top place, severe count.

    One pass: ``GROUPING SETS ((type), (hour), (place), ())`` counts every
    figure's groups in a single scan and shuffle, then one global aggregate
    picks each mode (ties -> smallest value). Empty input gives zeros and
    nulls (the reference shows ``N/A``).
    """
    vt, hr, loc = "Violation_Type", "hour", "Location"
    g = df.groupingSets([[vt], [hr], [loc], []], vt, hr, loc).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(is_severe("Severity")).alias("severe"),
        F.grouping_id().alias("gid"),
    )
    # grouping_id bits are (type, hour, place); a set bit = not grouped
    only_type, only_hour, only_place, total = 0b011, 0b101, 0b110, 0b111

    def mode(col: str, gid: int):
        pick = F.when((F.col("gid") == gid) & F.col(col).isNotNull(), F.struct((-F.col("n")).alias("k"), F.col(col).alias("v")))
        return F.min(pick).getField("v")

    return g.agg(
        F.coalesce(F.max(F.when(F.col("gid") == total, F.col("n"))), F.lit(0)).alias("total_records"),
        mode(vt, only_type).alias("most_common_type"),
        mode(hr, only_hour).alias("peak_hour"),
        mode(loc, only_place).alias("top_location"),
        F.coalesce(F.max(F.when(F.col("gid") == total, F.col("severe"))), F.lit(0)).alias("severe_count"),
    )


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-null values."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def time_bounds(df: DataFrame, ts: str = "Timestamp") -> DataFrame:
    """Earliest and latest time."""
    return df.agg(F.min(ts).alias("min_time"), F.max(ts).alias("max_time"))
