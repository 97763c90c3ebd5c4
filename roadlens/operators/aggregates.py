"""Counts, crosstab, dense profiles, modes and histograms.

All of these are hash aggregates with map-side partial aggregation, so a hot
key (one place holding a third of the rows) is combined inside each task
before the shuffle. "Top-1" answers use ``min(struct(-count, value))``, a
plain aggregate with a total order, instead of a sort or an arbitrary mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.session import cut_lineage

HOURS = list(range(24))


def total_count(df: DataFrame, name: str = "total_count") -> DataFrame:
    """One row: number of rows (G1)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def count_by(df: DataFrame, col: str, name: str = "count", drop_null: bool = False) -> DataFrame:
    """Rows per value of ``col``; null is its own group unless ``drop_null``."""
    if drop_null:
        df = df.filter(F.col(col).isNotNull())
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def ranked(counts: DataFrame, key: str, count_col: str) -> DataFrame:
    """Sort by count desc, then key asc (nulls last): a total order (L2)."""
    return counts.orderBy(F.col(count_col).desc(), F.col(key).asc_nulls_last())


def top_n(counts: DataFrame, key: str, count_col: str, n: int = 10) -> DataFrame:
    """First ``n`` of :func:`ranked`; plans as TakeOrderedAndProject (L1)."""
    return ranked(counts, key, count_col).limit(n)


def crosstab_hours(df: DataFrame, row_col: str = "Violation_Type", hour_col: str = "hour") -> DataFrame:
    """Type x hour counts with the 24 hours as fixed columns ``"0"``..``"23"``.

    Fixed pivot values mean no eager job to discover labels and a stable
    schema; a null row key becomes the label ``null`` as in ``crosstab``.
    """
    key = f"{row_col}_{hour_col}"
    wide = (
        df.select(F.coalesce(F.col(row_col), F.lit("null")).alias(key), F.col(hour_col))
        .groupBy(key)
        .pivot(hour_col, HOURS)
        .agg(F.count(F.lit(1)))
    )
    return wide.select(
        key, *[F.coalesce(F.col(f"`{h}`"), F.lit(0)).cast("bigint").alias(str(h)) for h in HOURS]
    )


def hourly_profile(df: DataFrame, hour_col: str = "hour", name: str = "count") -> DataFrame:
    """All 24 hours with their counts, zero filled."""
    counts = count_by(df.filter(F.col(hour_col).between(0, 23)), hour_col, name, drop_null=True)  # 24 rows at most
    spine = df.sparkSession.range(24).select(F.col("id").cast("int").alias(hour_col))
    return spine.join(F.broadcast(counts), hour_col, "left").select(
        hour_col, F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)
    )


def top_value(df: DataFrame, col: str, value_name: str | None = None, count_name: str = "count") -> DataFrame:
    """Most frequent non-null value; ties go to the smallest value.

    One row, or one row of nulls when there is no non-null value.
    """
    counts = count_by(df, col, "_n", drop_null=True)
    best = F.min(F.struct((-F.col("_n")).alias("neg"), F.col(col).alias("v")))
    return counts.agg(best.alias("_b")).select(
        F.col("_b.v").alias(value_name or col), (-F.col("_b.neg")).alias(count_name)
    )


def share(counts: DataFrame, count_col: str = "count", name: str = "percent") -> DataFrame:
    """Per-row percentage of the column total (G17); the total is a scalar subquery."""
    total = counts.agg(F.sum(count_col)).scalar()
    return counts.withColumn(name, F.round(F.lit(100.0) * F.col(count_col) / total, 6))


def explode_count(df: DataFrame, col: str, sep: str = ";", name: str = "violation",
                  count_name: str = "count") -> DataFrame:
    """Split ``sep``-joined text, one row per item, count per item."""
    items = df.filter(F.col(col).isNotNull() & (F.col(col) != "")).select(
        F.explode(F.split(F.col(col), sep, -1)).alias(name)
    )
    return items.groupBy(name).agg(F.count(F.lit(1)).alias(count_name))


def histogram(df: DataFrame, col: str, bins: int = 20, materialize: bool = True) -> DataFrame:
    """Equal-width histogram over [min, max], last bin closed.

    Bins ``1..bins`` are all present (zeros included). When min = max every
    value falls into bin 1. Values are first reduced to distinct values with
    a multiplicity (a partial aggregate) and, with ``materialize``, that small
    table is checkpointed: the bounds (a one-row scalar subquery) and the
    binning then both read it instead of re-running the input plan twice.
    """
    vals = (
        df.select(F.col(col).cast("double").alias("x"))
        .filter(F.col("x").isNotNull())
        .groupBy("x")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if materialize:
        vals = cut_lineage(vals)
    bounds = vals.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    lo, hi = bounds.getField("lo"), bounds.getField("hi")
    width = hi - lo
    raw_bin = F.floor((F.col("x") - lo) / width * F.lit(bins)).cast("bigint") + 1
    b = F.when(width == 0, F.lit(1)).otherwise(F.least(raw_bin, F.lit(bins)))
    counts = vals.select(b.cast("bigint").alias("bin"), "n").groupBy("bin").agg(
        F.sum("n").alias("count")
    )
    spine = df.sparkSession.range(1, bins + 1).select(F.col("id").alias("bin"))
    return (
        spine.filter(lo.isNotNull())
        .join(F.broadcast(counts), "bin", "left")
        .select(
            "bin",
            F.round(lo + (F.col("bin") - 1) * width / F.lit(bins), 6).alias("bin_lo"),
            F.round(lo + F.col("bin") * width / F.lit(bins), 6).alias("bin_hi"),
            F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
        )
    )
