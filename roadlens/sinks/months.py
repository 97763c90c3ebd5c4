"""Incremental ingest by month with a manifest (K3, K9).

A delivery replaces the months it holds and leaves the others alone (dynamic
partition overwrite). The manifest is a table of its own, one row per month:
which delivery the month's rows come from, how many they are, and their first
and last time. It is written last and by the same rule, and readers join with
it, so rows of a delivery show only once its manifest stands, and a delivery
that failed half-way can be run again under its label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH = "event_month"
LABEL = "delivery"


def _replace_months(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def _summary(rows: DataFrame, ts: str) -> DataFrame:
    return rows.groupBy(MONTH, LABEL).agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_time"), F.max(ts).alias("last_time"))


def ingest_months(df: DataFrame, path: str, manifest: str, label: str, ts: str = "Timestamp") -> None:
    """Put ``df`` in place of the months it has rows for, and those months in the manifest."""
    month = F.trunc(F.col(ts).cast("date"), "month").alias(MONTH)
    _replace_months(df.select("*", F.lit(label).alias(LABEL), month), path)
    # what was written, not what was meant to be: the label's rows stand in the months just replaced
    written = df.sparkSession.read.parquet(path).where(F.col(LABEL) == label)
    _replace_months(_summary(written, ts), manifest)


def read_months(spark: SparkSession, path: str, manifest: str) -> DataFrame:
    """Rows of the deliveries that the manifest lists for their months."""
    listed = spark.read.parquet(manifest).select(F.col(MONTH).alias("_month"), F.col(LABEL).alias("_label"))
    rows = spark.read.parquet(path)
    return rows.join(listed, rows[MONTH].eqNullSafe(listed["_month"]) & (rows[LABEL] == listed["_label"]), "left_semi")


def manifest_faults(spark: SparkSession, path: str, manifest: str, ts: str = "Timestamp") -> DataFrame:
    """Months whose rows are not those the manifest tells of: month, delivery, rows found, rows listed."""
    found = _summary(spark.read.parquet(path), ts).select(MONTH, LABEL, F.col("rows").alias("found"))
    listed = spark.read.parquet(manifest).select(F.col(MONTH).alias("_month"), F.col(LABEL).alias("_label"), F.col("rows").alias("listed"))
    both = found.join(listed, found[MONTH].eqNullSafe(listed["_month"]) & (found[LABEL] == listed["_label"]), "full")
    odd = both.where(~F.col("found").eqNullSafe(F.col("listed")))
    return odd.select(F.coalesce(MONTH, "_month").alias(MONTH), F.coalesce(LABEL, "_label").alias(LABEL), "found", "listed")
