"""Sinks (K1-K9). A failed write fails the job; nothing is swallowed.

CSV is written with leading/trailing spaces kept, so raw text survives a
round trip unchanged (Spark's CSV writer trims by default).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> str:
    """CSV directory, header on by default (K1, K2, K4, K6, K7)."""
    (
        df.write.mode(mode)
        .option("header", header)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Iterable[str] = ()) -> str:
    """Parquet directory, optionally partitioned (K3)."""
    writer = df.write.mode(mode)
    cols = list(partition_by)
    if cols:
        writer = writer.partitionBy(*cols)
    writer.parquet(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON Lines directory, one record per row (K5, K6)."""
    df.write.mode(mode).json(path)
    return path


_WRITERS = {"csv": write_csv, "parquet": write_parquet, "json": write_json}


def write_result(
    df: DataFrame, base: str, formats: Iterable[str] = ("csv", "parquet"), mode: str = "overwrite"
) -> dict[str, str]:
    """Write one result in several formats under ``base/<fmt>_output`` (K9).

    The first format written is Parquet if it is asked for, and the others are
    then written from it, so the plan runs once and nothing is held by executors.
    """
    path = lambda fmt: f"{base.rstrip('/')}/{fmt}_output"
    order = sorted(formats, key=lambda fmt: fmt != "parquet")
    paths = {}
    for fmt in order:
        paths[fmt] = _WRITERS[fmt](df, path(fmt), mode=mode)
        if fmt == "parquet":
            df = df.sparkSession.read.parquet(paths[fmt])
    return paths


def write_clean_by_month(df: DataFrame, path: str, ts: str = "Timestamp", mode: str = "overwrite") -> str:
    """Cleaned rows as Parquet partitioned by ``event_month`` (first day of the month).

    With a real timestamp column and month folders, a later date-range filter
    is pushed to the Parquet reader and whole months are pruned by directory.
    """
    month = F.trunc(F.col(ts).cast("date"), "month").alias("event_month")
    return write_parquet(df.select("*", month), path, mode=mode, partition_by=["event_month"])


def write_quarantine(bad: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Rejected rows with their ``reason`` as Parquet (replaces count-and-drop)."""
    return write_parquet(bad, path, mode=mode)
