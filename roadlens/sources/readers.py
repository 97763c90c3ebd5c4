"""File sources with explicit schemas.

No schema inference anywhere: inference costs an extra pass over the data
and makes the schema depend on the sample. Directories of part files are
read whole (the reference dashboard read only the first part file).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.schemas import CLEAN_VIOLATIONS, DETECTIONS, RAW_VIOLATIONS


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw violations CSV with a header, every column text."""
    return spark.read.schema(RAW_VIOLATIONS).option("header", True).csv(path)


def read_clean_csv(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned violations CSV with a header, fine as double."""
    return spark.read.schema(CLEAN_VIOLATIONS).option("header", True).csv(path)


def scan_parquet(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Parquet scan; selecting columns here prunes the read schema (S3)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_clean_by_month(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Month-partitioned cleaned rows; ``start``/``end`` (inclusive dates) prune
    month folders and push the timestamp range into the Parquet scan."""
    df = spark.read.parquet(path)
    if start is not None:
        lo = F.lit(str(start)[:10]).cast("date")
        df = df.filter((F.col("event_month") >= F.trunc(lo, "month"))
                       & (F.col("Timestamp") >= lo.cast("timestamp_ntz")))
    if end is not None:
        hi = F.lit(str(end)[:10]).cast("date")
        df = df.filter((F.col("event_month") <= F.trunc(hi, "month"))
                       & (F.col("Timestamp") < F.date_add(hi, 1).cast("timestamp_ntz")))
    return df


def epoch_millis_as_text(df: DataFrame, col: str = "Timestamp") -> DataFrame:
    """Turn an all-digit ``col`` (epoch milliseconds) into ``yyyy-MM-dd HH:mm:ss``
    text in UTC; other values are left as they are."""
    ts = F.col(col)
    millis = F.when(
        ts.rlike(r"^-?[0-9]+$"),
        F.date_format(
            F.convert_timezone(F.current_timezone(), F.lit("UTC"),
                               F.timestamp_millis(ts.try_cast("bigint")).cast("timestamp_ntz")),
            "yyyy-MM-dd HH:mm:ss",
        ),
    )
    return df.withColumn(col, F.coalesce(millis, ts))


def read_raw_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines violations.

    Values are read as text whatever their JSON type; a ``Timestamp`` given as
    epoch milliseconds is turned into ``yyyy-MM-dd HH:mm:ss`` text (UTC) so that
    the usual time parse applies.
    """
    return epoch_millis_as_text(spark.read.schema(RAW_VIOLATIONS).json(path))


def read_result_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = True,
) -> DataFrame:
    """A result directory written by a sink.

    ``header=False`` applies the schema's names by position. A missing path
    gives an empty table with the same schema.
    """
    try:
        return spark.read.schema(schema).option("header", header).csv(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Fail before running anything if any of ``columns`` is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def has_column(df: DataFrame, column: str) -> bool:
    """Optional-column guard, decided at plan time."""
    return column in df.columns


def read_detections(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Detector output, one row per box (S10, FIXTURES F14)."""
    reader = spark.read.schema(DETECTIONS)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)
