"""Cleaning: trim, fine validation, good/bad split, time parsing.

Everything is one projection plus filters, so Catalyst collapses the chain
into a single scan-project-filter stage; bad rows go to a quarantine frame
with a reason instead of being counted and dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.functions.cleaning import (
    TIMESTAMP_FORMATS,
    coordinate,
    fine_amount,
    parse_ts,
    trimmed,
)


def trim_all(df: DataFrame) -> DataFrame:
    """Trim every text column in one projection."""
    return df.select(
        *[
            trimmed(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def with_fine(df: DataFrame, col: str = "Fine_Amount") -> DataFrame:
    """Replace the fine text by a strictly parsed double."""
    return df.withColumn(col, fine_amount(col))


def with_timestamp(
    df: DataFrame,
    col: str = "Timestamp",
    formats: Sequence[str] | None = TIMESTAMP_FORMATS,
    out: str | None = None,
) -> DataFrame:
    """Parse ``col`` with the first matching format."""
    return df.withColumn(out or col, parse_ts(col, formats))


def good_rows(raw: DataFrame) -> DataFrame:
    """Trimmed rows with a valid fine, fine as double (F1 good side)."""
    df = with_fine(trim_all(raw))
    return df.filter(F.col("Fine_Amount").isNotNull())


def bad_rows(raw: DataFrame) -> DataFrame:
    """Trimmed rows whose fine is missing or invalid, with a ``reason`` (F1 bad side).

    The original fine text is kept so the quarantine can be inspected.
    """
    df = trim_all(raw)
    parsed = fine_amount("Fine_Amount")
    reason = F.when(F.col("Fine_Amount").isNull(), F.lit("missing_fine")).otherwise(
        F.lit("invalid_fine")
    )
    return df.filter(parsed.isNull()).withColumn("reason", reason)


def clean_violations(
    raw: DataFrame, formats: Sequence[str] | None = TIMESTAMP_FORMATS
) -> DataFrame:
    """Good rows with a parsed ``Timestamp``; unparsable times dropped (P1+P2+P5+F1+F2)."""
    df = with_timestamp(good_rows(raw), "Timestamp", formats)
    return df.filter(F.col("Timestamp").isNotNull())


def accepted_rows(raw: DataFrame, formats: Sequence[str] | None = TIMESTAMP_FORMATS) -> DataFrame:
    """The rows of ``clean_violations`` with the time still as text: what ``quarantine`` leaves."""
    return good_rows(raw).filter(parse_ts("Timestamp", formats).isNotNull())


def quarantine(raw: DataFrame, formats: Sequence[str] | None = TIMESTAMP_FORMATS) -> DataFrame:
    """Every row ``clean_violations`` drops, with the first failing check as ``reason``."""
    df = trim_all(raw)
    fine = fine_amount("Fine_Amount")
    ts = parse_ts("Timestamp", formats)
    reason = (
        F.when(F.col("Fine_Amount").isNull(), F.lit("missing_fine"))
        .when(fine.isNull(), F.lit("invalid_fine"))
        .when(ts.isNull(), F.lit("bad_timestamp"))
    )
    return df.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def bad_locations(df: DataFrame, location: str = "Location") -> DataFrame:
    """Rows whose place has no usable coordinates, with a ``reason``: what the grid reports leave out."""
    parts = F.split(F.col(location), ",")
    reason = (
        F.when(F.col(location).isNull(), F.lit("missing_location"))
        .when(F.size(parts) < 2, F.lit("not_a_pair"))
        .when(coordinate(location, 0).isNull(), F.lit("bad_latitude"))
        .when(coordinate(location, 1).isNull(), F.lit("bad_longitude"))
    )
    return df.withColumn("reason", reason).filter(F.col("reason").isNotNull())
