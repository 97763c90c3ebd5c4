"""Derived columns: time parts, coordinates, grid cells, type names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions.cleaning import coordinate, grid_cell, title_case


def time_features(df: DataFrame, ts: str = "Timestamp") -> DataFrame:
    """``hour``, ``day_of_week`` (1 = Sunday) and ``month`` of ``ts``."""
    return df.select(
        "*",
        F.hour(ts).alias("hour"),
        F.dayofweek(ts).alias("day_of_week"),
        F.month(ts).alias("month"),
    )


def with_coordinates(df: DataFrame, location: str = "Location") -> DataFrame:
    """``Latitude``/``Longitude`` from ``"lat,lon"`` text, null when unparsable."""
    return df.select(
        "*",
        coordinate(location, 0).alias("Latitude"),
        coordinate(location, 1).alias("Longitude"),
    )


def valid_coordinates(df: DataFrame) -> DataFrame:
    """Rows where both coordinates parsed."""
    return df.filter(F.col("Latitude").isNotNull() & F.col("Longitude").isNotNull())


def with_grid_cells(df: DataFrame, size: float = 20.0, mode: str = "trunc") -> DataFrame:
    """Add ``lat_cell``/``lon_cell`` for rows with valid coordinates (P10 + F3)."""
    return valid_coordinates(df).select(
        "*",
        grid_cell("Latitude", size, mode).alias("lat_cell"),
        grid_cell("Longitude", size, mode).alias("lon_cell"),
    )


def with_cells_or_null(df: DataFrame, size: float = 20.0, mode: str = "trunc") -> DataFrame:
    """Like :func:`with_grid_cells` but keeps every row; cells are null where a
    coordinate is missing (for reports that also count rows without a place)."""
    return df.select(
        "*",
        grid_cell("Latitude", size, mode).alias("lat_cell"),
        grid_cell("Longitude", size, mode).alias("lon_cell"),
    )


def normalize_type(df: DataFrame, col: str = "Violation_Type") -> DataFrame:
    """Title-case the type name; null stays null."""
    return df.withColumn(col, title_case(col))


def unpivot_hours(wide: DataFrame, id_col: str, value_name: str = "count") -> DataFrame:
    """Wide hour columns -> (id, hour int, value) rows; only all-digit names kept."""
    hour_cols = [c for c in wide.columns if c != id_col and c.isdigit()]
    long = wide.unpivot([id_col], hour_cols, "hour", value_name)
    return long.withColumn("hour", F.col("hour").cast("int"))
