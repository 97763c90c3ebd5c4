"""Explicit schemas for every table the library reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

# F1 / F2: raw violation records, every column text.
VIOLATION_COLUMNS = [
    "Violation_ID",
    "Timestamp",
    "Location",
    "Violation_Type",
    "Vehicle_Type",
    "Severity",
    "Fine_Amount",
]

RAW_VIOLATIONS = T.StructType([T.StructField(c, T.StringType(), True) for c in VIOLATION_COLUMNS])

# cleaned violations (fine parsed, time still text).
CLEAN_VIOLATIONS = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in VIOLATION_COLUMNS[:-1]]
    + [T.StructField("Fine_Amount", T.DoubleType(), True)]
)

# totals by location.
LOCATION_TOTALS = T.StructType(
    [
        T.StructField("Location", T.StringType(), True),
        T.StructField("Total_Violations", T.LongType(), True),
    ]
)

# Hotspots and the combined hotspot table.
HOTSPOTS = T.StructType(
    [
        T.StructField("lat_cell", T.DoubleType(), True),
        T.StructField("lon_cell", T.DoubleType(), True),
        T.StructField("violation_count", T.LongType(), True),
        T.StructField("z_score", T.DoubleType(), True),
    ]
)

# raw detections, one row per box (replaces the model call).
DETECTIONS = T.StructType(
    [
        T.StructField("video_id", T.LongType(), True),
        T.StructField("frame_id", T.LongType(), True),
        T.StructField("det_id", T.IntegerType(), True),
        T.StructField("class_name", T.StringType(), True),
        T.StructField("conf", T.DoubleType(), True),
        T.StructField("x1", T.IntegerType(), True),
        T.StructField("y1", T.IntegerType(), True),
        T.StructField("x2", T.IntegerType(), True),
        T.StructField("y2", T.IntegerType(), True),
    ]
)

TRACKED = T.StructType(DETECTIONS.fields + [T.StructField("track_id", T.LongType(), True)])
