"""Adapters from the driver's ``events`` table to the two domain tables.

The driver data has no violation records and no detector output, so both
domain inputs are derived from ``events`` (see FIXTURES.md §C/§D). The same
definitions exist as DuckDB text in ``roadlens.plans.oracle`` so the two
engines start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _decimal_text(int_part, frac_part):
    """``int_part || '.' || lpad(frac_part, 4, '0')`` as text."""
    return F.concat(
        int_part.cast("string"), F.lit("."), F.lpad(frac_part.cast("string"), 4, "0")
    )


def violations_from_events(events: DataFrame) -> DataFrame:
    """Raw violations (F1, all strings) with every dirt case of FIXTURES §B.

    Modular products are reduced before multiplying so that large user ids
    cannot overflow a bigint (values are identical to the fixture text).
    """
    eid = F.col("event_id")
    uid = F.col("user_id")
    ts = F.col("ts")
    u179 = uid % 179
    lat = _decimal_text((u179 * u179 * 7) % 179 - 89, ((uid % 10000) * 7919) % 10000)
    lon = _decimal_text(((uid % 359) * 53) % 359 - 179, ((uid % 10000) * 104729) % 10000)
    etype = F.col("event_type")
    return events.select(
        F.concat(F.lit("V"), eid.cast("string")).alias("Violation_ID"),
        F.when(eid % 25 == 0, F.lit("32/13/2025"))
        .when(eid % 25 == 1, F.date_format(ts, "dd/MM/yyyy HH:mm:ss"))
        .when(eid % 25 == 2, F.date_format(ts, "MM/dd/yyyy HH:mm:ss"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .alias("Timestamp"),
        F.when(eid % 50 == 3, F.lit("unknown"))
        .when(eid % 50 == 13, F.lit("1e300,2"))
        .when(eid % 50 == 23, F.lit("NaN,5"))
        .when(eid % 50 == 33, F.lit("7,Infinity"))
        .otherwise(F.concat(lat, F.lit(","), lon))
        .alias("Location"),
        F.when(eid % 20 == 5, F.lit(None).cast("string"))
        .when(etype == "click", F.lit(" Speeding"))
        .when(etype == "error", F.lit("Red Light "))
        .when(etype == "purchase", F.lit("No Helmet"))
        .when(etype == "signup", F.lit("Parking"))
        .otherwise(F.lit("Seat Belt"))
        .alias("Violation_Type"),
        F.when(uid % 5 == 0, "Car")
        .when(uid % 5 == 1, "Bike")
        .when(uid % 5 == 2, "Truck")
        .when(uid % 5 == 3, "Bus")
        .otherwise("Auto")
        .alias("Vehicle_Type"),
        F.when(F.col("value") < 10, "Low")
        .when(F.col("value") < 40, "Medium")
        .otherwise("High")
        .alias("Severity"),
        F.when(eid % 3 == 0, F.lit("abc"))
        .when(eid % 3 == 1, F.lit(None).cast("string"))
        .otherwise((F.lit(100) + (eid * 13) % 1901).cast("string"))
        .alias("Fine_Amount"),
    )


def raw_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violations_from_events(read_events(spark, sf_dir))


# Frames of a video, boxes of a frame; one box in MISSED is not detected.
FRAMES, SLOTS, MISSED = 300, 7, 20
# Every third stretch of FRAMES frames goes on a long video of up to LONG_STRETCHES of them.
LONG_VIDEO, LONG_STRETCHES = 1_000_000_000, 4096


def detections_from_events(events: DataFrame) -> DataFrame:
    """Raw detections (F14): seven box slots per frame, 300 frames per video.

    Video, frame and slot are arithmetic on ``event_id``, so every row is made
    on its own, filters run in the scan, and more events give more videos. A
    car and a truck queue in overlapping boxes, and one box in twenty is missed.
    A third of the rows make long videos, in which a car, a motorcycle and a
    truck crowd each other from the first frame to the last.
    """
    eid = F.col("event_id")
    part = F.floor(eid / (FRAMES * SLOTS))
    crowd = part % 3 == 1
    stretch = F.floor(part / 3)
    f = events.where((eid % 1000) * 7919 % MISSED != 0).select(
        F.when(crowd, LONG_VIDEO + F.floor(stretch / LONG_STRETCHES)).otherwise(part).alias("video_id"),
        eid,
        (F.floor(eid / SLOTS) % FRAMES + F.when(crowd, stretch % LONG_STRETCHES * FRAMES).otherwise(0)).alias("frame_id"),
        (eid % SLOTS).alias("slot"),
        crowd.alias("crowd"),
    )
    person_like = F.col("slot").isin(2, 3, 4, 5)
    x = (
        F.when(person_like, 400 + F.col("frame_id") * 6 + (eid % 4) * 30)
        .when(F.col("crowd") & (F.col("slot") == 0), 900 + F.col("frame_id") * 6 + F.col("frame_id") * 5 % 37)
        .when(F.col("crowd") & (F.col("slot") == 1), 910 + F.col("frame_id") * 6 + F.col("frame_id") * 7 % 41)
        .when(F.col("slot") == 0, 870 + F.col("frame_id") * 14)
        .when(F.col("slot") == 1, 400 + F.col("frame_id") * 6)
        .otherwise(900 + F.col("frame_id") * 6)
    )
    y = (
        F.when(person_like, 90)
        .when(F.col("slot") == 6, 160)
        .when(F.col("slot") == 0, 165)
        .when(F.col("crowd"), 150)
        .otherwise(100)
    )
    w = (
        F.when(F.col("slot").isin(2, 3, 4), 30)
        .when(F.col("slot") == 5, 12)
        .when(F.col("slot") == 6, 140)
        .otherwise(80)
    )
    h = F.when(F.col("slot") == 5, 12).otherwise(60)
    b = f.select("video_id", "event_id", "frame_id", "slot", x.alias("x"), y.alias("y"),
                 w.alias("w"), h.alias("h"))
    return b.select(
        F.col("video_id").cast("bigint").alias("video_id"),
        F.col("frame_id"),
        F.col("slot").cast("int").alias("det_id"),
        F.when(F.col("slot") == 0, "car")
        .when(F.col("slot") == 1, "motorcycle")
        .when(F.col("slot") == 5, "helmet")
        .when(F.col("slot") == 6, "truck")
        .otherwise("person")
        .alias("class_name"),
        ((F.lit(30) + eid % 70).cast("double") / 100).alias("conf"),
        F.col("x").cast("int").alias("x1"),
        F.col("y").cast("int").alias("y1"),
        (F.col("x") + F.col("w")).cast("int").alias("x2"),
        (F.col("y") + F.col("h")).cast("int").alias("y2"),
    )


def raw_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections_from_events(read_events(spark, sf_dir))
