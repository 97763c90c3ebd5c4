"""Detection rules: helmet sources, frame-local joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadlens.operators import detections as dt
from roadlens.sources.adapters import raw_detections


def test_separate_helmet_source_equals_helmet_class(spark, sf_dir):
    params = dt.DetectionParams()
    det = raw_detections(spark, sf_dir).cache()
    boxes = dt.processed(det, params)
    tracks = dt.vehicles(boxes).withColumn("track_id", F.col("det_id").cast("bigint"))
    same_table = dt.evaluate(tracks, boxes, params, with_helmets=True)
    separate = dt.evaluate(
        tracks, boxes.filter(F.col("class_name") != "helmet"), params, with_helmets=False,
        helmets=det.filter(F.col("class_name") == "helmet"),
    )
    cols = ["video_id", "frame_id", "track_id", "violations", "helmet_present"]
    assert sorted(same_table.select(cols).collect()) == sorted(separate.select(cols).collect())
    no_source = dt.evaluate(tracks, boxes.filter(F.col("class_name") != "helmet"), params, with_helmets=False)
    assert no_source.filter(F.col("no_helmet").isNotNull()).count() == 0
