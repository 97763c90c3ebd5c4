"""Batch = stream for T1 (tracker state) and T2 (stateless cleaning)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from roadlens.operators import clean as cl
from roadlens.operators import detections as dt
from roadlens.operators.tracking import track_ids
from roadlens.schemas import DETECTIONS, TRACKED
from roadlens.session import scratch_path
from roadlens.sinks.writers import write_csv
from roadlens.sources.adapters import raw_detections, raw_violations
from roadlens.streaming.clean_stream import start_clean_stream
from roadlens.streaming.track_stream import track_stream


def test_clean_stream_equals_batch(spark, sf_dir):
    raw = raw_violations(spark, sf_dir)
    src = scratch_path(spark, "stream-src")
    # several files so the stream runs several micro-batches
    for i in range(3):
        write_csv(raw.filter(F.abs(F.hash("Violation_ID")) % 3 == i), f"{src}/part{i}")
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    check = scratch_path(spark, "stream-check")
    start_clean_stream(spark, f"{src}/*", good, bad, check, max_files_per_trigger=1).awaitTermination(120)
    # a restart reads nothing twice, and takes what has come since
    write_csv(raw.filter("Violation_ID = 'V1'").selectExpr("'VX' AS Violation_ID", "* EXCEPT (Violation_ID)"), f"{src}/part3")
    start_clean_stream(spark, f"{src}/*", good, bad, check, max_files_per_trigger=1).awaitTermination(120)
    late = raw.filter("Violation_ID = 'V1'").selectExpr("'VX' AS Violation_ID", "* EXCEPT (Violation_ID)")
    raw = raw.unionByName(late)
    got_good = spark.read.parquet(good).drop("batch")
    got_bad = spark.read.parquet(bad).drop("batch")
    assert sorted(got_good.collect()) == sorted(cl.clean_violations(raw).collect())
    assert sorted(got_bad.collect()) == sorted(cl.quarantine(raw).collect())


def test_track_stream_equals_batch(spark, sf_dir):
    vehs = dt.vehicles(dt.processed(raw_detections(spark, sf_dir), dt.DetectionParams()))
    vehs = vehs.select(*[c.name for c in DETECTIONS.fields]).cache()
    src = scratch_path(spark, "det-stream")
    # whole frames per file, frames of one video spread over files and out of order
    for i in range(4):
        vehs.filter((F.col("frame_id") / 2) % 4 == (3 - i)).write.parquet(f"{src}/f{i}")
    stream = spark.readStream.schema(DETECTIONS).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    name = f"tracks_{uuid.uuid4().hex[:8]}"
    q = (
        track_stream(stream, 2, 0.3, hold_back=False)
        .writeStream.format("memory")
        .queryName(name)
        .outputMode("append")
        .option("checkpointLocation", scratch_path(spark, "det-ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(180)
    got = spark.table(name)
    # frames arrive out of order: late frames come back with a null track_id
    # (no row is lost); the rest equals the batch tracker on exactly those frames
    assert got.count() == vehs.count()
    tracked = got.filter(F.col("track_id").isNotNull())
    kept = tracked.select("video_id", "frame_id").distinct()
    batch = track_ids(vehs.join(kept, ["video_id", "frame_id"], "left_semi"), 2, 0.3)
    assert tracked.count() > 0 and got.filter(F.col("track_id").isNull()).count() > 0
    assert sorted(tracked.collect()) == sorted(batch.collect())


def test_track_stream_in_order_equals_batch(spark, sf_dir):
    vehs = dt.vehicles(dt.processed(raw_detections(spark, sf_dir), dt.DetectionParams()))
    vehs = vehs.select(*[c.name for c in DETECTIONS.fields]).cache()
    src = scratch_path(spark, "det-stream-ordered")
    for i in range(4):
        vehs.filter(F.floor(F.col("frame_id") / 40) == i).write.parquet(f"{src}/f{i}")
    stream = spark.readStream.schema(DETECTIONS).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    name = f"tracks_{uuid.uuid4().hex[:8]}"
    q = (
        track_stream(stream, 2, 0.3, hold_back=False)
        .writeStream.format("memory")
        .queryName(name)
        .option("checkpointLocation", scratch_path(spark, "det-ckpt2"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(180)
    rest = vehs.filter(F.col("frame_id") >= 160)
    got = spark.table(name)
    batch = track_ids(vehs.subtract(rest), 2, 0.3)
    assert sorted(got.collect()) == sorted(batch.collect())




def test_track_stream_hold_back_handles_split_frames(spark, sf_dir):
    import time

    vehs = dt.vehicles(dt.processed(raw_detections(spark, sf_dir), dt.DetectionParams()))
    vehs = vehs.select(*[c.name for c in DETECTIONS.fields]).cache()
    src = scratch_path(spark, "det-stream-split")
    # cut the (frame, video, box)-ordered rows every 7 rows, so frames are split
    # across consecutive files (and micro-batches) at arbitrary points
    rows = vehs.orderBy("frame_id", "video_id", "det_id").collect()
    for i in range(0, len(rows), 7):
        spark.createDataFrame(rows[i:i + 7], DETECTIONS).coalesce(1).write.parquet(f"{src}/f{i:06d}")
    stream = spark.readStream.schema(DETECTIONS).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    name = f"tracks_{uuid.uuid4().hex[:8]}"
    q = (
        track_stream(stream, 2, 0.3, flush_after_ms=500)
        .writeStream.format("memory")
        .queryName(name)
        .option("checkpointLocation", scratch_path(spark, "det-ckpt3"))
        .trigger(processingTime="100 milliseconds")
        .start()
    )
    try:
        deadline = time.time() + 240
        while spark.table(name).count() < len(rows) and time.time() < deadline:
            time.sleep(1)
    finally:
        q.stop()
    got = spark.table(name)
    assert sorted(got.collect()) == sorted(track_ids(vehs, 2, 0.3).collect())


def test_clean_stream_json_epoch_millis(spark, tmp_path):
    import json

    src = tmp_path / "json_in"
    src.mkdir()
    recs = [
        {"Violation_ID": "x", "Timestamp": 1704164645000, "Location": "1,2", "Violation_Type": "Parking",
         "Vehicle_Type": "Car", "Severity": "Low", "Fine_Amount": 100},
        {"Violation_ID": "y", "Timestamp": "32/13/2025", "Location": "1,2", "Violation_Type": None,
         "Vehicle_Type": "Car", "Severity": "Low", "Fine_Amount": 200},
    ]
    (src / "a.json").write_text("\n".join(json.dumps(r) for r in recs))
    good, bad = scratch_path(spark, "jgood"), scratch_path(spark, "jbad")
    q = start_clean_stream(spark, str(src), good, bad, scratch_path(spark, "check-json"), fmt="json")
    q.awaitTermination(120)
    rows = spark.read.parquet(good).collect()
    assert [(r["Violation_ID"], str(r["Timestamp"])) for r in rows] == [("x", "2024-01-02 03:04:05")]
    assert [r["reason"] for r in spark.read.parquet(bad).collect()] == ["bad_timestamp"]


def _boxes(spark, rows):
    """(video, frame, det, x) -> detection rows of 10 x 10 boxes; det None ends the video."""
    full = [(v, f, d, "car", 0.9, x, 0, None if x is None else x + 10, 10) for v, f, d, x in rows]
    return spark.createDataFrame(full, DETECTIONS)


def test_live_tracks_late_rows_split_frames_and_ends(spark):
    from roadlens.streaming.live_tracks import run_available

    source, target, check = (scratch_path(spark, f"live-{x}") for x in ("in", "out", "check"))

    def feed(rows):
        _boxes(spark, rows).write.mode("append").parquet(source)
        run_available(spark, source, target, check)
        return sorted((r.video_id, r.frame_id, r.det_id, r.track_id) for r in spark.read.schema(TRACKED).parquet(target).collect())

    # frames out of order in one trigger; frame 4 is the newest and waits, half of it is still to come
    out = feed([(1, 4, 0, 4), (1, 0, 0, 0), (1, 2, 0, 2), (2, 0, 0, 0)])
    assert out == [(1, 0, 0, 0), (1, 2, 0, 0)]
    # the other half, a newer frame, and a late row of frame 2
    out = feed([(1, 4, 1, 500), (1, 6, 0, 505), (1, 2, 1, 90)])
    assert out == [(1, 0, 0, 0), (1, 2, 0, 0), (1, 2, 1, None), (1, 4, 0, 0), (1, 4, 1, 1)]
    # ends of both videos: what waits comes out; a frame after the end is late
    out = feed([(1, None, None, None), (2, None, None, None)])
    assert (1, 6, 0, 1) in out and (2, 0, 0, 0) in out and len(out) == 7
    out = feed([(1, 8, 0, 505), (3, 0, 0, 0), (3, None, None, None)])
    assert (1, 8, 0, None) in out and (3, 0, 0, 0) in out and len(out) == 9


def test_live_tracks_timer_flushes_the_newest_frame(spark):
    import time

    from roadlens.streaming.live_tracks import ROCKSDB, settings, track_live

    source = scratch_path(spark, "live-timer")
    _boxes(spark, [(1, 0, 0, 0), (1, 2, 0, 2)]).write.parquet(source)
    name = f"live_{uuid.uuid4().hex[:8]}"
    with settings(spark, ROCKSDB):
        live = track_live(spark.readStream.schema(DETECTIONS).parquet(source), flush_after_ms=300)
        writer = live.writeStream.format("memory").queryName(name).outputMode("append")
        query = writer.option("checkpointLocation", scratch_path(spark, "live-timer-check")).trigger(processingTime="500 milliseconds").start()
    try:
        until = time.time() + 90
        while spark.table(name).count() < 2 and time.time() < until:
            time.sleep(0.5)
    finally:
        query.stop()
    assert sorted((r.frame_id, r.track_id) for r in spark.table(name).collect()) == [(0, 0), (2, 0)]


def test_live_tracks_ask_the_state_by_stretch_not_by_frame():
    """A video of 4,000 frames in shuffled batches: tracks of the batch tracker, few calls to the state, the newest frame waits."""
    import numpy as np
    import pandas as pd

    from roadlens.operators.tracking import VideoTracker
    from roadlens.streaming.live_tracks import SPAN, TrackProcessor

    class Value:
        def __init__(self):
            self.held = None

        exists = lambda self: self.held is not None
        get = lambda self: self.held

        def update(self, v):
            self.held = v

        put = update

        def clear(self):
            self.held = None

    class Map:
        def __init__(self):
            self.held, self.calls = {}, 0

        def _did(self, out=None):
            self.calls += 1
            return out

        keys = lambda self: self._did(iter(list(self.held)))
        containsKey = lambda self, k: self._did(k in self.held)
        getValue = lambda self, k: self._did(self.held[k])
        updateValue = lambda self, k, v: self._did(self.held.__setitem__(k, v))
        removeKey = lambda self, k: self._did(self.held.pop(k))

    class Handle:
        listTimers = lambda self: []
        registerTimer = deleteTimer = lambda self, t: None

    class Clock:
        getCurrentProcessingTimeInMs = lambda self: 0

    tp = TrackProcessor(2, 0.3, 1000, 1000)
    tp.handle, tp.front, tp.tracks, tp.waiting = Handle(), Value(), Value(), Map()
    n = 4000
    frame = np.repeat(np.arange(n) * 2, 2)
    det = np.tile([0, 1], n)
    x = frame * 3 + det * 4
    rows = pd.DataFrame({"video_id": 7, "frame_id": frame, "det_id": det, "class_name": "car", "conf": 0.5, "x1": x, "y1": 0, "x2": x + 10, "y2": 10})
    near = np.random.default_rng(3).permutation(len(rows) // 500)  # batches of 500 rows in any order
    batches = [rows.iloc[k * 500 : (k + 1) * 500].sample(frac=1, random_state=int(k)) for k in near]
    got = pd.concat(tp.handleInputRows((7,), iter(batches), Clock())).sort_values(["frame_id", "det_id"])
    assert len(got) == len(rows) - 2 and tp.waiting.calls < n / 10
    [((stretch, _), held)] = tp.waiting.held.items()
    assert stretch == 2 * (n - 1) // SPAN and held[0] == [2 * (n - 1)] * 2
    end = rows.iloc[:1].assign(det_id=None)
    got = pd.concat([got, *tp.handleInputRows((7,), iter([end]), Clock())]).sort_values(["frame_id", "det_id"])
    tr = VideoTracker(2, 0.3)
    boxes = rows[["x1", "y1", "x2", "y2"]].to_numpy()
    want = np.concatenate([tr.update(int(f), boxes[2 * k : 2 * k + 2]) for k, f in enumerate(frame[::2])])
    assert got["track_id"].tolist() == want.tolist() and not tp.waiting.held and not tp.tracks.exists()
