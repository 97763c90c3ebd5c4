"""The tracker over a live detection stream with typed state.

``transformWithStateInPandas`` keeps three states per ``video_id``:

* ``front`` (value): last tracked frame, next free id, whether the video ended;
* ``tracks`` (list): the last tracked frame's tracks;
* ``waiting`` (map, by stretch of ``SPAN`` frame numbers and part): boxes of
  frames not tracked yet.

A trigger's rows are put into ``waiting`` batch by batch, in whatever order they
come: the rows of a stretch in one batch are one part, written once. Then the
stretches are read in order, each once, and tracked frame by frame, so a task
holds one Arrow batch and one stretch, however many rows of a video a trigger
brings, and asks the state by stretch and not by frame.

The newest frame of a video may be incomplete. It waits for a newer one, for the
end of the video (a row whose ``det_id`` is null) or for a processing-time timer
after ``flush_after_ms``. A row of a frame already tracked, or of an ended video,
is late: it comes out with a null ``track_id``. State not written for
``forget_after_ms`` is dropped, so ended videos take no room.

Needs Spark's RocksDB state store: ``settings`` sets it while a query starts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from roadlens.operators.tracking import VideoTracker, _frame_bounds
from roadlens.schemas import DETECTIONS, TRACKED
from roadlens.session import settings

ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
#: With processing-time timers Spark runs batches without data for ever, also after the last available file.
ENDS = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}
ROWS_AT_ONCE = 5000
SPAN = 256

_BOX = ["x1", "y1", "x2", "y2"]
_HELD = [f.name for f in DETECTIONS.fields if f.name != "video_id"]
_FRONT = "last_frame long, next_id long, ended boolean"
_TRACK = "track_id long, x1 long, y1 long, x2 long, y2 long"
_BOXES = "frame_id array<long>, det_id array<int>, class_name array<string>, conf array<double>, x1 array<int>, y1 array<int>, x2 array<int>, y2 array<int>"


class TrackProcessor(StatefulProcessor):
    def __init__(self, frame_skip: int, threshold: float, flush_after_ms: int, forget_after_ms: int) -> None:
        self.frame_skip, self.threshold = frame_skip, threshold
        self.flush_after_ms, self.forget_after_ms = flush_after_ms, forget_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.front = handle.getValueState("front", _FRONT, self.forget_after_ms)
        self.tracks = handle.getListState("tracks", _TRACK, self.forget_after_ms)
        self.waiting = handle.getMapState("waiting", "stretch long, part long", _BOXES, self.forget_after_ms)

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, next_id, ended = self.front.get() if self.front.exists() else (None, 0, False)
        parts = self._parts()
        ends = False
        for pdf in rows:
            mark = pdf["det_id"].isna()
            ends |= bool(mark.any())
            pdf = pdf[~mark].astype({c: "int64" for c in ("frame_id", "det_id", *_BOX)})
            late = np.full(len(pdf), ended) if last is None else (pdf["frame_id"] <= last).to_numpy() | ended
            if late.any():
                yield pdf[late].assign(track_id=pd.array([None] * int(late.sum()), dtype="Int64"))[TRACKED.names]
            self._wait(pdf[~late], parts)
        yield from self._tracked(key[0], parts, last, next_id, ended or ends, hold=not ends)
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if parts and not ends:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.flush_after_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, next_id, ended = self.front.get() if self.front.exists() else (None, 0, False)
        yield from self._tracked(key[0], self._parts(), last, next_id, ended, hold=False)

    def _parts(self) -> dict[int, list[int]]:
        """The waiting parts of each stretch, in the order they came."""
        parts: dict[int, list[int]] = {}
        for stretch, part in sorted(self.waiting.keys()):
            parts.setdefault(stretch, []).append(part)
        return parts

    def _wait(self, boxes: pd.DataFrame, parts: dict[int, list[int]]) -> None:
        """Puts boxes behind those of their stretches that came before them."""
        stretch = boxes["frame_id"].to_numpy(np.int64) // SPAN
        order = np.argsort(stretch, kind="stable")
        columns = [boxes[c].to_numpy()[order] for c in _HELD]
        bounds = np.append(np.flatnonzero(np.diff(stretch[order], prepend=np.nan)), len(order))
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            mine = parts.setdefault(int(stretch[order[s]]), [])
            mine.append(mine[-1] + 1 if mine else 0)
            self.waiting.updateValue((int(stretch[order[s]]), mine[-1]), tuple(c[s:e].tolist() for c in columns))

    def _taken(self, stretch: int, parts: list[int]) -> pd.DataFrame:
        """The boxes of a stretch in frame and box order, no longer waiting."""
        values = [self.waiting.getValue((stretch, part)) for part in parts]
        for part in parts:
            self.waiting.removeKey((stretch, part))
        boxes = pd.DataFrame({name: list(chain.from_iterable(column)) for name, column in zip(_HELD, zip(*values))})
        return boxes.sort_values(["frame_id", "det_id"], kind="stable", ignore_index=True)

    def _tracked(self, video: int, parts: dict[int, list[int]], last: int | None, next_id: int, ended: bool, hold: bool) -> Iterator[pd.DataFrame]:
        """The waiting boxes with their tracks; ``hold``: those of the newest frame go on waiting."""
        tr = VideoTracker(self.frame_skip, self.threshold)
        tr.last_frame, tr.next_id = last, next_id
        kept = np.array([tuple(t) for t in self.tracks.get()] if parts and self.tracks.exists() else [], np.int64).reshape(-1, 5)
        tr.ids, tr.boxes = kept[:, 0], kept[:, 1:]
        out, size, any_tracked = [], 0, False
        stretches = sorted(parts)
        for stretch in stretches:
            boxes = self._taken(stretch, parts[stretch])
            if hold and stretch == stretches[-1]:
                newest = int(boxes["frame_id"].searchsorted(boxes["frame_id"].iloc[-1]))
                self._wait(boxes.iloc[newest:], {})
                boxes = boxes.iloc[:newest]
            if boxes.empty:
                continue
            any_tracked = True
            frames, xy = boxes["frame_id"].to_numpy(np.int64), boxes[_BOX].to_numpy(np.int64)
            bounds = _frame_bounds(np.zeros(len(frames)), frames)
            ids = [tr.update(int(frames[s]), xy[s:e]) for s, e in zip(bounds[:-1], bounds[1:])]
            out.append(boxes.assign(video_id=video, track_id=np.concatenate(ids)))
            size += len(boxes)
            if size >= ROWS_AT_ONCE:
                yield pd.concat(out, ignore_index=True)[TRACKED.names]
                out, size = [], 0
        if out:
            yield pd.concat(out, ignore_index=True)[TRACKED.names]
        if any_tracked and not ended:
            self.tracks.put([tuple(int(v) for v in row) for row in np.column_stack([tr.ids, tr.boxes])])
        if ended and self.tracks.exists():
            self.tracks.clear()
        self.front.update((None if tr.last_frame is None else int(tr.last_frame), int(tr.next_id), ended))


def track_live(
    vehicle_stream: DataFrame,
    frame_skip: int = 2,
    iou_threshold: float = 0.3,
    flush_after_ms: int = 10_000,
    forget_after_ms: int = 24 * 3600 * 1000,
) -> DataFrame:
    """Streaming vehicle boxes (F14 columns; a null ``det_id`` ends its video) -> the same rows with ``track_id``."""
    src = vehicle_stream.select(*[F.col(f.name).cast(f.dataType) for f in TRACKED.fields if f.name != "track_id"])
    return src.groupBy("video_id").transformWithStateInPandas(
        TrackProcessor(int(frame_skip), float(iou_threshold), int(flush_after_ms), int(forget_after_ms)),
        outputStructType=TRACKED,
        outputMode="append",
        timeMode="ProcessingTime",
    )


def run_available(spark: SparkSession, source: str, target: str, checkpoint: str, frame_skip: int = 2, iou_threshold: float = 0.3) -> None:
    """Track what ``source`` (Parquet boxes) holds now into ``target``; the next run with this ``checkpoint`` goes on from there.

    Timers do not fire in such a run: newest frames wait in the state for the next one.
    """
    with settings(spark, ROCKSDB | ENDS):
        boxes = spark.readStream.schema(DETECTIONS).parquet(source)
        writer = track_live(boxes, frame_skip, iou_threshold).writeStream.format("parquet").outputMode("append")
        query = writer.option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
