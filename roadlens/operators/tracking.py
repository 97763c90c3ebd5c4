"""Greedy IoU tracker over vehicle boxes (D6), track history.

Tracking is sequential inside a video and parallel across videos. Rows are
hash-partitioned by ``video_id`` and sorted by ``(video_id, frame_id, det_id)``
inside each partition; ``mapInPandas`` then walks the frames in order and
keeps only the previous frame's tracks in memory (``applyInPandas`` would
materialise a whole video). Batches may cut a frame in two, so the last frame
of each batch is held back until the next batch or the end of the partition.

Tracker rule (the reference's): per processed frame, existing tracks in
ascending id each take the unassigned box with the highest IoU (first box on
ties) if that IoU is > 0 and >= the threshold; unmatched boxes get new ids in
box order; a track not matched in the next processed frame ends. Ids start at
0 per video and are never reused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions.geometry import box, centroid_x, centroid_y
from roadlens.schemas import TRACKED

_BOX = ["x1", "y1", "x2", "y2"]


def iou_matrix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """IoU between every row of ``a`` (T x 4) and ``b`` (B x 4); 0 where the union is 0."""
    a = a.astype(np.int64)[:, None, :]
    b = b.astype(np.int64)[None, :, :]
    w = np.maximum(0, np.minimum(a[..., 2], b[..., 2]) - np.maximum(a[..., 0], b[..., 0]))
    h = np.maximum(0, np.minimum(a[..., 3], b[..., 3]) - np.maximum(a[..., 1], b[..., 1]))
    inter = w * h
    area_a = np.maximum(0, (a[..., 2] - a[..., 0]) * (a[..., 3] - a[..., 1]))
    area_b = np.maximum(0, (b[..., 2] - b[..., 0]) * (b[..., 3] - b[..., 1]))
    denom = area_a + area_b - inter
    with np.errstate(divide="ignore", invalid="ignore"):
        out = np.where(denom == 0, 0.0, inter / np.where(denom == 0, 1, denom))
    return out


class VideoTracker:
    """State of one video: the previous processed frame's tracks."""

    __slots__ = ("frame_skip", "threshold", "last_frame", "ids", "boxes", "next_id", "watch", "conflict")

    def __init__(self, frame_skip: int, threshold: float, watch_inherited: bool = False):
        self.frame_skip = frame_skip
        self.threshold = threshold
        self.last_frame: int | None = None
        self.ids = np.empty(0, dtype=np.int64)
        self.boxes = np.empty((0, 4), dtype=np.int64)
        self.next_id = 0
        # Chunked tracking: tracks with negative ids were inherited from a
        # previous chunk in an assumed order; flag any frame whose result
        # could depend on that order.
        self.watch = watch_inherited
        self.conflict = False

    def update(self, frame_id: int, boxes: np.ndarray) -> np.ndarray:
        """Assign track ids to ``boxes`` (in box order) of processed frame ``frame_id``."""
        if self.last_frame is None or frame_id != self.last_frame + self.frame_skip:
            # Processed frames in between had no vehicle boxes: every track ended.
            self.ids = self.ids[:0]
            self.boxes = self.boxes[:0]
        n = len(boxes)
        assigned = np.zeros(n, dtype=np.int64)
        taken = np.zeros(n, dtype=bool)
        if len(self.ids) and n:
            ious = iou_matrix(self.boxes, boxes)
            if self.watch and not self.conflict:
                self.conflict = self._order_matters(ious)
            for t in range(len(self.ids)):  # ids are kept in ascending order
                row = np.where(taken, -1.0, ious[t])
                best = int(np.argmax(row))
                best_iou = row[best]
                if best_iou > 0 and best_iou >= self.threshold:
                    taken[best] = True
                    assigned[best] = self.ids[t]
        fresh = ~taken
        k = int(fresh.sum())
        assigned[fresh] = np.arange(self.next_id, self.next_id + k, dtype=np.int64)
        self.next_id += k
        order = np.argsort(assigned, kind="stable")
        self.ids = assigned[order]
        self.boxes = boxes[order].astype(np.int64)
        self.last_frame = frame_id
        return assigned

    def _order_matters(self, ious: np.ndarray) -> bool:
        """True when inherited tracks could compete for the same box.

        Inherited tracks are matched before every other track. Those whose best
        IoU reaches the threshold each take their own best box in any order as
        long as those best boxes are distinct; the others take nothing in any
        order. So distinct best boxes make the frame order-independent.
        """
        inherited = self.ids < 0
        if int(inherited.sum()) < 2:
            return False
        sub = ious[inherited]
        best = sub.argmax(axis=1)
        val = sub[np.arange(len(sub)), best]
        active = best[(val > 0) & (val >= self.threshold)]
        return len(np.unique(active)) != len(active)


def _frame_bounds(videos: np.ndarray, frames: np.ndarray) -> np.ndarray:
    """Start offsets of each (video, frame) run in sorted arrays, plus the end."""
    change = np.flatnonzero((videos[1:] != videos[:-1]) | (frames[1:] != frames[:-1])) + 1
    return np.concatenate(([0], change, [len(videos)]))


def _track_batches(batches: Iterator[pd.DataFrame], frame_skip: int, threshold: float):
    current: tuple[int, VideoTracker] | None = None  # rows are sorted by video: earlier ones are done
    pending: pd.DataFrame | None = None

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        nonlocal current
        videos = pdf["video_id"].to_numpy()
        frames = pdf["frame_id"].to_numpy()
        boxes = pdf[_BOX].to_numpy()
        ids = np.empty(len(pdf), dtype=np.int64)
        bounds = _frame_bounds(videos, frames)
        for s, e in zip(bounds[:-1], bounds[1:]):
            v = int(videos[s])
            if current is None or current[0] != v:
                current = (v, VideoTracker(frame_skip, threshold))
            ids[s:e] = current[1].update(int(frames[s]), boxes[s:e])
        return pdf.assign(track_id=ids)

    for pdf in batches:
        if pending is not None:
            pdf = pd.concat([pending, pdf], ignore_index=True)
        if pdf.empty:
            pending = None
            continue
        videos = pdf["video_id"].to_numpy()
        frames = pdf["frame_id"].to_numpy()
        last = (videos == videos[-1]) & (frames == frames[-1])
        cut = int(np.argmax(last))  # rows are sorted, so the last frame is a suffix
        pending = pdf.iloc[cut:]
        if cut:
            yield run(pdf.iloc[:cut].reset_index(drop=True))
    if pending is not None and len(pending):
        yield run(pending.reset_index(drop=True))


def track_ids(vehicle_boxes: DataFrame, frame_skip: int = 2, iou_threshold: float = 0.3,
              num_partitions: int | None = None) -> DataFrame:
    """Vehicle boxes of processed frames -> the same rows with ``track_id``.

    Input columns: the detection schema (F14), already sampled, filtered by
    confidence and restricted to vehicle classes.
    """
    cols = [f.name for f in TRACKED.fields if f.name != "track_id"]
    src = vehicle_boxes.select(*[F.col(c).cast(TRACKED[c].dataType) for c in cols])
    parts = [num_partitions] if num_partitions else []
    ordered = src.repartition(*parts, "video_id").sortWithinPartitions("video_id", "frame_id", "det_id")
    fs, thr = int(frame_skip), float(iou_threshold)
    return ordered.mapInPandas(lambda it: _track_batches(it, fs, thr), TRACKED)


def track_history(tracks: DataFrame, frame_skip: int = 2) -> DataFrame:
    """Per track row: position in the track's history and its centroid.

    ``tracks`` are rows of ``chunked_tracking.tracked_rows``. A track has no
    gaps, so the history length at a frame is ``(frame_id - first_frame) / skip
    + 1``: a per-row expression, no group.
    """
    return tracks.select(
        "video_id",
        "track_id",
        "frame_id",
        ((F.col("frame_id") - F.col("first_frame")) / F.lit(frame_skip) + 1).cast("bigint").alias("history_len"),
        centroid_x(box()).alias("cx"),
        centroid_y(box()).alias("cy"),
    )


def track_paths(tracks: DataFrame) -> DataFrame:
    """One row per ended track: its frames and its whole history of centroids.

    ``tracks`` are rows of ``chunked_tracking.tracked_rows``. The points of a
    track are gathered per chunk first, so a long track is put together from
    pieces of at most a chunk's frames, and rows meet their track in parallel.
    """
    point = F.struct("frame_id", centroid_x(box()).alias("cx"), centroid_y(box()).alias("cy"))
    pieces = tracks.groupBy("video_id", "track_id", "chunk").agg(F.array_sort(F.collect_list(point)).alias("piece"))
    whole = pieces.groupBy("video_id", "track_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "piece"))).alias("pieces"))
    path = whole.select("video_id", "track_id", F.flatten("pieces.piece").alias("path"))
    return path.select(
        "video_id",
        "track_id",
        F.element_at("path", 1)["frame_id"].alias("first_frame"),
        F.element_at("path", -1)["frame_id"].alias("last_frame"),
        F.size("path").cast("bigint").alias("points"),
        F.col("path.cx").alias("path_x"),
        F.col("path.cy").alias("path_y"),
    )
