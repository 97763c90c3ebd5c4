"""The tracker over a live detection stream.

State per ``video_id`` is what the batch tracker carries between frames:
the last processed frame, the next free id, and the last frame's track ids
and boxes. Each micro-batch's rows for a video are sorted by frame inside the
handler, so a trigger may hold several frames in any order. A frame at or
before the last processed frame is late: the ids after it were already
emitted, so its rows are passed through with a null ``track_id`` rather than
dropped.

The newest frame of each video waits in state (it may still be incomplete)
until a newer frame arrives or the video has been quiet for ``flush_after_ms``;
a processing-time timeout then tracks and emits it. ``hold_back=False`` is for
sources whose frames arrive whole within one micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from roadlens.operators.tracking import VideoTracker, _frame_bounds
from roadlens.schemas import DETECTIONS, TRACKED

STATE = T.StructType(
    [
        T.StructField("last_frame", T.LongType()),
        T.StructField("next_id", T.LongType()),
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("boxes", T.ArrayType(T.LongType())),
        # held-back newest frame (hold_back mode)
        T.StructField("held", T.ArrayType(DETECTIONS)),
    ]
)

_BOX = ["x1", "y1", "x2", "y2"]


_HELD = DETECTIONS.names


def _restore(tr: VideoTracker, state: GroupState) -> pd.DataFrame | None:
    """Load the tracker from state; return the held-back rows, if any."""
    if not state.exists:
        return None
    last_frame, next_id, ids, boxes, held = state.get
    tr.last_frame = None if last_frame is None else int(last_frame)
    tr.next_id = int(next_id)
    tr.ids = np.asarray(ids or [], dtype=np.int64)
    tr.boxes = np.asarray(boxes or [], dtype=np.int64).reshape(-1, 4)
    if not held:
        return None
    return pd.DataFrame([tuple(r) for r in held], columns=_HELD)


def _pack(rows: pd.DataFrame | None):
    if rows is None or rows.empty:
        return None
    return [
        tuple(v.item() if hasattr(v, "item") else v for v in r)
        for r in rows[_HELD].itertuples(index=False, name=None)
    ]


def _handler(frame_skip: int, threshold: float, hold_back: bool, flush_ms: int):
    def handle(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tr = VideoTracker(frame_skip, threshold)
        held = _restore(tr, state)
        if state.hasTimedOut:
            pdf = held if held is not None else pd.DataFrame(columns=_HELD)
            held_next = None
        else:
            parts = [p for p in pdfs if len(p)]
            if held is not None:
                parts.append(held)
            pdf = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=_HELD)
            if tr.last_frame is not None:
                late = pdf[pdf["frame_id"] <= tr.last_frame]
                if len(late):
                    # ids after these frames were already emitted: keep the rows, unassigned
                    yield late.assign(track_id=pd.array([None] * len(late), dtype="Int64"))[TRACKED.names]
                pdf = pdf[pdf["frame_id"] > tr.last_frame]
            held_next = None
            if hold_back and len(pdf):
                newest = pdf["frame_id"].max()
                held_next = pdf[pdf["frame_id"] == newest]
                pdf = pdf[pdf["frame_id"] != newest]
        pdf = pdf.sort_values(["frame_id", "det_id"], kind="stable").reset_index(drop=True)
        out = None
        if len(pdf):
            frames = pdf["frame_id"].to_numpy(dtype=np.int64)
            boxes = pdf[_BOX].to_numpy(dtype=np.int64)
            ids = np.empty(len(pdf), dtype=np.int64)
            bounds = _frame_bounds(np.zeros(len(pdf)), frames)
            for s, e in zip(bounds[:-1], bounds[1:]):
                ids[s:e] = tr.update(int(frames[s]), boxes[s:e])
            out = pdf.assign(track_id=ids)
        if tr.last_frame is not None or held_next is not None:
            state.update((
                None if tr.last_frame is None else int(tr.last_frame),
                int(tr.next_id),
                tr.ids.tolist(),
                tr.boxes.reshape(-1).tolist(),
                _pack(held_next),
            ))
            if hold_back and held_next is not None:
                state.setTimeoutDuration(flush_ms)
        if out is not None:
            yield out[TRACKED.names]

    return handle


def track_stream(
    vehicle_stream: DataFrame,
    frame_skip: int = 2,
    iou_threshold: float = 0.3,
    hold_back: bool = True,
    flush_after_ms: int = 10_000,
) -> DataFrame:
    """Streaming vehicle boxes (F14 columns) -> the same rows with ``track_id``."""
    cols = [f.name for f in TRACKED.fields if f.name != "track_id"]
    src = vehicle_stream.select(*[vehicle_stream[c].cast(TRACKED[c].dataType) for c in cols])
    timeout = GroupStateTimeout.ProcessingTimeTimeout if hold_back else GroupStateTimeout.NoTimeout
    return src.groupBy("video_id").applyInPandasWithState(
        _handler(int(frame_skip), float(iou_threshold), hold_back, int(flush_after_ms)),
        outputStructType=TRACKED,
        stateStructType=STATE,
        outputMode="append",
        timeoutConf=timeout,
    )
