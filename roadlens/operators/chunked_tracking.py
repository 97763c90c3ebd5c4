"""Exact tracker over frame ranges, so one long video does not sit in one task.

The tracker is sequential, but a frame range (a *chunk*) needs little from the
past: the boxes of the processed frame before it (its seeds) and the order of
their tracks. Four steps, none of them a loop over open cases:

1. **Chunks** (parallel over ``(video, chunk)``): every chunk is tracked from
   its seeds. What does not depend on the seeds' order is final; for the rest
   the chunk tells how its last frame follows from that order
   (``order_transfer``). A track is named by its birth key ``(frame, det_id)``,
   which is also its place in the order.
2. **Composition**: the functions of ``FAN`` neighbouring chunks become one,
   level by level, until a video has at most ``FAN``; a chunk after a frame
   without vehicles takes nothing from before it. The levels are then walked
   back, each group from the birth keys it starts with, down to the chunks.
3. **Open rows**: rows of chunks whose seeds really compete are tracked once
   more, now with the true order.
4. **Ids**: birth keys are numbered per video by prefix sums of births per
   chunk, and every row finds its track's number in its chunk's table.

A group that reaches Python is one chunk (``chunk_frames``) or the functions of
``FAN`` ranges. The ids are those of the sequential tracker.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.operators.order_transfer import TooLarge, component_maze, compose, evaluate, preferences
from roadlens.operators.tracking import VideoTracker, _frame_bounds, iou_matrix
from roadlens.schemas import TRACKED
from roadlens.session import cut_lineage

FAN = 64
_BOX = ["x1", "y1", "x2", "y2"]
_COLS = [f.name for f in TRACKED.fields if f.name != "track_id"]
_CHUNK = ["video_id", "chunk"]
_LABEL = ["seed", "born_frame", "born_det"]

#: A row's track: seed number of its chunk (-1: born in it) and, for those, its birth key.
_LABEL_FIELDS = [T.StructField("seed", T.IntegerType()), T.StructField("born_frame", T.LongType()), T.StructField("born_det", T.IntegerType())]
CHUNKED = T.StructType(
    [*[TRACKED[c] for c in _COLS], T.StructField("chunk", T.LongType()), *_LABEL_FIELDS, T.StructField("open", T.BooleanType()), T.StructField("seeds", T.IntegerType()), T.StructField("pieces", T.StringType())]
)
#: ``seeds``: those of the first chunk; ``pieces`` may have no use for them.
RANGE = "video_id long, node long, seeds int, pieces string"
STARTS = "video_id long, node long, seed int, first_frame long, first_det int"


class _Rows:
    """The rows of one chunk, in frame and box order."""

    def __init__(self, rows: pd.DataFrame, skip: int, threshold: float) -> None:
        self.frames = rows["frame_id"].to_numpy(np.int64)
        self.dets = rows["det_id"].to_numpy(np.int64)
        self.boxes = rows[_BOX].to_numpy(np.int64)
        self.bounds = _frame_bounds(np.zeros(len(rows)), self.frames)
        self.skip, self.threshold = skip, threshold

    def frame(self, f: int) -> slice:
        return slice(self.bounds[f], self.bounds[f + 1])

    def key(self, row: int) -> list[int]:
        return [int(self.frames[row]), int(self.dets[row])]

    def tracked(self, seeds: np.ndarray, before: int | None, start: int, stop: int, order: np.ndarray | None = None) -> tuple[np.ndarray, bool]:
        """(track of every row of the frames, whether the order of the seeds could matter).

        A track is a seed (-1 - seed) or the row it was born in. ``order`` lists
        the seeds oldest first; without it their numbers are taken and watched.
        """
        tr = VideoTracker(self.skip, self.threshold, watch_inherited=order is None)
        n = len(seeds)
        order = np.arange(n) if order is None else order
        if n:
            tr.ids, tr.boxes, tr.last_frame = np.arange(n) - n, seeds[order], before
        lo, hi = self.bounds[start], self.bounds[stop]
        found = np.concatenate([tr.update(int(self.frames[self.bounds[f]]), self.boxes[self.frame(f)]) for f in range(start, stop)])
        out = np.empty(hi - lo, np.int64)
        old = found < 0
        out[old] = -1 - order[found[old] + n]
        _, first, which = np.unique(found[~old], return_index=True, return_inverse=True)
        out[~old] = np.flatnonzero(~old)[first][which] + lo
        return out, tr.conflict

    def piece(self, seeds: np.ndarray, before: int | None, start: int, stop: int, told: bool) -> tuple[dict, np.ndarray, np.ndarray]:
        """(piece, tracks, open rows) of frames ``start`` to ``stop``; ``told``: whether the last of them ends the range."""
        tracks, conflict = self.tracked(seeds, before, start, stop)
        lo = self.bounds[start]
        is_open = np.zeros(len(tracks), bool)
        at = self.frame(stop - 1)
        last = [int(-1 - t) if t < 0 else self.key(t) for t in tracks[at.start - lo :]] if told else []
        mazes = []
        if conflict:
            for seed_set, members, steps in self._components(seeds, before, start, stop):
                ends_here = told and len(steps) == stop - start and len(members[-1]) > 0
                places = [int(r - at.start) for r in members[-1]] if ends_here else None
                matters, maze = component_maze(seed_set, steps, places)
                if matters:
                    is_open[np.concatenate(members) - lo] = True
                if maze is not None:
                    mazes.append(maze)
                    for place in places:
                        last[place] = None
        return {"n": len(seeds), "last": last, "mazes": mazes}, tracks, is_open

    def _components(self, seeds: np.ndarray, before: int, start: int, stop: int):
        """Sets of two or more seeds with all boxes that hang together with them by overlaps from frame to frame."""
        joined_to: list[int] = list(range(len(seeds)))  # a set of boxes points to the set it was joined to

        def home(g: int) -> int:
            while joined_to[g] != g:
                joined_to[g] = g = joined_to[joined_to[g]]
            return g

        choices, layers, boxes, frame = [], [list(joined_to)], seeds, before
        for f in range(start, stop):
            now = self.boxes[self.frame(f)]
            if int(self.frames[self.bounds[f]]) != frame + self.skip:
                break
            prefs = preferences(iou_matrix(boxes, now), self.threshold)
            mine = list(range(len(joined_to), len(joined_to) + len(now)))
            joined_to += mine
            for i, able in enumerate(prefs):
                for j in able:
                    joined_to[home(mine[j])] = home(layers[-1][i])
            choices.append(prefs)
            layers.append(mine)
            boxes, frame = now, int(self.frames[self.bounds[f]])
        final = [np.array([home(g) for g in layer], np.int64) for layer in layers]
        for g, size in zip(*np.unique(final[0], return_counts=True)):
            if size < 2:
                continue
            inside = [np.flatnonzero(layer == g) for layer in final]
            members, steps = [], []
            for k, prefs in enumerate(choices):
                if not len(inside[k + 1]):
                    break
                place = {int(j): p for p, j in enumerate(inside[k + 1])}
                rows = self.bounds[start + k] + inside[k + 1]
                members.append(rows)
                steps.append(([[place[j] for j in prefs[i]] for i in inside[k]], [self.key(r) for r in rows]))
            if members:
                yield [int(s) for s in inside[0]], members, steps

    def pieces(self, seeds: np.ndarray, before: int | None, end_frame: int) -> tuple[list[dict], np.ndarray, np.ndarray]:
        """(pieces, tracks, open rows) of the whole chunk, cut where a graph grows too large."""
        count = len(self.bounds) - 1
        told = int(self.frames[-1]) == end_frame
        try:
            piece, tracks, is_open = self.piece(seeds, before, 0, count, told)
            return [piece], tracks, is_open
        except TooLarge:
            pass
        out, start = [], 0
        tracks, _ = self.tracked(seeds, before, 0, count)
        while start < count:
            stop = count
            while True:
                try:
                    out.append(self.piece(seeds, before, start, stop, told or stop < count)[0])
                    break
                except TooLarge as e:
                    stop = min(stop - 1, start + e.layer)
                    if stop == start:  # one step alone: as it stands
                        now = self.frame(start)
                        born = [self.key(r) for r in range(now.start, now.stop)]
                        out.append({"n": len(seeds), "prefs": preferences(iou_matrix(seeds, self.boxes[now]), self.threshold), "born": born})
                        stop = start + 1
                        break
            seeds, before, start = self.boxes[self.frame(stop - 1)], int(self.frames[self.bounds[stop - 1]]), stop
        if not told and "prefs" in out[-1]:
            out.append({"n": len(seeds), "last": [], "mazes": []})
        return out, tracks, np.ones(len(tracks), bool)


def _labelled(rows: pd.DataFrame, held: _Rows, tracks: np.ndarray) -> pd.DataFrame:
    born = np.maximum(tracks, 0)
    inherited = tracks < 0
    return rows[[*_COLS, "chunk"]].assign(
        seed=np.where(inherited, -1 - tracks, -1),
        born_frame=np.where(inherited, -1, held.frames[born]),
        born_det=np.where(inherited, -1, held.dets[born]),
    )


def _split(pdf: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    is_seed = pdf["_seed"].to_numpy(dtype=bool)
    rows = pdf[~is_seed].sort_values(["frame_id", "det_id"], kind="stable").reset_index(drop=True)
    return pdf[is_seed].sort_values("det_id", kind="stable"), rows


def _run_chunk(skip: int, threshold: float, chunk_frames: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        seeds, rows = _split(pdf)
        if rows.empty:
            return pd.DataFrame(columns=CHUNKED.names)
        held = _Rows(rows, skip, threshold)
        end = (int(rows["chunk"].iloc[0]) + 1) * chunk_frames * skip - skip
        pieces, tracks, is_open = held.pieces(seeds[_BOX].to_numpy(np.int64), int(seeds["frame_id"].iloc[0]) if len(seeds) else None, end)
        out = _labelled(rows, held, tracks).assign(open=is_open, seeds=len(seeds), pieces=None)
        out.loc[0, "pieces"] = json.dumps(pieces)
        return out

    return run


def _run_ordered(skip: int, threshold: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Open rows of a chunk, tracked with the true order of its seeds."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        seeds, rows = _split(pdf)
        if rows.empty:
            return pd.DataFrame(columns=CHUNKED.names)
        held = _Rows(rows, skip, threshold)
        order = np.lexsort((seeds["first_det"], seeds["first_frame"]))
        before = int(seeds["frame_id"].iloc[0]) if len(seeds) else None
        tracks, _ = held.tracked(seeds[_BOX].to_numpy(np.int64), before, 0, len(held.bounds) - 1, order)
        # a seed's number counts all seeds of the chunk in box order
        return _labelled(rows, held, tracks).assign(open=False, seeds=len(seeds), pieces=None)

    return run


def _composed(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("node")
    pieces = [p for text in group["pieces"] for p in json.loads(text)]
    row = (int(key[0]), int(key[1]), int(group["seeds"].iloc[0]), json.dumps(compose(pieces)))
    return pd.DataFrame([row], columns=["video_id", "node", "seeds", "pieces"])


def _walked(video: int, children: pd.DataFrame, starts: pd.DataFrame) -> pd.DataFrame:
    """Birth keys of every child's seeds, from those of the first."""
    keys = [(int(f), int(d)) for f, d in starts.sort_values("seed")[["first_frame", "first_det"]].itertuples(index=False)]
    out = []
    for node, seeds, text in children.sort_values("node")[["node", "seeds", "pieces"]].itertuples(index=False):
        if seeds:
            out += [(video, int(node), j, *key) for j, key in enumerate(keys)]
        for piece in json.loads(text):
            keys = evaluate(piece, keys if piece["n"] else [])
    return pd.DataFrame(out, columns=["video_id", "node", "seed", "first_frame", "first_det"])


def chunk_starts(ranges: DataFrame, fan: int = FAN) -> DataFrame:
    """Birth keys of the seeds of every chunk, from the functions of all chunks (``RANGE``)."""
    top = ranges.agg(F.max("node")).first()[0] or 0
    levels = [ranges]
    while top >= fan:  # one level for each power of ``fan``
        top //= fan
        parent = levels[-1].withColumn("parent", F.floor(F.col("node") / fan))
        levels.append(cut_lineage(parent.groupBy("video_id", "parent").applyInPandas(_composed, RANGE)))

    none = pd.DataFrame(columns=["seed", "first_frame", "first_det"])
    starts = levels.pop().groupBy("video_id").applyInPandas(lambda key, g: _walked(int(key[0]), g, none), STARTS)
    for level in reversed(levels):
        children = level.withColumn("parent", F.floor(F.col("node") / fan)).groupBy("video_id", "parent")
        known = cut_lineage(starts).withColumnRenamed("node", "parent").groupBy("video_id", "parent")
        starts = children.cogroup(known).applyInPandas(lambda key, g, s: _walked(int(key[0]), g, s), STARTS)
    return cut_lineage(starts).withColumnRenamed("node", "chunk")


def running_offsets(counts: DataFrame, group: int = 1024) -> DataFrame:
    """``counts`` (video_id, chunk, n) with ``offset``, the sum of n of earlier chunks: within groups of chunks, and over groups."""
    counts = counts.withColumn("_group", F.floor(F.col("chunk") / group))
    over = Window.partitionBy("video_id").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = counts.groupBy("video_id", "_group").agg(F.sum("n").alias("n")).select("video_id", "_group", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("video_id", "_group").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    within = counts.withColumn("_within", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return within.join(groups, ["video_id", "_group"]).select("video_id", "chunk", (F.col("_before") + F.col("_within")).alias("offset"))


def tracked_rows(
    vehicle_boxes: DataFrame, frame_skip: int = 2, iou_threshold: float = 0.3, chunk_frames: int = 1024, fan: int = FAN
) -> DataFrame:
    """The rows with ``track_id`` and their track's ``first_frame`` and ``first_det`` (its birth key), and ``chunk``.

    A chunk holds ``chunk_frames`` processed frames, whatever the length of the
    videos. Input frame ids must be multiples of ``frame_skip`` (sampled).
    Checkpoints the tracked chunks and the small tables of the composition.
    """
    skip, thr, frames = int(frame_skip), float(iou_threshold), int(chunk_frames)
    span = F.lit(frames * skip).cast("bigint")
    src = vehicle_boxes.select(*[F.col(c).cast(TRACKED[c].dataType) for c in _COLS])
    base = src.withColumn("chunk", F.floor(F.col("frame_id") / span).cast("bigint"))
    seeds = base.filter(F.col("frame_id") % span == span - skip).withColumn("chunk", F.col("chunk") + 1)
    groups = base.withColumn("_seed", F.lit(False)).unionByName(seeds.withColumn("_seed", F.lit(True)))
    first = cut_lineage(groups.groupBy(*_CHUNK).applyInPandas(_run_chunk(skip, thr, frames), CHUNKED))
    starts = chunk_starts(first.where(F.col("pieces").isNotNull()).select("video_id", F.col("chunk").alias("node"), "seeds", "pieces"), fan)

    open_rows = first.where("open").select(*_COLS, "chunk")
    unknown = [F.lit(None).cast(t).alias(c) for c, t in (("first_frame", "long"), ("first_det", "int"))]
    nth = F.row_number().over(Window.partitionBy(*_CHUNK).orderBy("det_id")) - 1
    placed = seeds.join(open_rows.select(*_CHUNK).distinct(), _CHUNK, "left_semi").withColumn("seed", nth)
    placed = placed.join(starts, [*_CHUNK, "seed"]).withColumn("_seed", F.lit(True)).drop("seed")
    again = open_rows.select("*", *unknown, F.lit(False).alias("_seed")).unionByName(placed)
    again = again.groupBy(*_CHUNK).applyInPandas(_run_ordered(skip, thr), CHUNKED)
    rows = first.where(~F.col("open")).unionByName(cut_lineage(again)).select(*_COLS, "chunk", *_LABEL)

    born = rows.where((F.col("seed") < 0) & (F.col("born_frame") == F.col("frame_id")) & (F.col("born_det") == F.col("det_id")))
    born = born.select(*_CHUNK, F.col("frame_id").alias("first_frame"), F.col("det_id").alias("first_det"))
    offsets = running_offsets(born.groupBy(*_CHUNK).agg(F.count(F.lit(1)).alias("n")))
    rank = F.row_number().over(Window.partitionBy(*_CHUNK).orderBy("first_frame", "first_det"))
    numbered = born.withColumn("_rank", rank).join(offsets, _CHUNK).withColumn("track_id", F.col("offset") + F.col("_rank") - 1).drop("_rank", "offset")
    from_before = starts.join(numbered.drop("chunk"), ["video_id", "first_frame", "first_det"])
    table = numbered.withColumn("seed", F.lit(-1)).withColumn("born_frame", F.col("first_frame")).withColumn("born_det", F.col("first_det"))
    table = table.unionByName(from_before.withColumn("born_frame", F.lit(-1).cast("long")).withColumn("born_det", F.lit(-1)))
    return rows.join(table, [*_CHUNK, *_LABEL]).select(*TRACKED.names, "first_frame", "first_det", "chunk")


def track_ids_chunked(
    vehicle_boxes: DataFrame, frame_skip: int = 2, iou_threshold: float = 0.3, chunk_frames: int = 1024, fan: int = FAN
) -> DataFrame:
    """Same rows and ids as :func:`roadlens.operators.tracking.track_ids`, computed over frame ranges."""
    return tracked_rows(vehicle_boxes, frame_skip, iou_threshold, chunk_frames, fan).select(*TRACKED.names)
