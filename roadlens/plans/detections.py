"""Registered detection queries: Spark builders and DuckDB oracle text.

Keys of single rules use ``det_id`` as the track id (each adapter slot is one
object, FIXTURES §D). The keys of the real tracker (``track_ids``,
``track_history``, ``track_paths``, ``detect_violations``) have a recursive
DuckDB query of their own, one row of it per video and track choice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.operators import aggregates as agg
from roadlens.operators import detections as dt
from roadlens.operators import tracking as tk
from roadlens.operators.chunked_tracking import track_ids_chunked, tracked_rows
from roadlens.plans.oracle import DETECTIONS, with_views
from roadlens.schemas import DETECTIONS as DETECTION_SCHEMA
from roadlens.schemas import TRACKED
from roadlens.session import cut_lineage, scratch_path
from roadlens.sources.adapters import raw_detections
from roadlens.streaming.live_tracks import run_available

P = dt.DetectionParams()
KEYS = ["video_id", "frame_id", "track_id"]
# Processed frames per tracker chunk in the registered queries: a video of the
# fixture has 150, a long one 150 for every 6,300 events, so all cross chunk ends.
CHUNK_FRAMES = 64

# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------


def det(s: SparkSession, d: str) -> DataFrame:
    """The detections fixture: row-local, so every branch filters in its own scan."""
    return raw_detections(s, d)


def proc(s, d):
    return dt.processed(det(s, d), P)


def vehs(s, d):
    return dt.vehicles(proc(s, d))


def det_tracks(s, d):
    """Vehicle boxes with ``det_id`` standing in as the track id (oracle form)."""
    return vehs(s, d).withColumn("track_id", F.col("det_id").cast("bigint"))


def evaluated(s, d, tracker=False):
    p = proc(s, d)
    vehicles = dt.vehicles(p)
    if tracker:
        # read by several joins below
        t = cut_lineage(track_ids_chunked(vehicles, P.frame_skip, P.iou_threshold, CHUNK_FRAMES))
    else:
        t = vehicles.withColumn("track_id", F.col("det_id").cast("bigint"))
    return dt.evaluate(t, p, P, with_helmets=True)


def tracked(s, d):
    return track_ids_chunked(vehs(s, d), P.frame_skip, P.iou_threshold, CHUNK_FRAMES)


def _born(s, d):
    return tracked_rows(vehs(s, d), P.frame_skip, P.iou_threshold, CHUNK_FRAMES)


def _ctx(s, d):
    p = proc(s, d)
    tracks = dt.vehicles(p).withColumn("track_id", F.col("det_id").cast("bigint"))
    return dt.frame_context(tracks, p, True, P.label_iou)


def _with_helmets(s, d, join):
    p = proc(s, d)
    tracks = dt.vehicles(p).withColumn("track_id", F.col("det_id").cast("bigint"))
    return join(tracks, dt.helmet_boxes(p)).select(*KEYS)


def _violations(s, d):
    return dt.violations_table(evaluated(s, d))


def _summary(s, d):
    return dt.summary(evaluated(s, d))


def detect_violations(s, d):
    """The whole chain with the real tracker (D11): violation rows."""
    return dt.violations_table(evaluated(s, d, tracker=True))


def _rates(s, d):
    videos = det(s, d).select("video_id").distinct()
    return videos.select("video_id", F.when(F.col("video_id") % 2 == 1, 30.0).alias("fps"))


def _stream_tracks(s, d):
    """The live tracker in two runs: the first ends inside a frame of each video, the second brings the rest and the ends."""
    boxes = vehs(s, d)
    ends = boxes.groupBy("video_id").agg((F.floor(F.max("frame_id") / (2 * P.frame_skip)) * P.frame_skip).alias("middle"))
    dealt = boxes.join(ends, "video_id")
    early = (F.col("frame_id") < F.col("middle")) | ((F.col("frame_id") == F.col("middle")) & (F.col("det_id") == 0))
    marks = ends.select("video_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in DETECTION_SCHEMA.fields if f.name != "video_id"])
    source, target, checkpoint = (scratch_path(s, f"live-{x}") for x in ("boxes", "tracks", "check"))
    for part in (dealt.where(early), dealt.where(~early).unionByName(marks, allowMissingColumns=True)):
        part.select(*DETECTION_SCHEMA.names).write.mode("append").parquet(source)
        run_available(s, source, target, checkpoint, P.frame_skip, P.iou_threshold)
    return s.read.schema(TRACKED).parquet(target)


SPARK = {
    "scan_detections": det,
    "sample_frames": lambda s, d: dt.sample_frames(det(s, d), P.frame_skip),
    "det_confident": lambda s, d: dt.confident(det(s, d), P.min_conf),
    "det_vehicles": vehs,
    "det_persons": lambda s, d: dt.persons(proc(s, d)),
    "centroids": lambda s, d: dt.centroids(vehs(s, d)).select("video_id", "frame_id", "det_id", "cx", "cy"),
    "iou_pairs": lambda s, d: dt.iou_pairs(vehs(s, d), P.frame_skip),
    "track_label": lambda s, d: _ctx(s, d).select(*KEYS, "vehicle_type"),
    "helmet_present": lambda s, d: _with_helmets(s, d, dt.helmet_present),
    "no_helmet": lambda s, d: _with_helmets(s, d, dt.no_helmet),
    "triple_riding": lambda s, d: _ctx(s, d).select(
        *KEYS,
        "persons_overlapping",
        (F.col("vehicle_type").isin(list(dt.TWO_WHEELERS)) & (F.col("persons_overlapping") >= 3)).alias(
            "triple_riding"
        ),
    ),
    "track_displacement": lambda s, d: dt.with_displacement(det_tracks(s, d), P.frame_skip).select(
        *KEYS, "cx", "cy", "prev_cx", "prev_cy"
    ),
    "speed_kmph": lambda s, d: dt.with_speed(det_tracks(s, d), P).select(
        *KEYS, F.round("speed_kmph", 6).alias("speed_kmph")
    ),
    # videos at 25 (the fallback) and 30 frames a second
    "speed_kmph_rates": lambda s, d: dt.with_speed(det_tracks(s, d), P, _rates(s, d)).select(
        *KEYS, F.round("speed_kmph", 6).alias("speed_kmph")
    ),
    "rule_flags": lambda s, d: evaluated(s, d).select(*KEYS, "overspeed", "no_helmet", "triple_riding"),
    "detection_summary": _summary,
    "detection_violations": _violations,
    "violation_mix": lambda s, d: agg.explode_count(_violations(s, d), "violation_type"),
    "violation_share": lambda s, d: agg.share(agg.explode_count(_violations(s, d), "violation_type")),
    "speed_histogram": lambda s, d: agg.histogram(_summary(s, d), "speed_kmph", 20),
    "detection_totals": lambda s, d: dt.totals(evaluated(s, d)),
    "track_ids": tracked,
    "track_history": lambda s, d: tk.track_history(_born(s, d), P.frame_skip),
    "track_paths": lambda s, d: tk.track_paths(_born(s, d)),
    "stream_tracks": _stream_tracks,
    "detect_violations": detect_violations,
}

# --------------------------------------------------------------------------
# DuckDB side
# --------------------------------------------------------------------------

_VCLS = ", ".join(f"'{c}'" for c in dt.VEHICLE_CLASSES)
_TWO = ", ".join(f"'{c}'" for c in dt.TWO_WHEELERS)


def _iou(a: str, b: str) -> str:
    w = f"(least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1))"
    h = f"(least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1))"
    inter = f"(greatest(0, {w}) * greatest(0, {h}))"

    def area(t):
        return f"greatest(0, ({t}.x2 - {t}.x1) * ({t}.y2 - {t}.y1))"

    denom = f"({area(a)} + {area(b)} - {inter})"
    return f"(CASE WHEN {denom} = 0 THEN 0.0 ELSE CAST({inter} AS DOUBLE) / CAST({denom} AS DOUBLE) END)"


def _overlap(a: str, b: str) -> str:
    return (
        f"((least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) > 0 AND "
        f"(least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1)) > 0)"
    )


def _same_frame(a: str, b: str) -> str:
    return f"{a}.video_id = {b}.video_id AND {a}.frame_id = {b}.frame_id"


PROC = f"SELECT * FROM det WHERE frame_id % {P.frame_skip} = 0 AND conf >= {P.min_conf}"
VEH = f"SELECT * FROM proc WHERE lower(class_name) IN ({_VCLS})"
PER = "SELECT * FROM proc WHERE lower(class_name) = 'person'"
HEL = "SELECT * FROM proc WHERE lower(class_name) = 'helmet'"
TRK = "SELECT *, CAST(det_id AS BIGINT) AS track_id FROM veh"
CTX = f"""
SELECT t.*,
  coalesce((SELECT lower(v.class_name) FROM veh v WHERE {_same_frame('v', 't')} AND {_iou('t', 'v')} > {P.label_iou}
            ORDER BY v.det_id LIMIT 1), 'vehicle') AS vehicle_type,
  (SELECT count(*) FROM per p WHERE {_same_frame('p', 't')} AND {_overlap('t', 'p')}) AS persons_overlapping,
  EXISTS (SELECT 1 FROM hel h WHERE {_same_frame('h', 't')} AND {_overlap('t', 'h')}) AS helmet_present
FROM trk t
"""
DISP = f"""
SELECT c.*, CAST(c.x1 + c.x2 AS DOUBLE) / 2 AS cx, CAST(c.y1 + c.y2 AS DOUBLE) / 2 AS cy, p.prev_cx, p.prev_cy
FROM {{src}} c LEFT JOIN (
  SELECT video_id, track_id, frame_id + {P.frame_skip} AS frame_id,
         CAST(x1 + x2 AS DOUBLE) / 2 AS prev_cx, CAST(y1 + y2 AS DOUBLE) / 2 AS prev_cy FROM trk) p
USING (video_id, track_id, frame_id)
"""
_SECONDS = f"(CAST(1 AS DOUBLE) / CAST({P.fps} AS DOUBLE))"
_KMPH = (
    f"CASE WHEN prev_cx IS NULL THEN 0.0 ELSE "
    f"sqrt((cx - prev_cx) * (cx - prev_cx) + (cy - prev_cy) * (cy - prev_cy)) * CAST({P.meters_per_pixel} AS DOUBLE) "
    f"/ {_SECONDS} * 3.6 END"
)
SPD_RATES = f"SELECT *, {_KMPH} * CASE WHEN video_id % 2 = 1 THEN 30.0 / {P.fps} ELSE 1.0 END AS speed_kmph FROM disp"
SPD = f"SELECT *, {_KMPH} AS speed_kmph FROM disp"
FLAGS = f"""
SELECT *,
  speed_kmph >= {P.speed_limit_kmph} AS overspeed,
  CASE WHEN vehicle_type IN ({_TWO}) THEN NOT helmet_present END AS no_helmet,
  vehicle_type IN ({_TWO}) AND persons_overlapping >= 3 AS triple_riding
FROM spd
"""
EVAL = (
    "SELECT *, concat_ws(';', CASE WHEN overspeed THEN 'Overspeed' END, "
    "CASE WHEN no_helmet THEN 'No Helmet' END, CASE WHEN triple_riding THEN 'Triple Riding' END) AS violations "
    "FROM flags"
)
SUMMARY = (
    "SELECT video_id, frame_id, track_id, vehicle_type, round(speed_kmph, 2) AS speed_kmph, violations, "
    "[x1, y1, x2, y2] AS bbox FROM ev"
)
VIOL = (
    "SELECT video_id, frame_id, track_id, vehicle_type, round(speed_kmph, 2) AS speed_kmph, "
    f"violations AS violation_type, round(frame_id / CAST({P.fps} AS DOUBLE), 6) AS frame_time_s, "
    "x1, y1, x2, y2 FROM ev WHERE violations <> ''"
)
MIX = (
    "SELECT violation, count(*) AS count FROM (SELECT unnest(string_split(violation_type, ';')) AS violation "
    "FROM vio WHERE violation_type IS NOT NULL AND violation_type <> '') GROUP BY violation"
)


def _views(**extra: str) -> dict[str, str]:
    v = {"det": DETECTIONS, "proc": PROC, "veh": VEH, "per": PER, "hel": HEL, "trk": TRK}
    v.update(extra)
    return v


def _full(**extra: str) -> dict[str, str]:
    return _views(
        ctx=CTX, disp=DISP.format(src="ctx"), spd=SPD, flags=FLAGS, ev=EVAL, summ=SUMMARY, vio=VIOL, **extra
    )


# The real tracker. One row of ``run`` is a video before its next choice: track
# number ``i`` of the frame before (oldest first) takes its box of frame ``k``,
# or, when all have chosen, the boxes left over are born and ``k`` moves on.
FRAMES = f"""
SELECT *, row_number() OVER w AS k, coalesce(frame_id - lag(frame_id) OVER w = {P.frame_skip}, false) AS follows
FROM (SELECT video_id, frame_id,
        list({{'det': det_id, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}} ORDER BY det_id) AS boxes
      FROM veh GROUP BY video_id, frame_id)
WINDOW w AS (PARTITION BY video_id ORDER BY frame_id)
"""
_HELD_IOU = _iou("r.tracks[r.i].box", "f.boxes[j]")
RUN = f"""
SELECT video_id, 1::BIGINT AS k, 1::BIGINT AS i, boxes[1:0].list_transform(lambda b: {{'id': 0::BIGINT, 'box': b}}) AS tracks,
       []::BIGINT[] AS taken, []::STRUCT(id BIGINT, j BIGINT)[] AS kept, 0::BIGINT AS next_id, NULL::STRUCT(id BIGINT, j BIGINT)[] AS made
FROM frames WHERE k = 1
UNION ALL
SELECT video_id,
       CASE WHEN ended THEN k + 1 ELSE k END,
       CASE WHEN ended THEN 1 ELSE i + 1 END,
       CASE WHEN NOT ended THEN tracks WHEN goes_on THEN list_transform(placed, lambda t: {{'id': t.id, 'box': boxes[t.j]}}) ELSE tracks[1:0] END,
       CASE WHEN ended THEN []::BIGINT[] WHEN best IS NULL THEN taken ELSE list_append(taken, best) END,
       CASE WHEN ended THEN []::STRUCT(id BIGINT, j BIGINT)[] WHEN best IS NULL THEN kept
            ELSE list_append(kept, {{'id': tracks[i].id, 'j': best}}) END,
       CASE WHEN ended THEN next_id + len(fresh) ELSE next_id END,
       CASE WHEN ended THEN placed END
FROM (
  SELECT *, list_concat(kept, list_transform(fresh, lambda j, n: {{'id': next_id + n - 1, 'j': j}})) AS placed
  FROM (
    SELECT r.*, f.boxes, coalesce(g.follows, false) AS goes_on, r.i > len(r.tracks) AS ended,
           list_filter(range(1, len(f.boxes) + 1), lambda j: NOT list_contains(r.taken, j)) AS fresh,
           -list_reverse_sort(list_transform(
             list_filter(range(1, len(f.boxes) + 1), lambda j: r.i <= len(r.tracks) AND NOT list_contains(r.taken, j)
               AND {_HELD_IOU} > 0 AND {_HELD_IOU} >= {P.iou_threshold}),
             lambda j: {{'iou': {_HELD_IOU}, 'minus_j': -j}}))[1].minus_j AS best
    FROM run r JOIN frames f ON f.video_id = r.video_id AND f.k = r.k
    LEFT JOIN frames g ON g.video_id = r.video_id AND g.k = r.k + 1))
"""
PLACED = """
SELECT f.video_id, f.frame_id, f.boxes[t.j].det AS det_id, t.id AS track_id
FROM (SELECT video_id, k - 1 AS k, unnest(made) AS t FROM run WHERE made IS NOT NULL) r JOIN frames f USING (video_id, k)
"""
REAL_TRK = "SELECT v.*, placed.track_id FROM veh v JOIN placed USING (video_id, frame_id, det_id)"
HISTORY = """
SELECT video_id, track_id, frame_id, row_number() OVER (PARTITION BY video_id, track_id ORDER BY frame_id) AS history_len,
       CAST(x1 + x2 AS DOUBLE) / 2 AS cx, CAST(y1 + y2 AS DOUBLE) / 2 AS cy
FROM trk
"""


def _q(body: str, views: dict[str, str]) -> str:
    return with_views(body, **views)


def _tracked_q(body: str, **extra: str) -> str:
    views = {**_views(), "frames": FRAMES, "run": RUN, "placed": PLACED, "trk": REAL_TRK, **extra}
    order = ["det", "proc", "veh", "per", "hel", "frames", "run", "placed", "trk", *extra]
    text = with_views(body, **{name: views[name] for name in order})
    for name in ("frames", "placed"):  # kept once
        text = text.replace(f"{name} AS (", f"{name} AS MATERIALIZED (", 1)
    return text.replace("WITH det", "WITH RECURSIVE det", 1)


_HIST = f"""
SELECT b.bin, round(lo + (b.bin - 1) * (hi - lo) / 20, 6) AS bin_lo, round(lo + b.bin * (hi - lo) / 20, 6) AS bin_hi,
  CAST(coalesce(n.count, 0) AS BIGINT) AS count
FROM (SELECT range AS bin FROM range(1, 21)) b
CROSS JOIN (SELECT min(speed_kmph) AS lo, max(speed_kmph) AS hi FROM summ WHERE speed_kmph IS NOT NULL) m
LEFT JOIN (
  SELECT CASE WHEN hi = lo THEN 1 ELSE least(CAST(floor((speed_kmph - lo) / (hi - lo) * 20) AS BIGINT) + 1, 20) END AS bin,
         count(*) AS count
  FROM summ CROSS JOIN (SELECT min(speed_kmph) AS lo, max(speed_kmph) AS hi FROM summ) mm
  WHERE speed_kmph IS NOT NULL GROUP BY 1) n ON n.bin = b.bin
WHERE lo IS NOT NULL
"""

SQL = {
    "scan_detections": _q("SELECT * FROM det", _views()),
    "sample_frames": _q(f"SELECT * FROM det WHERE frame_id % {P.frame_skip} = 0", _views()),
    "det_confident": _q(f"SELECT * FROM det WHERE conf >= {P.min_conf}", _views()),
    "det_vehicles": _q("SELECT * FROM veh", _views()),
    "det_persons": _q("SELECT * FROM per", _views()),
    "centroids": _q(
        "SELECT video_id, frame_id, det_id, CAST(x1 + x2 AS DOUBLE) / 2 AS cx, CAST(y1 + y2 AS DOUBLE) / 2 AS cy "
        "FROM veh",
        _views(),
    ),
    "iou_pairs": _q(
        f"SELECT c.video_id, c.frame_id, p.det_id AS prev_det_id, c.det_id, round({_iou('p', 'c')}, 6) AS iou "
        f"FROM veh p JOIN veh c ON c.video_id = p.video_id AND c.frame_id = p.frame_id + {P.frame_skip} "
        f"WHERE {_iou('p', 'c')} > 0",
        _views(),
    ),
    "track_label": _q("SELECT video_id, frame_id, track_id, vehicle_type FROM ctx", _views(ctx=CTX)),
    "helmet_present": _q(
        f"SELECT video_id, frame_id, track_id FROM trk t WHERE EXISTS "
        f"(SELECT 1 FROM hel h WHERE {_same_frame('h', 't')} AND {_overlap('t', 'h')})",
        _views(),
    ),
    "no_helmet": _q(
        f"SELECT video_id, frame_id, track_id FROM trk t WHERE NOT EXISTS "
        f"(SELECT 1 FROM hel h WHERE {_same_frame('h', 't')} AND {_overlap('t', 'h')})",
        _views(),
    ),
    "triple_riding": _q(
        f"SELECT video_id, frame_id, track_id, persons_overlapping, "
        f"vehicle_type IN ({_TWO}) AND persons_overlapping >= 3 AS triple_riding FROM ctx",
        _views(ctx=CTX),
    ),
    "track_displacement": _q(
        "SELECT video_id, frame_id, track_id, cx, cy, prev_cx, prev_cy FROM disp",
        _views(disp=DISP.format(src="trk")),
    ),
    "speed_kmph": _q(
        "SELECT video_id, frame_id, track_id, round(speed_kmph, 6) AS speed_kmph FROM spd",
        _views(disp=DISP.format(src="trk"), spd=SPD),
    ),
    "speed_kmph_rates": _q(
        "SELECT video_id, frame_id, track_id, round(speed_kmph, 6) AS speed_kmph FROM spd",
        _views(disp=DISP.format(src="trk"), spd=SPD_RATES),
    ),
    "rule_flags": _q("SELECT video_id, frame_id, track_id, overspeed, no_helmet, triple_riding FROM ev", _full()),
    "detection_summary": _q("SELECT * FROM summ", _full()),
    "detection_violations": _q("SELECT * FROM vio", _full()),
    "violation_mix": _q(MIX, _full()),
    "violation_share": _q(
        "SELECT violation, count, round(100.0 * count / (SELECT sum(count) FROM mix), 6) AS percent FROM mix",
        _full(mix=MIX),
    ),
    "speed_histogram": _q(_HIST, _full()),
    "detection_totals": _q(
        "SELECT (SELECT count(*) FROM vio) AS violation_rows, (SELECT count(*) FROM summ) AS detection_rows, "
        "(SELECT count(DISTINCT (video_id, track_id)) FROM summ) AS distinct_tracks",
        _full(),
    ),
    "track_ids": _tracked_q(f"SELECT {', '.join(TRACKED.names)} FROM trk"),
    "stream_tracks": _tracked_q(f"SELECT {', '.join(TRACKED.names)} FROM trk"),
    "track_history": _tracked_q("SELECT * FROM history", history=HISTORY),
    "track_paths": _tracked_q(
        "SELECT video_id, track_id, min(frame_id) AS first_frame, max(frame_id) AS last_frame, count(*) AS points, "
        "list(cx ORDER BY frame_id) AS path_x, list(cy ORDER BY frame_id) AS path_y FROM history GROUP BY video_id, track_id",
        history=HISTORY,
    ),
    "detect_violations": _tracked_q(
        "SELECT * FROM vio", ctx=CTX, disp=DISP.format(src="ctx"), spd=SPD, flags=FLAGS, ev=EVAL, vio=VIOL
    ),
}
