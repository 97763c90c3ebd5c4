"""Detection tables -> speeds, rule flags and violation tables.

Input is a long table with one row per box (FIXTURES F14). Every box-vs-box
test is a join on ``(video_id, frame_id)`` with the geometry as a residual
condition, so pairs are only ever formed inside one frame, whose box count the
detector bounds. Speeds join each track row to the same track one processed
frame earlier on the unique key ``(video_id, track_id, frame_id)``: a long
track is spread over all tasks by hash, unlike a window over the track.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.functions.geometry import box, centroid_x, centroid_y, iou, kmph, overlaps

# Fixed values that must equal the reference's behaviour: the class names that
# count as vehicles and as two-wheelers, the person class, the rule labels and
# their order in the joined text.
VEHICLE_CLASSES = ("car", "truck", "bus", "motorcycle", "bicycle", "motorbike", "bike", "van", "auto")
TWO_WHEELERS = ("motorcycle", "bike", "bicycle", "motorbike")
PERSON_CLASS = "person"
RULE_LABELS = ("Overspeed", "No Helmet", "Triple Riding")
DEFAULT_LABEL = "vehicle"

FRAME = ["video_id", "frame_id"]
BOX = ["x1", "y1", "x2", "y2"]


@dataclass(frozen=True)
class DetectionParams:
    """Detection parameters.

    Fixed values that must equal the reference's behaviour: the defaults
    below are its defaults (fallback fps 25, 0.05 m per pixel, 60 km/h limit,
    confidence 0.35, tracker IoU 0.3, every 2nd frame, label IoU above 0.5).
    """

    fps: float = 25.0
    meters_per_pixel: float = 0.05
    speed_limit_kmph: float = 60.0
    min_conf: float = 0.35
    iou_threshold: float = 0.3
    frame_skip: int = 2
    label_iou: float = 0.5
    # "one": one frame elapses between processed frames (reference parity);
    # "actual": ``frame_skip`` frames elapse.
    elapsed: str = "one"


# ---------------------------------------------------------------- filters


def sample_frames(det: DataFrame, frame_skip: int) -> DataFrame:
    """Every ``frame_skip``-th frame."""
    return det.filter(F.col("frame_id") % F.lit(frame_skip) == 0)


def confident(det: DataFrame, min_conf: float) -> DataFrame:
    """Boxes with ``conf >= min_conf``."""
    return det.filter(F.col("conf") >= F.lit(min_conf))


def of_classes(det: DataFrame, classes) -> DataFrame:
    """Boxes whose lower-cased class is in ``classes`` (F8)."""
    return det.filter(F.lower(F.col("class_name")).isin(list(classes)))


def processed(det: DataFrame, params: DetectionParams) -> DataFrame:
    """Frame sampling then confidence filter: what the reference feeds the tracker."""
    return confident(sample_frames(det, params.frame_skip), params.min_conf)


def vehicles(det: DataFrame) -> DataFrame:
    return of_classes(det, VEHICLE_CLASSES)


def persons(det: DataFrame) -> DataFrame:
    return of_classes(det, [PERSON_CLASS])


def helmet_boxes(det: DataFrame, helmet_class: str = "helmet") -> DataFrame:
    """Helmet boxes when helmets come as a class of the same detection table."""
    return of_classes(det, [helmet_class])


# ---------------------------------------------------------------- geometry


def centroids(df: DataFrame) -> DataFrame:
    """Box centre ``cx``, ``cy``."""
    b = box()
    return df.withColumn("cx", centroid_x(b)).withColumn("cy", centroid_y(b))


def iou_pairs(vehs: DataFrame, frame_skip: int, min_iou: float = 0.0) -> DataFrame:
    """Box pairs of consecutive processed frames with IoU > ``min_iou``.

    Equi-join on ``(video_id, frame_id = previous frame_id + skip)``; the IoU
    test is the residual condition.
    """
    p = vehs.select(*FRAME, "det_id", *BOX).alias("p")
    c = vehs.select(*FRAME, "det_id", *BOX).alias("c")
    cond = (
        (F.col("c.video_id") == F.col("p.video_id"))
        & (F.col("c.frame_id") == F.col("p.frame_id") + F.lit(frame_skip))
    )
    v = iou(box(alias="p"), box(alias="c"))
    return (
        p.join(c, cond & (v > F.lit(min_iou)), "inner")
        .select(
            F.col("c.video_id").alias("video_id"),
            F.col("c.frame_id").alias("frame_id"),
            F.col("p.det_id").alias("prev_det_id"),
            F.col("c.det_id").alias("det_id"),
            F.round(v, 6).alias("iou"),
        )
    )


# ---------------------------------------------------------------- per-frame context


def frame_context(
    tracks: DataFrame,
    frame_boxes: DataFrame,
    with_helmets: bool,
    label_iou: float = 0.5,
    helmet_class: str = "helmet",
) -> DataFrame:
    """For every track row: its label, overlapping persons, helmet presence.

    ``frame_boxes`` holds every processed box of the frames (vehicles, persons
    and, when ``with_helmets``, helmets as class ``helmet_class``). One join of
    the track boxes with that single table on ``(video_id, frame_id)``, then
    one aggregate per track row. The track's own vehicle box always passes
    the join condition, so every track row survives without a join back.
    """
    cls = F.lower(F.col("class_name"))
    kind = (
        F.when(cls.isin(list(VEHICLE_CLASSES)), F.lit("vehicle"))
        .when(cls == PERSON_CLASS, F.lit("person"))
        .when(F.lit(with_helmets) & (cls == helmet_class), F.lit("helmet"))
    )
    others = frame_boxes.select(*FRAME, "det_id", cls.alias("cls"), *BOX, kind.alias("kind")).filter(
        F.col("kind").isNotNull()
    )
    t = tracks.alias("t")
    o = others.alias("o")
    tb, ob = box(alias="t"), box(alias="o")
    pair_iou = iou(tb, ob)
    is_vehicle = F.col("o.kind") == "vehicle"
    cond = (
        (F.col("t.video_id") == F.col("o.video_id"))
        & (F.col("t.frame_id") == F.col("o.frame_id"))
        & (
            (is_vehicle & ((F.col("o.det_id") == F.col("t.det_id")) | (pair_iou > F.lit(label_iou))))
            | (~is_vehicle & overlaps(tb, ob))
        )
    )
    label_candidate = F.when(
        is_vehicle & (pair_iou > F.lit(label_iou)),
        F.struct(F.col("o.det_id").alias("d"), F.col("o.cls").alias("c")),
    )
    keys = [F.col(f"t.{c}").alias(c) for c in tracks.columns]
    out = t.join(o, cond, "inner").groupBy(*keys).agg(
        F.min(label_candidate).alias("_label"),
        F.count_if(F.col("o.kind") == "person").alias("persons_overlapping"),
        F.max(F.col("o.kind") == "helmet").alias("_helmet"),
    )
    helmet_present = (
        F.coalesce(F.col("_helmet"), F.lit(False)) if with_helmets else F.lit(None).cast("boolean")
    )
    return out.select(
        *tracks.columns,
        F.coalesce(F.col("_label.c"), F.lit(DEFAULT_LABEL)).alias("vehicle_type"),
        F.col("persons_overlapping"),
        helmet_present.alias("helmet_present"),
    )


def helmet_present(tracks: DataFrame, helmets: DataFrame) -> DataFrame:
    """Track rows with at least one overlapping helmet box (J4, semi join)."""
    cond = (
        (F.col("t.video_id") == F.col("h.video_id"))
        & (F.col("t.frame_id") == F.col("h.frame_id"))
        & overlaps(box(alias="t"), box(alias="h"))
    )
    return tracks.alias("t").join(helmets.alias("h"), cond, "left_semi")


def no_helmet(tracks: DataFrame, helmets: DataFrame) -> DataFrame:
    """Track rows with no overlapping helmet box (J4, anti join)."""
    cond = (
        (F.col("t.video_id") == F.col("h.video_id"))
        & (F.col("t.frame_id") == F.col("h.frame_id"))
        & overlaps(box(alias="t"), box(alias="h"))
    )
    return tracks.alias("t").join(helmets.alias("h"), cond, "left_anti")


# ---------------------------------------------------------------- speed


def with_displacement(tracks: DataFrame, frame_skip: int) -> DataFrame:
    """Previous centroid of the same track one processed frame earlier.

    ``prev_cx``/``prev_cy`` are null for the first position of a track.
    """
    cur = centroids(tracks)
    prev = cur.select(
        "video_id",
        "track_id",
        (F.col("frame_id") + F.lit(frame_skip)).alias("frame_id"),
        F.col("cx").alias("prev_cx"),
        F.col("cy").alias("prev_cy"),
    )
    return cur.join(prev, ["video_id", "track_id", "frame_id"], "left")


def with_video_rates(rows: DataFrame, params: DetectionParams, rates: DataFrame | None = None) -> DataFrame:
    """Adds each video's ``fps`` and ``meters_per_pixel``.

    ``rates`` has one row per video with ``video_id`` and either or both
    columns; a video without one, or with null or 0, gets the parameter.
    """
    fallback = {"fps": params.fps, "meters_per_pixel": params.meters_per_pixel}
    if rates is None:
        return rows.select("*", *[F.lit(float(v)).alias(c) for c, v in fallback.items()])
    given = rates.select("video_id", *[F.col(c).cast("double").alias(f"_{c}") for c in fallback if c in rates.columns])
    joined = rows.join(given, "video_id", "left")
    for c, v in fallback.items():
        own = F.col(f"_{c}") if c in rates.columns else F.lit(None).cast("double")
        joined = joined.withColumn(c, F.when(own > 0, own).otherwise(F.lit(float(v))))
    return joined.drop(*[f"_{c}" for c in fallback])


def with_speed(tracks: DataFrame, params: DetectionParams, rates: DataFrame | None = None) -> DataFrame:
    """``speed_kmph`` from the displacement at the video's own rates; 0 at a track's first position."""
    d = with_video_rates(with_displacement(tracks, params.frame_skip), params, rates)
    frames = 1 if params.elapsed == "one" else params.frame_skip
    speed = F.when(
        F.col("prev_cx").isNotNull(),
        kmph(F.col("cx") - F.col("prev_cx"), F.col("cy") - F.col("prev_cy"), frames, F.col("fps"), F.col("meters_per_pixel")),
    ).otherwise(F.lit(0.0))
    return d.withColumn("speed_kmph", speed).drop("meters_per_pixel")


# ---------------------------------------------------------------- rules


def rule_flags(ctx: DataFrame, params: DetectionParams, has_helmets: bool) -> DataFrame:
    """``overspeed``, ``no_helmet`` (null without a helmet source), ``triple_riding``."""
    two_wheeler = F.col("vehicle_type").isin(list(TWO_WHEELERS))
    if has_helmets:
        nh = F.when(two_wheeler, ~F.col("helmet_present"))
    else:
        nh = F.lit(None).cast("boolean")
    return (
        ctx.withColumn("overspeed", F.col("speed_kmph") >= F.lit(params.speed_limit_kmph))
        .withColumn("no_helmet", nh)
        .withColumn("triple_riding", two_wheeler & (F.col("persons_overlapping") >= 3))
    )


def violation_text() -> F.Column:
    """Rules joined with ``;`` in fixed order, ``""`` when none."""
    over, helmet, triple = RULE_LABELS
    return F.concat_ws(
        ";",
        F.when(F.col("overspeed"), F.lit(over)),
        F.when(F.col("no_helmet") == F.lit(True), F.lit(helmet)),
        F.when(F.col("triple_riding"), F.lit(triple)),
    )


def evaluate(
    tracks: DataFrame,
    frame_boxes: DataFrame,
    params: DetectionParams,
    with_helmets: bool,
    helmets: DataFrame | None = None,
    rates: DataFrame | None = None,
) -> DataFrame:
    """Tracks (vehicle boxes with ``track_id``) -> flags and violation text per row.

    Helmet boxes are the ``helmet`` class of ``frame_boxes``, or, as with the
    reference's separate helmet model, a separate ``helmets`` table (same
    columns) that is filtered by confidence and frame sampling like the rest.
    Speed is joined first on the thin track rows, then the frame context is
    computed once on the result.
    """
    if helmets is not None:
        extra = processed(helmets, params).withColumn("class_name", F.lit("helmet"))
        frame_boxes = frame_boxes.unionByName(extra.select(*frame_boxes.columns))
        with_helmets = True
    fast = with_speed(tracks, params, rates).drop("cx", "cy", "prev_cx", "prev_cy")
    ctx = frame_context(fast, frame_boxes, with_helmets, params.label_iou)
    flagged = rule_flags(ctx, params, with_helmets)
    return flagged.withColumn("violations", violation_text())


def summary(evaluated: DataFrame) -> DataFrame:
    """One row per vehicle box per processed frame."""
    return evaluated.select(
        "video_id",
        "frame_id",
        "track_id",
        "vehicle_type",
        F.round("speed_kmph", 2).alias("speed_kmph"),
        "violations",
        F.array(*[F.col(c) for c in BOX]).alias("bbox"),
    )


def violations_table(evaluated: DataFrame) -> DataFrame:
    """Rows with at least one rule; stamped with the frame's time in its video."""
    return evaluated.filter(F.col("violations") != "").select(
        "video_id",
        "frame_id",
        "track_id",
        "vehicle_type",
        F.round("speed_kmph", 2).alias("speed_kmph"),
        F.col("violations").alias("violation_type"),
        F.round(F.col("frame_id") / F.col("fps"), 6).alias("frame_time_s"),
        *BOX,
    )


def totals(evaluated: DataFrame) -> DataFrame:
    """Violation rows, detection rows and distinct tracks in one aggregate."""
    return evaluated.agg(
        F.count_if(F.col("violations") != "").alias("violation_rows"),
        F.count(F.lit(1)).alias("detection_rows"),
        F.count_distinct("video_id", "track_id").alias("distinct_tracks"),
    )
