"""Box geometry and speed as column expressions.

A box is a tuple of four integer columns ``(x1, y1, x2, y2)``. The helpers
build plain arithmetic with ``least``/``greatest`` so that joins on boxes
stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def box(prefix: str = "", alias: str | None = None) -> Box:
    """Columns ``x1..y2`` (optionally ``{alias}.`` qualified / ``prefix``-ed)."""
    q = f"{alias}." if alias else ""
    return tuple(F.col(f"{q}{prefix}{n}") for n in ("x1", "y1", "x2", "y2"))  # type: ignore[return-value]


def intersection_wh(a: Box, b: Box) -> tuple[Column, Column]:
    """Signed width and height of the intersection rectangle."""
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return w, h


def area(a: Box) -> Column:
    return F.greatest(F.lit(0), (a[2] - a[0]) * (a[3] - a[1]))


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0.0 when the union is empty."""
    w, h = intersection_wh(a, b)
    inter = F.greatest(F.lit(0), w) * F.greatest(F.lit(0), h)
    denom = area(a) + area(b) - inter
    return F.when(denom == 0, F.lit(0.0)).otherwise(inter.cast("double") / denom.cast("double"))


def overlaps(a: Box, b: Box) -> Column:
    """True when the boxes share a region of positive area (D3)."""
    w, h = intersection_wh(a, b)
    return (w > 0) & (h > 0)


def centroid_x(a: Box) -> Column:
    return (a[0] + a[2]).cast("double") / 2.0


def centroid_y(a: Box) -> Column:
    return (a[1] + a[3]).cast("double") / 2.0


def _number(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def kmph(dx: Column, dy: Column, frames_elapsed, fps, meters_per_pixel) -> Column:
    """Speed in km/h from a pixel displacement.

    ``frames_elapsed <= 0`` counts as one second, as in the reference.
    """
    frames = frames_elapsed if isinstance(frames_elapsed, Column) else F.lit(frames_elapsed)
    seconds = F.when(frames > 0, frames.cast("double") / _number(fps)).otherwise(1.0)
    meters = F.hypot(dx, dy) * _number(meters_per_pixel)
    return meters / seconds * 3.6
