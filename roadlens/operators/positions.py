"""Global positions of sorted rows without a one-task window (L2, L3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.session import cut_lineage

# ``monotonically_increasing_id`` holds the partition above this bit and the row below it.
_ROW_BITS = 33


def with_position(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """The rows with their place, from 1, in the order of ``order``, which should tell rows apart.

    Rows are dealt out by ranges and sorted inside each, so a place is the
    rows of earlier ranges plus the row's number in its own. The dealt rows are
    checkpointed, as ranges are drawn anew by every run; the only window is
    over one row per range.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    dealt = cut_lineage(dealt).withColumn("_range", F.shiftright("_place", _ROW_BITS))
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    row = F.col("_place") - F.shiftleft("_range", _ROW_BITS)
    return dealt.join(offsets, "_range").withColumn(name, F.col("_offset") + row + 1).drop("_range", "_place", "_offset")
