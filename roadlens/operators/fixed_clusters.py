"""K-means with one answer (M1-M3, G19): the same for every partitioning and engine.

Spark ML adds doubles in the order of its partitions and starts from a sample of
them, so its centres differ from layout to layout (``clusters.py``). Here

* coordinates are whole numbers, ``floor((x + OFFSET) * SCALE + 0.5)``, weighted
  by the rows at that point;
* the start is the ``k`` distinct points with the smallest md5 of seed and
  coordinates (fewer points: fewer clusters);
* a Lloyd step assigns every point to the nearest centre (ties: the lower
  number) and moves a centre to the floor of the mean of its points, from sums
  in decimals; a centre without points stays. Steps end when no centre moves,
  at the latest after ``max_iter``.

A step is one grouped sum over the checkpointed distinct points; the driver sees
``k`` rows. Values must lie within ``OFFSET`` of zero.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.session import cut_lineage

SCALE = 1_000_000
OFFSET = 1_000
DEFAULT_COLS = ("Latitude", "Longitude")


@dataclass(frozen=True)
class FixedClusters:
    """Centres in whole-number units, by cluster number, over ``cols``."""

    cols: tuple[str, ...]
    centers: tuple[tuple[int, ...], ...]

    def nearest(self, units: Sequence[Column]) -> Column:
        """Number of the nearest centre (null where there is none)."""
        far = [sum(((u - F.lit(c)) * (u - F.lit(c)) for u, c in zip(units, center)), F.lit(0)) for center in self.centers]
        if not far:
            return F.lit(None).cast("int")
        return F.array_min(F.array(*[F.struct(d.alias("far"), F.lit(i).alias("cluster")) for i, d in enumerate(far)]))["cluster"]


def in_units(column: str) -> Column:
    return F.floor((F.col(column) + F.lit(float(OFFSET))) * F.lit(float(SCALE)) + F.lit(0.5)).cast("long")


def unit_points(df: DataFrame, cols: Sequence[str] = DEFAULT_COLS) -> DataFrame:
    """The written table of distinct points in units, with ``weight``, the rows at that point."""
    rows = df.dropna(subset=list(cols)).select(*[in_units(c).alias(c) for c in cols])
    return cut_lineage(rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("weight")))


def fit(points: DataFrame, k: int = 5, seed: int = 42, cols: Sequence[str] = DEFAULT_COLS, max_iter: int = 20) -> FixedClusters:
    """Centres from the points of ``unit_points``."""
    cols = tuple(cols)
    drawn = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))
    start = points.orderBy(drawn, *cols).limit(k).select(*cols).collect()
    centers = tuple(tuple(r) for r in start)
    for _ in range(max_iter):
        model = FixedClusters(cols, centers)
        exact = [F.sum(F.col(c).cast("decimal(19,0)") * F.col("weight").cast("decimal(19,0)")).alias(c) for c in cols]
        sums = points.groupBy(model.nearest([F.col(c) for c in cols]).alias("cluster")).agg(F.sum("weight").alias("n"), *exact).collect()
        moved = list(centers)
        for r in sums:
            moved[r["cluster"]] = tuple(int(r[c]) // int(r["n"]) for c in cols)
        if tuple(moved) == centers:
            break
        centers = tuple(moved)
    return FixedClusters(cols, centers)


def centers_table(spark: SparkSession, model: FixedClusters) -> DataFrame:
    """One row per centre, in the units of the data."""
    rows = [(i, *[round(u / SCALE - OFFSET, 6) for u in center]) for i, center in enumerate(model.centers)]
    fields = [T.StructField("cluster", T.IntegerType()), *[T.StructField(f"center_{c}", T.DoubleType()) for c in model.cols]]
    return spark.createDataFrame(rows, T.StructType(fields))


def counts(model: FixedClusters, points: DataFrame) -> DataFrame:
    """Rows per cluster, from the weighted points."""
    cluster = model.nearest([F.col(c) for c in model.cols]).alias("cluster")
    return points.groupBy(cluster).agg(F.sum("weight").alias("violation_count"))


def rows(model: FixedClusters, df: DataFrame) -> DataFrame:
    """Every row with coordinates and its ``cluster``."""
    return df.dropna(subset=list(model.cols)).withColumn("cluster", model.nearest([in_units(c) for c in model.cols]))
