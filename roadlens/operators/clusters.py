"""K-means over coordinates.

Violations repeat places, so rows are first reduced to distinct points with
a ``weight`` (a partial aggregate, skew-safe) and K-means is fitted with
``weightCol``: the objective and the Lloyd updates are the same as on the
full rows, while every iteration reads the compact, checkpointed point table
instead of re-running the whole lineage. Assignment of the full rows is a
per-row map (``model.transform``), and cluster sizes are weight sums.

A fixed seed does not make K-means independent of partitioning, so tests
check invariants (k labels, sizes sum to rows, each point nearest its
centre), not exact sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.session import cut_lineage

DEFAULT_COLS = ("Latitude", "Longitude")


def weighted_points(df: DataFrame, cols: Sequence[str] = DEFAULT_COLS) -> DataFrame:
    """Distinct non-null points with ``weight`` = number of rows at that point."""
    cols = list(cols)
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond).groupBy(*cols).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def fit_clusters(
    df: DataFrame,
    k: int = 5,
    seed: int = 42,
    cols: Sequence[str] = DEFAULT_COLS,
    max_iter: int = 20,
) -> PipelineModel:
    """Assemble ``cols`` and fit K-means (k-means||, euclidean) on weighted points (M1, M2)."""
    return fit_weighted(cut_lineage(weighted_points(df, cols)), k, seed, cols, max_iter)


def fit_weighted(
    points: DataFrame,
    k: int = 5,
    seed: int = 42,
    cols: Sequence[str] = DEFAULT_COLS,
    max_iter: int = 20,
) -> PipelineModel:
    """Fit on distinct points with a ``weight`` column; every iteration reads them, so they should be checkpointed."""
    pipeline = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(cols), outputCol="features"),
            KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features",
                   predictionCol="cluster", weightCol="weight"),
        ]
    )
    return pipeline.fit(points)


def weighted_cluster_counts(model: PipelineModel, points: DataFrame) -> DataFrame:
    """Rows per cluster from weighted points."""
    return model.transform(points).groupBy("cluster").agg(
        F.sum("weight").cast("bigint").alias("violation_count")
    )


def cluster_rows(model: PipelineModel, df: DataFrame, cols: Sequence[str] = DEFAULT_COLS) -> DataFrame:
    """Every row with valid coordinates and its ``cluster`` (M3)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return model.transform(df.filter(cond)).drop("features")


def cluster_counts(model: PipelineModel, df: DataFrame, cols: Sequence[str] = DEFAULT_COLS) -> DataFrame:
    """Rows per cluster, ``violation_count`` (G19), from the weighted points."""
    return weighted_cluster_counts(model, weighted_points(df, cols))


def cluster_centers(spark: SparkSession, model: PipelineModel,
                    cols: Sequence[str] = DEFAULT_COLS) -> DataFrame:
    """One row per centre (k rows, bounded by the parameter)."""
    km = model.stages[-1]
    rows = [(i, *[float(x) for x in c]) for i, c in enumerate(km.clusterCenters())]
    schema = T.StructType(
        [T.StructField("cluster", T.IntegerType(), False)]
        + [T.StructField(f"center_{c}", T.DoubleType(), False) for c in cols]
    )
    return spark.createDataFrame(rows, schema)


def fit_array_clusters(df: DataFrame, array_col: str, k: int = 5, seed: int = 42, max_iter: int = 20):
    """K-means over an ``array<float|double>`` column (e.g. embeddings).

    The vectors are checkpointed once so the iterations do not re-read and
    re-convert the source. Returns ``(model, vectors)``.
    """
    vectors = cut_lineage(
        df.filter(F.col(array_col).isNotNull()).select(array_to_vector(array_col).alias("features"))
    )
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cluster").fit(vectors)
    return model, vectors


def array_cluster_counts(df: DataFrame, array_col: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Rows per cluster for K-means over an array column."""
    model, vectors = fit_array_clusters(df, array_col, k, seed)
    return model.transform(vectors).groupBy("cluster").agg(F.count(F.lit(1)).alias("row_count"))
