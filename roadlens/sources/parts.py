"""Result folders put together from unlike parts, with provenance."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.sources.checked_csv import read_checked_csv


def _read(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    if fmt == "csv":
        return read_checked_csv(spark, path, schema, required=()).rows
    if fmt == "parquet":
        df = spark.read.option("mergeSchema", True).parquet(path)
    else:
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        df = spark.read.schema(text).format(fmt).load(path)
    held = [F.col(f.name) if f.name in df.columns else F.lit(None) for f in schema.fields]
    cells = [c.try_cast(f.dataType).alias(f.name) for c, f in zip(held, schema.fields)]
    return df.select(*cells, F.col("_metadata.file_path").alias("source_file"))


def read_parts(spark: SparkSession, parts: Mapping[str, tuple[str, str]], schema: T.StructType) -> DataFrame:
    """The rows of all parts: the columns of ``schema``, ``part`` (its label) and ``source_file``.

    ``parts`` maps a label to (path, format: parquet, csv or json). Columns are
    found by name in whatever order a part has them; one that a part (or, in a
    Parquet folder, a file) lacks is null, one that ``schema`` lacks is left out,
    and a value that is not of its type is null. A folder that does not exist is
    an empty part. Repeated rows stay.
    """
    fields = [*schema.fields, T.StructField("source_file", T.StringType())]
    found = [spark.createDataFrame([], T.StructType(fields)).withColumn("part", F.lit(""))]
    for label, (path, fmt) in parts.items():
        try:
            found.append(_read(spark, path, fmt, schema).withColumn("part", F.lit(label)))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return reduce(DataFrame.unionByName, found)
