"""Small helpers shared by the operators: table access, scratch tables, batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named input table, read with Spark (any file system)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage in a way that survives lost executors, and gives
    Catalyst the real size of the table: joins with it are broadcast only when
    the files are smaller than ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text"):
    """The text column with null read as the empty string."""
    return F.coalesce(F.col(column), F.lit(""))


def arrow_map(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]):
    """A ``mapInArrow`` function applying ``fn`` to every non-empty batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out

    return run


def small_slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` holding about ``max_bytes`` of ``column`` each (one row at least)."""
    values = batch.column(column)
    start, held = 0, 0
    for i in range(batch.num_rows):
        n = len(values[i].as_buffer()) if values[i].is_valid else 0
        if i > start and held + n > max_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def utf8_buffers(column: pa.Array):
    """``(bytes, offsets)`` of a string array, honouring slices; nulls have length 0."""
    import numpy as np

    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]
