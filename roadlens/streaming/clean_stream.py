"""Stateless cleaning on a file stream.

The batch operators are reused unchanged on ``readStream``. Each micro-batch
writes its good rows and its quarantine to two Parquet folders, one
sub-folder per batch id in overwrite mode, so a batch replayed after a
failure replaces its own output instead of duplicating it.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from roadlens.operators.clean import clean_violations, quarantine
from roadlens.schemas import RAW_VIOLATIONS
from roadlens.sources.readers import epoch_millis_as_text


def read_raw_stream(spark: SparkSession, path: str, fmt: str = "csv", max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_VIOLATIONS)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.format(fmt).load(path)
    return epoch_millis_as_text(stream) if fmt == "json" else stream


def clean_stream(raw_stream: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) streaming DataFrames from a raw violations stream."""
    return clean_violations(raw_stream), quarantine(raw_stream)


def start_clean_stream(
    spark: SparkSession,
    source: str,
    good_path: str,
    bad_path: str,
    checkpoint: str,
    fmt: str = "csv",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Clean ``source`` into two folders; ``checkpoint`` is the stream's own folder.

    A restart with the same ``checkpoint`` goes on where the stream stopped and
    repeats an unfinished batch under its old number.
    """
    raw = read_raw_stream(spark, source, fmt, max_files_per_trigger)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            clean_violations(batch).write.mode("overwrite").parquet(f"{good_path}/batch={batch_id}")
            quarantine(batch).write.mode("overwrite").parquet(f"{bad_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = raw.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
