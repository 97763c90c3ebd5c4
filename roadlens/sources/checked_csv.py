"""CSV folders whose files need not agree.

Columns are found by the names in each file's header, whatever their order, and
nothing is lost silently: every line of the folder ends either in ``rows`` or in
``broken``, with its file and a reason.

* A file whose header lacks a wanted column, or repeats a name, is broken as a
  whole; this is known before any of its lines is parsed.
* A line with another number of fields than its header, or that can not be
  parsed, is broken by itself.

Headers are read by one scan of the text (a row per file comes back, as in
Spark's own file listing); files are then read by one CSV scan per layout.
Blank lines are skipped, columns that are not wanted are left out, a record is
one line (a quoted line break breaks it), and a folder without lines gives two
empty tables. A path that does not exist fails at once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.schemas import RAW_VIOLATIONS

BROKEN = "source_file string, raw_line string, reason string"
_CORRUPT = "_broken_line"


class CheckedCsv(NamedTuple):
    """``rows``: the wanted columns and ``source_file``; ``broken``: see ``BROKEN``."""

    rows: DataFrame
    broken: DataFrame


def _file() -> Column:
    return F.col("_metadata.file_path")


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """file, header (its first line that is not blank), columns (the names in it)."""
    lines = spark.read.text(path).select(
        "value", _file().alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("nth")
    )
    # a file's beginning is read by one task, in order
    first = lines.where((F.col("at") == 0) & (F.trim("value") != "")).groupBy("file").agg(F.min_by("value", "nth").alias("header"))
    names = F.transform(F.split(F.regexp_replace("header", "^﻿", ""), ","), lambda c: F.regexp_replace(F.trim(c), '^"|"$', ""))
    return first.select("file", "header", names.alias("columns"))


def header_fault(columns: list[str], wanted: list[str]) -> str | None:
    """Why a file with this header can not be read by name; None if it can."""
    missing = [c for c in wanted if c not in columns]
    if missing:
        return f"missing columns: {', '.join(missing)}"
    repeated = [c for c, n in Counter(columns).items() if n > 1]
    return f"repeated columns: {', '.join(repeated)}" if repeated else None


def _by_name(spark: SparkSession, files: list[str], columns: list[str], schema: T.StructType) -> CheckedCsv:
    layout = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _CORRUPT]])
    # with pruning the parser would not count the fields of a line
    options = {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "columnPruning": False}
    # Spark refuses plans (such as a count) that need the broken-line column alone: always true, and needs another one
    known = F.length(F.coalesce(F.col(f"`{columns[0]}`"), F.lit(""))) >= 0
    df = spark.read.schema(layout).options(**options).csv(files).where(known)
    whole = df.where(F.col(_CORRUPT).isNull())
    held = [F.col(f"`{f.name}`") if f.name in columns else F.lit(None) for f in schema.fields]
    rows = whole.select(*[c.try_cast(f.dataType).alias(f.name) for c, f in zip(held, schema.fields)], _file().alias("source_file"))
    read = sum((F.col(f"`{c}`").isNotNull().cast("int") for c in columns), F.lit(0))
    broken = df.where(F.col(_CORRUPT).isNotNull()).select(
        _file().alias("source_file"), F.col(_CORRUPT).alias("raw_line"), F.concat(F.lit("malformed line, fields read: "), read.cast("string")).alias("reason")
    )
    return CheckedCsv(rows, broken)


def _as_broken(spark: SparkSession, files: list[str], header: str, reason: str) -> DataFrame:
    lines = spark.read.text(files).where((F.col("value") != header) & (F.trim("value") != ""))
    return lines.select(_file().alias("source_file"), F.col("value").alias("raw_line"), F.lit(reason).alias("reason"))


def read_checked_csv(
    spark: SparkSession, path: str, schema: T.StructType = RAW_VIOLATIONS, required: Iterable[str] | None = None
) -> CheckedCsv:
    """The files under ``path`` read by the names of their headers.

    ``required`` columns (by default all) must be in a file; others may be
    missing and are null then. A value that is not of its type is null.
    """
    required = schema.names if required is None else list(required)
    layouts: dict[tuple, list[str]] = {}
    for r in file_headers(spark, path).collect():
        layouts.setdefault((r["header"], tuple(r["columns"])), []).append(r["file"])
    rows = [spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("source_file", T.StringType())]))]
    broken = [spark.createDataFrame([], BROKEN)]
    for (header, columns), files in sorted(layouts.items()):
        fault = header_fault(list(columns), required)
        if fault:
            broken.append(_as_broken(spark, files, header, fault))
            continue
        part = _by_name(spark, files, list(columns), schema)
        rows.append(part.rows)
        broken.append(part.broken)
    return CheckedCsv(*(reduce(DataFrame.unionByName, parts) for parts in (rows, broken)))
