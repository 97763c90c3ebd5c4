"""The query catalog: every registered key, its Spark builder and oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadlens.plans import detections, files, io, ml, violations

Builder = Callable[[SparkSession, str], DataFrame]


def spark_queries() -> dict[str, Builder]:
    out: dict[str, Builder] = {}
    for module in _modules():
        out.update(module.SPARK)
    return out


def oracle_queries() -> dict[str, str]:
    out: dict[str, str] = {}
    for module in _modules():
        out.update(module.SQL)
    return out


def _modules():
    return [violations, detections, io, files, ml]
