"""Round-trip keys for sources and sinks.

Each builder writes the whole adapter table with a sink into a fresh folder
under ``spark.checkpoint.dir`` (shared storage on a cluster) and returns the
matching source's read of it; the oracle is the adapter text itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadlens.operators import aggregates as agg
from roadlens.operators import clean as cl
from roadlens.plans import violations as pv
from roadlens.plans.oracle import VIOLATIONS, with_views
from roadlens.schemas import LOCATION_TOTALS, RAW_VIOLATIONS
from roadlens.session import scratch_path
from roadlens.sinks import writers as w
from roadlens.sources import readers as r
from roadlens.streaming.clean_stream import start_clean_stream


def _csv(s: SparkSession, d: str) -> DataFrame:
    path = w.write_csv(pv.raw(s, d), scratch_path(s, "rt-csv"))
    return r.read_raw_csv(s, path)


def _csv_noheader(s, d):
    path = w.write_csv(pv.raw(s, d), scratch_path(s, "rt-csv-nh"), header=False)
    return r.read_result_csv(s, path, RAW_VIOLATIONS, header=False)


def _parquet(s, d):
    path = w.write_parquet(pv.raw(s, d), scratch_path(s, "rt-parquet"))
    return r.scan_parquet(s, path)


def _json(s, d):
    path = w.write_json(pv.raw(s, d), scratch_path(s, "rt-json"))
    return r.read_raw_json(s, path)


def _clean_csv(s, d):
    path = w.write_csv(cl.good_rows(pv.raw(s, d)), scratch_path(s, "rt-clean"))
    return r.read_clean_csv(s, path)


def _result(s, d):
    counts = agg.count_by(pv.clean(s, d), "Location", "Total_Violations")
    paths = w.write_result(counts, scratch_path(s, "rt-result"), ("csv", "parquet"))
    return r.read_result_csv(s, paths["csv"], LOCATION_TOTALS)


def _result_parquet(s, d):
    counts = agg.count_by(pv.clean(s, d), "Location", "Total_Violations")
    return r.scan_parquet(s, w.write_result(counts, scratch_path(s, "rt-result"), ("csv", "parquet"))["parquet"])


def _by_month(s, d):
    path = w.write_clean_by_month(pv.clean(s, d), scratch_path(s, "rt-month"))
    return s.read.parquet(path).drop("event_month")


def _quarantine(s, d):
    return r.scan_parquet(s, w.write_quarantine(cl.quarantine(pv.raw(s, d)), scratch_path(s, "rt-quarantine")))


def _stream(kept: bool):
    """A side of the cleaning stream over the raw rows as JSON Lines, run until its input is used up."""

    def build(s: SparkSession, d: str) -> DataFrame:
        source = w.write_json(pv.raw(s, d), scratch_path(s, "st-raw"))
        good, bad = scratch_path(s, "st-good"), scratch_path(s, "st-bad")
        start_clean_stream(s, source, good, bad, scratch_path(s, "st-check"), fmt="json").awaitTermination()
        return s.read.parquet(good if kept else bad).drop("batch")

    return build


SPARK = {
    "roundtrip_csv": _csv,
    "roundtrip_csv_noheader": _csv_noheader,
    "roundtrip_parquet": _parquet,
    "roundtrip_json": _json,
    "read_clean_csv": _clean_csv,
    "roundtrip_result": _result,
    "roundtrip_result_parquet": _result_parquet,
    "roundtrip_by_month": _by_month,
    "roundtrip_quarantine": _quarantine,
    "stream_clean": _stream(True),
    "stream_quarantine": _stream(False),
}

_ADAPTER = with_views("SELECT * FROM v", v=VIOLATIONS)

SQL = {
    "roundtrip_csv": _ADAPTER,
    "roundtrip_csv_noheader": _ADAPTER,
    "roundtrip_parquet": _ADAPTER,
    "roundtrip_json": _ADAPTER,
    "read_clean_csv": pv.SQL["good_rows"],
    "roundtrip_result": pv.SQL["by_location"],
    "roundtrip_result_parquet": pv.SQL["by_location"],
    "roundtrip_by_month": pv.SQL["clean"],
    "roundtrip_quarantine": pv.SQL["quarantine"],
    "stream_clean": pv.SQL["clean"],
    "stream_quarantine": pv.SQL["quarantine"],
}
