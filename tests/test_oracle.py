"""Every SQL-checked key equals its DuckDB oracle on the small fixture."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from harness import compare, duckdb_connection
from roadlens.plans.catalog import spark_queries

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duckdb_connection(sf_dir)


def test_every_oracle_key_is_registered():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    assert compare(df, con, SQL[name]) is None


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "lat_cell", "lon_cell", "violation_count", "z_score",
        "Violation_Type", "violation_type_count", "hour", "hour_count",
    ]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(set(spark_queries()) - set(SQL)))
def test_rows_only_keys_run(spark, sf_dir, name):
    assert entry.queries()[name](spark, sf_dir).count() > 0
