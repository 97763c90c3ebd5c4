"""Checked CSV folders, month deliveries, unlike parts and positions on awkward input."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.operators.positions import with_position
from roadlens.session import scratch_path
from roadlens.sinks import months
from roadlens.sources.checked_csv import read_checked_csv
from roadlens.sources.parts import read_parts

ABC = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()), T.StructField("c", T.StringType())])


def folder(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_every_line_ends_in_rows_or_broken(spark, tmp_path):
    path = folder(
        tmp_path,
        usual='a,b,c\n1,x,"p,q"\n2,y\n\n3,z,w,v\n"4,bad\n5,,\nsix,s,t\n',
        turned="\ufeffc, a ,extra,\"b\"\nC,9,E,B\n",
        short="a,b\n1,2\n3,4\n",
        twice="a,b,c,a\n1,2,3,4\n",
        bare="a,b,c\n",
        empty="",
    )
    out = read_checked_csv(spark, path, ABC)
    assert sorted(((r.a, r.b, r.c) for r in out.rows.collect()), key=str) == [(1, "x", "p,q"), (5, None, None), (9, "B", "C"), (None, "s", "t")]
    broken = {(r.source_file.rsplit("/", 1)[1], r.raw_line): r.reason for r in out.broken.collect()}
    assert {k: v.split(":")[0].split(",")[0] for k, v in broken.items()} == {
        ("usual.csv", "2,y"): "malformed line", ("usual.csv", "3,z,w,v"): "malformed line", ("usual.csv", '"4,bad'): "malformed line",
        ("short.csv", "1,2"): "missing columns", ("short.csv", "3,4"): "missing columns", ("twice.csv", "1,2,3,4"): "repeated columns",
    }
    assert out.rows.count() + out.broken.count() == 10  # also as bare counts
    loose = read_checked_csv(spark, path, ABC, required=())
    assert sorted((r.a, r.b) for r in loose.rows.where(F.col("source_file").endswith("short.csv")).collect()) == [(1, "2"), (3, "4")]


def test_large_file_is_read_in_several_tasks(spark, tmp_path):
    path = folder(tmp_path, long="c,b,a\n" + "".join(f"x{i},y,{i}\n" if i % 1000 else f"x{i},y\n" for i in range(60_000)))
    with_small = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        out = read_checked_csv(spark, path, ABC)
        assert out.rows.rdd.getNumPartitions() > 4
        assert out.rows.agg(F.count("a"), F.sum("a")).first() == (59_940, sum(i for i in range(60_000) if i % 1000)) and out.broken.count() == 60
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", with_small)


def test_checked_folder_without_files_or_missing(spark, tmp_path):
    out = read_checked_csv(spark, folder(tmp_path, empty="\n\n"), ABC)
    assert out.rows.columns == ["a", "b", "c", "source_file"] and out.rows.count() == 0 and out.broken.count() == 0
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_checked_csv(spark, str(tmp_path / "gone"), ABC)


def deliver(spark, path, manifest, label, rows):
    df = spark.createDataFrame(rows, "id long, t string").select("id", F.to_timestamp_ntz("t").alias("Timestamp"))
    months.ingest_months(df, path, manifest, label)


def test_a_delivery_replaces_its_months_only(spark):
    path, manifest = scratch_path(spark, "m-rows"), scratch_path(spark, "m-manifest")
    deliver(spark, path, manifest, "one", [(1, "2024-01-31 23:59:59"), (2, "2024-02-01 00:00:00"), (3, "2024-02-09 00:00:00"), (4, None)])
    deliver(spark, path, manifest, "two", [(5, "2024-02-03 00:00:00"), (6, "2024-03-01 00:00:00")])
    rows = months.read_months(spark, path, manifest)
    assert sorted((r.id, r.delivery) for r in rows.collect()) == [(1, "one"), (4, "one"), (5, "two"), (6, "two")]
    listed = {(str(r.event_month), r.delivery): r.rows for r in spark.read.parquet(manifest).collect()}
    assert listed == {("2024-01-01", "one"): 1, ("None", "one"): 1, ("2024-02-01", "two"): 1, ("2024-03-01", "two"): 1}
    assert months.manifest_faults(spark, path, manifest).count() == 0
    deliver(spark, path, manifest, "two", [(5, "2024-02-03 00:00:00"), (6, "2024-03-01 00:00:00")])  # run again
    assert sorted(r.id for r in months.read_months(spark, path, manifest).collect()) == [1, 4, 5, 6]


def test_rows_without_a_manifest_do_not_show(spark):
    path, manifest = scratch_path(spark, "m-rows"), scratch_path(spark, "m-manifest")
    deliver(spark, path, manifest, "one", [(1, "2024-01-01 00:00:00"), (2, "2024-02-01 00:00:00")])
    half = spark.createDataFrame([(9, "late", "2024-02-01")], "id long, delivery string, m string")
    half = half.select("id", F.to_timestamp_ntz("m").alias("Timestamp"), "delivery", F.to_date("m").alias("event_month"))
    months._replace_months(half, path)  # a delivery that ended before its manifest
    assert [r.id for r in months.read_months(spark, path, manifest).collect()] == [1]
    faults = {(str(r.event_month), r.delivery): (r.found, r.listed) for r in months.manifest_faults(spark, path, manifest).collect()}
    assert faults == {("2024-02-01", "late"): (1, None), ("2024-02-01", "one"): (None, 1)}


def test_unlike_parts(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "x.csv").write_text("c,a\nu,1\nv,no number\n")
    spark.createDataFrame([(1, "one")], "a long, b string").write.parquet(f"{tmp_path}/p")
    spark.createDataFrame([("C",)], "c string").write.mode("append").parquet(f"{tmp_path}/p")
    spark.createDataFrame([("7", "B")] * 2, "a string, b string").write.json(f"{tmp_path}/j")
    parts = {"csv": (f"{tmp_path}/csv", "csv"), "p": (f"{tmp_path}/p", "parquet"), "j": (f"{tmp_path}/j", "json"), "gone": (f"{tmp_path}/gone", "json")}
    out = read_parts(spark, parts, ABC)
    got = sorted(((r.part, r.a, r.b, r.c) for r in out.collect()), key=str)
    assert got == sorted([("csv", 1, None, "u"), ("csv", None, None, "v"), ("p", 1, "one", None), ("p", None, None, "C"), ("j", 7, "B", None), ("j", 7, "B", None)], key=str)
    assert out.where("source_file IS NULL").count() == 0
    none = read_parts(spark, {"gone": parts["gone"]}, ABC)
    assert none.columns == ["a", "b", "c", "source_file", "part"] and none.count() == 0


def test_positions_are_those_of_a_full_sort(spark):
    rows = [(i * 37 % 101, i) for i in range(3000)] + [(None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(7)
    out = with_position(df, F.col("k").desc_nulls_last(), F.col("v").asc())
    got = [(r.k, r.v) for r in sorted(out.collect(), key=lambda r: r.position)]
    assert got == sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1])) and {r.position for r in out.collect()} == set(range(1, 3003))
    assert with_position(df.where("k > 1000"), F.col("k")).collect() == []
