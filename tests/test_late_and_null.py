"""Versions that arrive late, NULL keys, changed bucketing, odd numbers."""

import pytest
from pyspark.sql import functions as F

from stratum.functions.rollup import mean, rsum
from stratum.operators.dedup import latest_per_key
from stratum.operators.changes import change_rows
from stratum.operators.upsert import upsert, upsert_table


def test_late_older_version_replaces_nothing(spark):
    old = spark.createDataFrame([(1, 5, "new"), (2, 1, "a")], "k int, ts int, v string")
    batch = spark.createDataFrame([(1, 2, "late"), (2, 1, "tie"), (3, 1, "b")], "k int, ts int, v string")
    got = {tuple(r) for r in upsert(old, batch, ["k"], ["ts"]).collect()}
    assert got == {(1, 5, "new"), (2, 1, "tie"), (3, 1, "b")}
    assert {r["v"] for r in upsert(old, batch, ["k"]).collect()} == {"late", "tie", "b"}


def test_late_version_through_the_table(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    upsert_table(spark, path, spark.createDataFrame([(1, 5)], "k int, ts int"), ["k"], ["ts"], buckets=4)
    out = upsert_table(spark, path, spark.createDataFrame([(1, 2)], "k int, ts int"), ["k"], ["ts"], buckets=4)
    assert [r["ts"] for r in out.collect()] == [5]


def test_other_bucketing_is_refused(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    rows = spark.range(20).withColumnRenamed("id", "k")
    upsert_table(spark, path, rows, ["k"], buckets=4)
    with pytest.raises(ValueError, match="bucketed"):
        upsert_table(spark, path, rows, ["k"], buckets=8)


def test_null_keys_in_change_rows(spark):
    old = spark.createDataFrame([(None, "x"), (None, "x"), (1, "a")], "k int, v string")
    assert change_rows(old, old, ["k"]).count() == 0
    new = spark.createDataFrame([(None, "x"), (None, "y"), (1, "a")], "k int, v string")
    got = sorted((r["_change_type"], r["v"]) for r in change_rows(old, new, ["k"]).collect())
    assert got == [("delete", "x"), ("insert", "y")]


def test_many_identical_null_keys(spark):
    df = spark.range(1000).select(F.lit(None).cast("int").alias("k"), F.lit(1).alias("v"))
    df = df.unionByName(spark.createDataFrame([(7, 1), (7, 2)], "k int, v int"))
    assert latest_per_key(df, ["k"], ["v"]).count() == 1001
    assert latest_per_key(df, ["k"], ["v"], keep_null_keys=False).collect() == [(7, 2)]


def test_odd_numbers_in_rollups(spark):
    df = spark.createDataFrame([(1, 1.0), (1, float("nan")), (2, 1e30), (2, 1e30), (3, 0.125), (3, None)], "g int, v double")
    got = {r["g"]: (r["m"], r["s"]) for r in df.groupBy("g").agg(mean("v", 2).alias("m"), rsum("v", 2).alias("s")).collect()}
    assert got[1][0] != got[1][0] and got[1][1] != got[1][1]
    assert got[2] == (1e30, 2e30)
    assert got[3] == (0.13, 0.13)
