"""Upsert algebra, NULL keys, schema drift, bucketed table, change rows."""

import os
import sys

import pytest
from pyspark.sql import functions as F

from stratum.operators.changes import CHANGE_COL, DELIVERY_COL, ChangeLog, change_rows, merge_changes, multiset_changes
from stratum.operators.dedup import latest_per_key
from stratum.operators.upsert import upsert, upsert_table


def _rows(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


def test_upsert_update_insert_and_idempotent(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "n", 1)], "k int, v string, ts int")
    s = spark.createDataFrame([(2, "B", 2), (2, "B0", 1), (3, "c", 2), (None, "m", 2)],
                              "k int, v string, ts int")
    once = upsert(t, s, ["k"], ["ts"])
    # k=2 updated to its latest source version, k=3 inserted, NULL keys never match
    assert {(r.k, r.v) for r in once.collect()} == {(1, "a"), (2, "B"), (3, "c"), (None, "n"), (None, "m")}
    # applying the same batch again changes nothing for keyed rows
    twice = upsert(once, s, ["k"], ["ts"])
    assert sorted((r.k or -1, r.v) for r in twice.filter("k is not null").collect()) == \
        sorted((r.k or -1, r.v) for r in once.filter("k is not null").collect())


def test_upsert_source_with_extra_column(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(2, "b", 9)], "k int, v string, extra int")
    out = {r.k: r.asDict() for r in upsert(t, s, ["k"]).collect()}
    assert out[1]["extra"] is None and out[2]["extra"] == 9


def test_latest_per_key_hot_key(spark):
    n = 5000
    df = spark.range(n).select(F.lit(7).alias("k"), F.col("id").alias("ts"), (F.col("id") % 3).alias("v"))
    df = df.unionByName(spark.createDataFrame([(8, 1, 1)], "k int, ts long, v long"))
    got = {r.k: (r.ts, r.v) for r in latest_per_key(df, ["k"], ["ts"]).collect()}
    assert got == {7: (n - 1, (n - 1) % 3), 8: (1, 1)}


def test_upsert_table_buckets(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    first = spark.range(100).select(F.col("id").alias("k"), F.lit("v0").alias("v"))
    upsert_table(spark, path, first, ["k"], buckets=8)
    batch = spark.createDataFrame([(5, "v1"), (500, "new")], "k long, v string")
    out = upsert_table(spark, path, batch, ["k"], buckets=8)
    d = {r.k: r.v for r in out.collect()}
    assert len(d) == 101 and out.count() == 101
    assert d[5] == "v1" and d[500] == "new" and d[6] == "v0"
    again = upsert_table(spark, path, batch, ["k"], buckets=8)
    assert again.count() == 101


def test_coarse_buckets_are_named(spark, tmpdir_path, monkeypatch):
    module = sys.modules[upsert_table.__module__]
    path = f"{tmpdir_path}/t"
    upsert_table(spark, path, spark.range(100).select(F.col("id").alias("k")), ["k"], buckets=2)
    monkeypatch.setattr(module, "LARGE_BUCKET", 100)
    with pytest.warns(UserWarning, match="more buckets"):
        upsert_table(spark, path, spark.range(3).select(F.col("id").alias("k")), ["k"], buckets=2)
    monkeypatch.setattr(module, "MAX_TOUCHED", 1)
    with pytest.raises(ValueError, match="touches 2 buckets"):
        upsert_table(spark, path, spark.range(90).select(F.col("id").alias("k")), ["k"], buckets=2)


def test_change_rows(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k int, v string")
    got = sorted((r._change_type, r.k, r.v) for r in change_rows(old, new, ["k"]).collect())
    assert got == [("delete", 3, "c"), ("insert", 4, "d"), ("update_postimage", 2, "B"),
                   ("update_preimage", 2, "b")]


def test_upsert_table_keeps_added_column(spark, tmpdir_path):
    path = f"{tmpdir_path}/evo"
    upsert_table(spark, path, spark.range(50).select(F.col("id").alias("k"), F.lit("a").alias("v")),
                 ["k"], buckets=8)
    # a batch with a new column touches some buckets only
    upsert_table(spark, path, spark.createDataFrame([(1, "b", 7)], "k long, v string, extra int"),
                 ["k"], buckets=8)
    # a later batch without the column must not drop it from the rewritten rows
    out = upsert_table(spark, path, spark.createDataFrame([(2, "c")], "k long, v string"), ["k"], buckets=8)
    rows = {r.k: r.asDict() for r in out.collect()}
    assert len(rows) == 50 and "extra" in out.columns
    assert rows[1]["extra"] == 7 and rows[1]["v"] == "b" and rows[2]["v"] == "c"


def test_change_log_of_upserts(spark, tmpdir_path):
    path, log = f"{tmpdir_path}/t", ChangeLog(spark, f"{tmpdir_path}/c")

    def load(rows, version, **more):
        upsert_table(spark, path, spark.createDataFrame(rows, "k long, v string, at int"), ["k"], ["at"], buckets=4,
                     changes=log.path, version=version, **more)

    def kept(first=None, last=None):
        return sorted((r[DELIVERY_COL], r[CHANGE_COL], r.k, r.v) for r in log.read(first, last).collect())

    load([(k, "a", 0) for k in range(6)], 0)
    assert kept() == [(0, "insert", k, "a") for k in range(6)]
    batch = [(1, "b", 1), (2, "a", 0), (3, "old", -1), (9, "new", 1)]
    load(batch, 1)
    want = [(1, "insert", 9, "new"), (1, "update_postimage", 1, "b"), (1, "update_preimage", 1, "a")]
    assert kept(1) == want
    files = set(log.read(1, 1).inputFiles())
    load(batch, 1)  # a replay
    assert kept(1) == want and set(log.read(1, 1).inputFiles()) == files
    # the writer dies after the change rows, before the table
    load([(4, "c", 2)], 2)
    table = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v").collect())
    os.remove(f"{tmpdir_path}/c__log/2.merged")
    load([(4, "c", 2)], 2)
    assert kept(2, 2) == [(2, "update_postimage", 4, "c"), (2, "update_preimage", 4, "a")]
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v").collect()) == table
    # a stamp alone is no change; a new column is
    load([(4, "stamp", 2)], 3, ignore=["v"])
    assert kept(3) == []
    upsert_table(spark, path, spark.createDataFrame([(5, "a", 0, 7)], "k long, v string, at int, extra int"), ["k"], ["at"], buckets=4,
                 changes=log.path, version=4)
    assert [(r[CHANGE_COL], r.extra) for r in log.read(4).orderBy(CHANGE_COL).collect()] == [("update_postimage", 7), ("update_preimage", None)]
    assert "__delivery" in str(log.read(1, 1)._jdf.queryExecution().executedPlan()).split("PartitionFilters")[1]


def test_change_log_refuses_another_stream(spark, tmpdir_path):
    log = ChangeLog(spark, f"{tmpdir_path}/c")
    log.claim("a")
    log.claim("a")
    with pytest.raises(ValueError, match="numbered by stream a"):
        log.claim("b")


def test_multiset_changes(spark):
    old = spark.createDataFrame([(1, "a")] * 3 + [(2, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, None), (2, None), (3, "c")], "k int, v string")
    got = sorted((r._change_type, r.k) for r in multiset_changes(old, new).collect())
    assert got == [("delete", 1), ("delete", 1), ("insert", 2), ("insert", 3)]


def test_upsert_shuffles_its_rows_once(spark, tmpdir_path, monkeypatch):
    """With parts of few rows too, change rows and table are those of the whole comparison; there is no second exchange."""
    module = sys.modules[upsert_table.__module__]
    monkeypatch.setattr(module, "PART_ROWS", 5)
    path, log = f"{tmpdir_path}/t", ChangeLog(spark, f"{tmpdir_path}/c")
    old = spark.range(60).selectExpr("IF(id % 10 = 0, NULL, id) AS k", "id % 3 AS at", "'a' AS v", "0 AS d")
    new = spark.range(30, 90).selectExpr("IF(id % 10 = 0, NULL, id) AS k", "id % 4 AS at", "IF(id % 2 = 0, 'a', 'b') AS v", "1 AS d")
    upsert_table(spark, path, old, ["k"], ["at"], buckets=2, delivery="d", changes=log.path, version=0, ignore=["d"])
    out = upsert_table(spark, path, new.unionByName(new.filter("k is not null")), ["k"], ["at"], buckets=2, delivery="d",
                       changes=log.path, version=1, ignore=["d"])
    want = upsert(old, new, ["k"], ["at"])
    assert _rows(out.drop("__b").filter("k is not null")) == _rows(want.filter("k is not null"))
    assert out.filter("k is null").count() == want.filter("k is null").count() == 12
    changed = merge_changes(old.filter("k is not null"), new, ["k"], ["at"], ignore=["d"])
    kept = lambda df: sorted(repr((r[CHANGE_COL], r.k, r.at, r.v)) for r in df.collect())
    assert kept(log.read(1)) == kept(changed)
    plan = module._latest(old.withColumn("__b", module.bucket_of(["k"], 2)), ["k"], ["at"], {1: 60})._jdf.queryExecution().executedPlan()
    assert str(plan).count("Exchange hashpartitioning") == 1 and "hashpartitioning(__b" in str(plan)


@pytest.mark.parametrize("logged", [False, True])
def test_many_rows_go_through_staged_buckets(spark, tmpdir_path, monkeypatch, logged):
    """Many rows are not shuffled but staged in buckets; table and change rows are those of the shuffled merge."""
    module = sys.modules[upsert_table.__module__]
    old = spark.range(600).selectExpr("IF(id % 10 = 0, NULL, id) AS k", "id % 3 AS at", "'a' AS v", "0 AS d")
    new = spark.range(300, 900).selectExpr("IF(id % 10 = 0, NULL, id) AS k", "id % 4 AS at", "IF(id % 2 = 0, 'a', 'b') AS v", "1 AS d", "id AS more")
    tables, changes = {}, {}
    for at, limit in (("shuffled", 10_000), ("staged", 1)):
        monkeypatch.setattr(module, "STAGED_ROWS", limit)
        monkeypatch.setattr(module, "STAGED_BUCKET_ROWS", 100)
        path, log = f"{tmpdir_path}/{at}", ChangeLog(spark, f"{tmpdir_path}/{at}_changes")
        kept = lambda n: {"changes": log.path, "version": n, "ignore": ["d"]} if logged else {}  # noqa: B023, E731
        upsert_table(spark, path, old.unionByName(old.filter("k is not null")), ["k"], ["at"], buckets=4, delivery="d", **kept(0))
        tables[at] = sorted(map(repr, upsert_table(spark, path, new.unionByName(new.filter("k % 7 = 0")), ["k"], ["at"], buckets=4,
                                                   delivery="d", **kept(1)).collect()))
        changes[at] = sorted(map(repr, log.read().collect())) if logged else []
    assert tables["staged"] == tables["shuffled"] and changes["staged"] == changes["shuffled"]
    before = [r.tableName for r in spark.sql("SHOW TABLES").collect()]
    sizes = {b: 150 for b in range(4)}
    plan = str(module._latest(old.withColumn("__b", module.bucket_of(["k"], 4)), ["k"], ["at"], sizes)._jdf.queryExecution().executedPlan())
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert [r.tableName for r in spark.sql("SHOW TABLES").collect()] == before
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "16"


def test_change_rows_and_table_come_from_one_pass(spark, tmpdir_path, monkeypatch):
    """Merged rows are written once: changes to the log, the others beside them until the table is written, to partitions
    of one size.  A writer that dies in between leaves nothing that a reader sees."""
    module = sys.modules[upsert_table.__module__]
    monkeypatch.setattr(module, "MANY_ROWS", 1)
    path, log = f"{tmpdir_path}/t", ChangeLog(spark, f"{tmpdir_path}/c")
    frame = lambda rows: spark.createDataFrame(rows, "k long, v string, at int, d int")
    load = lambda rows, n: upsert_table(spark, path, frame(rows), ["k"], ["at"], buckets=3, delivery="d",
                                        changes=log.path, version=n, ignore=["at", "d"])
    load([(k, "a", 0, 0) for k in range(20)] + [(None, "n", 0, 0)] * 2, 0)
    staged, finish = [], ChangeLog.finish

    def last(self, delivery):
        staged.append(self.after(delivery).select(CHANGE_COL).collect())
        finish(self, delivery)

    monkeypatch.setattr(ChangeLog, "finish", last)
    out = load([(k, "b" if k < 12 else "a", 1, 1) for k in range(10, 30)] + [(None, "m", 1, 1)], 1)
    assert len([r for r in staged[0] if r[0] is None]) == 8 + 10  # unchanged, by one side or both
    assert sorted((r.k, r.v, r.at) for r in out.collect() if r.k is not None) == \
        [(k, "a", 0) for k in range(10)] + [(k, "b" if k < 12 else "a", 1) for k in range(10, 30)]
    assert sorted(r.v for r in out.collect() if r.k is None) == ["m", "n", "n"]
    assert sorted((r[CHANGE_COL], r.k) for r in log.read(1).filter("k is not null").collect()) == \
        [("insert", k) for k in range(20, 30)] + [(f"update_{s}image", k) for s in ("post", "pre") for k in (10, 11)]
    assert sorted(n for n in os.listdir(log.path) if n.startswith(DELIVERY_COL)) == [f"{DELIVERY_COL}=0", f"{DELIVERY_COL}=1"]
    # the table was not written: its change rows are found, what they left is not seen and goes
    monkeypatch.setattr(ChangeLog, "finish", lambda self, delivery: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load([(0, "c", 2, 2), (1, "a", 2, 2)], 2)
    assert f"{DELIVERY_COL}=-3" in os.listdir(log.path) and log.read().filter(F.col(DELIVERY_COL) < 0).count() == 0
    monkeypatch.setattr(ChangeLog, "finish", finish)
    assert {r.k: r.v for r in load([(0, "c", 2, 2), (1, "a", 2, 2)], 2).collect()}[0] == "c"
    assert sorted((r[CHANGE_COL], r.v) for r in log.read(2).collect()) == [("update_postimage", "c"), ("update_preimage", "a")]
    assert f"{DELIVERY_COL}=-3" not in os.listdir(log.path)
    sizes = {b: 700 for b in range(3)}
    spread = module._spread(out.withColumn("__b", module.bucket_of(["k"], 3)), ["k"], sizes)
    assert "REPARTITION_BY_NUM" in str(spread._jdf.queryExecution().executedPlan())
    monkeypatch.setattr(module, "PART_ROWS", 50)
    wide = module._spread(spark.range(2100).select(F.col("id").alias("k")).withColumn("__b", module.bucket_of(["k"], 3)), ["k"], sizes)
    counts = [r["count"] for r in wide.groupBy(F.spark_partition_id()).count().collect()]
    assert len(counts) == 42 and max(counts) < 100
