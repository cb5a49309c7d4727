"""Plan-shape checks for the properties that matter at scale."""

from pyspark.sql import functions as F

from small_tables import SF_SMALL
from stratum.operators.changes import change_rows, merge_changes
from stratum.operators.dedup import latest_per_key
from stratum.plans import queries as Q
from stratum.sources.tables import read_source


def _plan(df, mode="formatted"):
    return df._jdf.queryExecution().toString() if mode == "all" else \
        df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_dedup_is_partial_aggregate_not_window(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = _plan(latest_per_key(df, ["k"], ["ts"]))
    assert "partial_max" in plan
    assert "Window" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(Q.q_lot_summary(spark, SF_SMALL))
    read = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert read and all("l_extendedprice" not in r and "l_discount" not in r and "l_tax" not in r
                        for r in read)


def test_calendar_side_is_broadcast(spark):
    plan = _plan(Q.q_rows_on_holidays(spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_filters_reach_the_scan(spark):
    for q in (Q.q_silver_dm, Q.q_upsert_lines):
        plan = _plan(q(spark, SF_SMALL))
        assert "PushedFilters: [Is" in plan or "PushedFilters: [Less" in plan or "PushedFilters: [Or" in plan
        assert "REPARTITION_BY_NUM" not in plan


def test_upsert_prunes_untouched_buckets(spark, tmpdir_path):
    from stratum.operators.upsert import BUCKET_COL, upsert_table
    path = f"{tmpdir_path}/t"
    upsert_table(spark, path, spark.range(2000).select(F.col("id").alias("k")), ["k"], buckets=16)
    before = {r[BUCKET_COL]: r["n"] for r in
              spark.read.parquet(path).groupBy(BUCKET_COL).agg(F.count("*").alias("n")).collect()}
    files_before = set(spark.read.parquet(path).inputFiles())
    upsert_table(spark, path, spark.createDataFrame([(7,)], "k long"), ["k"], buckets=16)
    files_after = set(spark.read.parquet(path).inputFiles())
    # exactly one bucket folder was rewritten; the others keep their files
    changed = {f.split(f"{BUCKET_COL}=")[1].split("/")[0] for f in files_before ^ files_after}
    assert len(changed) == 1 and sum(before.values()) == 2000


def test_snapshots_are_read_once(spark):
    plan = _plan(Q.q_latest_order_per_customer(spark, SF_SMALL), "simple")
    assert plan.count("FileScan") == 1
    df = read_source(spark, SF_SMALL, "orders")
    plan = _plan(change_rows(df, df.filter("o_orderkey > 9"), ["o_custkey"]), "simple")
    assert plan.count("FileScan") == 2 and "Join" not in plan
    # what a batch changes: only its own keys are looked up, nothing is joined in full
    plan = _plan(merge_changes(df, df.filter("o_orderkey > 9"), ["o_custkey"], ["o_orderdate"]), "simple")
    assert "FullOuter" not in plan and "LeftOuter" in plan
