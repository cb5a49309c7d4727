"""Layers by name, bucketed tables, metrics counted by the write."""

from pyspark.sql import functions as F
from small_tables import SF_SMALL

from stratum.plans import gold as G
from stratum.plans import jobs as J
from stratum.plans import silver as S
from stratum.sources.adapters import bronze
from stratum.sources.catalog import LayerCatalog
from stratum.sources.tables import Layout, write_batch


def _shuffles(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line], plan


def test_bucketed_facts_need_no_exchange(spark, tmpdir_path):
    cat = LayerCatalog(spark, Layout(f"{tmpdir_path}/it's"), "bucketed_")
    cat.create()
    cat.write_bucketed(S.silver_lb(bronze(spark, SF_SMALL, "bronze_clinical_lb")), "silver", "lb", G.SUBJECT_KEYS, 4)
    cat.write_bucketed(S.silver_vs(bronze(spark, SF_SMALL, "bronze_clinical_vs")), "silver", "vs", G.SUBJECT_KEYS, 4)
    cat.write_bucketed(S.silver_dm(bronze(spark, SF_SMALL, "bronze_clinical_dm")), "silver", "dm", G.SUBJECT_KEYS, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dm, lb, vs = (cat.table("silver", t) for t in ("dm", "lb", "vs"))
        mart = G.gold_subject_safety(G.subject_safety(dm, G.lb_per_subject(lb), G.vs_per_subject(vs)))
        shuffles, plan = _shuffles(mart)
        assert not shuffles and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_registered_tables(spark, tmpdir_path):
    lay = Layout(tmpdir_path)
    cat = LayerCatalog(spark, lay, "named_")
    cat.create()
    cat.create()
    write_batch(spark.range(5), lay.bronze("t"), 0)
    name = cat.register("bronze", "t")
    write_batch(spark.range(7), lay.bronze("t"), 1)
    assert spark.sql(f"SELECT count(*) FROM {name} WHERE __batch = 0").first()[0] == 5
    assert spark.table(cat.register("bronze", "t")).count() == 12
    spark.sql(f"DROP TABLE {name}")
    assert spark.read.parquet(lay.bronze("t")).count() == 12


def test_metrics_come_from_the_write(spark, tmpdir_path):
    lay = Layout(tmpdir_path)
    rows = bronze(spark, SF_SMALL, "bronze_clinical_lb")
    write_batch(rows, lay.bronze("clinical_lb"), 0)
    J.silver_job(spark, lay, "clinical_lb", metrics=True)
    row = spark.read.parquet(lay.metrics("clinical_lb")).first()
    checked = S.lb_checked(rows)
    assert row["total_rows"] == checked.count()
    assert row["abnormal_mismatch_flag_rows"] == checked.filter("abnormal_mismatch_flag").count() > 0
    lay = Layout(f"{tmpdir_path}/other")
    write_batch(rows, lay.bronze("clinical_lb"), 0)
    J.silver_job(spark, lay, "clinical_lb", metrics=True, changes=True)
    write_batch(rows.limit(10), lay.bronze("clinical_lb"), 1)
    J.silver_job(spark, lay, "clinical_lb", metrics=True, changes=True)
    kept = spark.read.parquet(lay.metrics("clinical_lb"))
    assert kept.count() == 2 and kept.agg(F.max("total_rows")).first()[0] == row["total_rows"]
