"""Quarantine split partitions the input; metrics and census."""

from pyspark.sql import functions as F

from stratum.operators.quality import dq_metrics, label_census
from stratum.plans import silver as S
from stratum.sources.adapters import bronze

from small_tables import SF_SMALL


def test_order_split_partitions_input(spark):
    b = bronze(spark, SF_SMALL, "bronze_mfg_order")
    ok, bad = S.order_split(b)
    assert ok.count() + bad.count() == b.count()
    assert bad.filter(F.col("reject_reason").isNull()).count() == 0
    reasons = {r[0] for r in bad.select("reject_reason").distinct().collect()}
    assert reasons <= {"missing_required", "zero_qty", "invalid_dates", "null_key"}


def test_dq_metrics_bounds(spark):
    df = S.qc_flagged(bronze(spark, SF_SMALL, "bronze_qc_lab_result"))
    m = dq_metrics(df, S.QC_FLAGS).first().asDict()
    assert m["total_rows"] == df.count()
    assert m["clean_rows"] <= m["total_rows"]
    assert all(m[f"{f}_rows"] <= m["total_rows"] for f in S.QC_FLAGS)


def test_label_census(spark):
    df = spark.createDataFrame([("A", "x"), ("A", None), ("B", "x")], "a string, b string")
    got = sorted((r.column_name, r.label or "", r.row_count) for r in label_census(df, ["a", "b"]).collect())
    assert got == [("a", "A", 2), ("a", "B", 1), ("b", "", 1), ("b", "x", 2)]


def test_whitelist_after_null_flag(spark):
    df = S.qc_flagged(bronze(spark, SF_SMALL, "bronze_qc_lab_result"))
    # names that were NULL are flagged and also read UNKNOWN after the whitelist
    assert df.filter(F.col("hard_null_flag") & (F.col("test_name") != "UNKNOWN")).count() == 0
    assert df.filter(F.col("hard_null_flag")).count() > 0


def test_qc_pass_fail_within_total(spark):
    from stratum.plans import queries as Q
    bad = Q.q_qc_summary(spark, SF_SMALL).filter(
        (F.col("pass_count") + F.col("fail_count") > F.col("total_tests"))
        | (F.col("pass_pct") + F.col("fail_pct") > 100.01))
    assert bad.count() == 0
