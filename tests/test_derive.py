"""Derivation edge cases: ranges, guards, NULLs, grading."""

from pyspark.sql import functions as F

from stratum.functions import vocab as V
from stratum.functions.clean import decode, fill_or_trim, whitelist
from stratum.functions.derive import (classify_range, flag_any, grade, loss, parse_range, sla_days,
                                      variance)


def test_parse_range_tolerates_odd_strings(spark):
    df = spark.createDataFrame([("20.5 - 80",), ("<80",), ("-5-80",), (None,)], "r string")
    lo, hi = parse_range("r")
    got = [tuple(r) for r in df.select(lo, hi).collect()]
    assert got == [(20.5, 80.0), (None, None), (None, 5.0), (None, None)]


def test_classify_range_null_bound_is_normal(spark):
    df = spark.createDataFrame([(1.0, None, 5.0), (9.0, 2.0, 5.0), (3.0, 2.0, 5.0), (1.0, 2.0, None)],
                               "v double, lo double, hi double")
    got = [r[0] for r in df.select(classify_range("v", "lo", "hi")).collect()]
    assert got == ["NORMAL", "HIGH", "NORMAL", "LOW"]


def test_loss_guards(spark):
    df = spark.createDataFrame([(100.0, 90.0), (0.0, 5.0), (None, 5.0)], "i double, o double")
    qty, pct = loss("i", "o")
    got = [tuple(r) for r in df.select(qty, pct).collect()]
    assert got == [(10.0, 10.0), (-5.0, None), (None, None)]


def test_variance_and_zero_plan(spark):
    df = spark.createDataFrame([(103.0, 100.0), (5.0, 0.0)], "a double, p double")
    var, pct = variance("a", "p")
    assert [tuple(r) for r in df.select(var, pct).collect()] == [(3.0, 3.0), (5.0, None)]


def test_sla_and_grade(spark):
    df = spark.createDataFrame([("CRITICAL",), ("MAJOR",), ("MINOR",), ("TRIVIAL",), (None,)], "s string")
    assert [r[0] for r in df.select(sla_days("s")).collect()] == [3, 15, 30, 30, 30]
    m = spark.createDataFrame([(1, 0.0), (0, 31.0), (0, 16.0), (0, 15.0), (0, None)],
                              "critical_open_count long, sla_breach_rate_pct double")
    got = [r[0] for r in m.select(grade(V.CAPA_RISK_RULES, V.CAPA_RISK_ELSE)).collect()]
    assert got == ["Critical", "High", "Medium", "Low", "Low"]


def test_flag_any_null_rates_are_not_flagged(spark):
    df = spark.createDataFrame([(None, None), (21.0, None), (None, 31.0), (20.0, 30.0)], "a double, b double")
    got = [r[0] for r in df.select(flag_any([("a", 20), ("b", 30)])).collect()]
    assert got == [False, True, True, False]


def test_clean_helpers(spark):
    df = spark.createDataFrame([(" x ", "m", "PH"), (None, "F", "ph"), ("y", None, None)],
                               "t string, s string, n string")
    got = [tuple(r) for r in df.select(fill_or_trim("t", "NA"), decode("s", V.SEX_CODES, V.SEX_OTHER),
                                       whitelist(F.upper("n"), V.VALID_TEST_NAMES)).collect()]
    assert got == [("x", "Male", "PH"), ("NA", "Female", "PH"), ("y", "Other", "UNKNOWN")]
