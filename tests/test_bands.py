"""Band tables at every cut, cut +/- epsilon and NULL."""

import pytest
from pyspark.sql import functions as F

from stratum.functions import vocab as V
from stratum.functions.derive import band, bp_category, shift_code


def _labels(spark, values, expr_fn, dtype="double"):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr_fn(F.col("x"))).collect()]


def test_heart_rate(spark):
    vals = [39, 40, 59, 60, 100, 101, 150, 151, None]
    got = _labels(spark, vals, lambda c: band(c, V.HEART_RATE_BANDS, V.HEART_RATE_ELSE, "Unknown"))
    assert got == ["Severe Bradycardia", "Bradycardia", "Bradycardia", "Normal", "Normal",
                   "Tachycardia", "Tachycardia", "Severe Tachycardia", "Unknown"]


def test_temperature(spark):
    vals = [34.9, 35.0, 37.2, 37.3, 38.0, 40.0, 40.1]
    got = _labels(spark, vals, lambda c: band(c, V.TEMPERATURE_BANDS, V.TEMPERATURE_ELSE, "Unknown"))
    assert got == ["Hypothermia", "Normal", "Normal", "Low Grade Fever", "Low Grade Fever",
                   "High Fever", "Hyperpyrexia"]


def test_respiratory(spark):
    vals = [7, 8, 11, 12, 20, 21, 30, 31]
    got = _labels(spark, vals, lambda c: band(c, V.RESPIRATORY_BANDS, V.RESPIRATORY_ELSE, "Unknown"))
    assert got == ["Severe Bradypnea", "Bradypnea", "Bradypnea", "Normal", "Normal", "Tachypnea",
                   "Tachypnea", "Severe Tachypnea"]


def test_age_including_fractional_gap(spark):
    vals = [17, 18, 44, 45, 64, 65, 74, 75, 89, 90, 44.5, None]
    got = _labels(spark, vals, lambda c: band(c, V.AGE_BANDS, V.AGE_ELSE))
    assert got == ["Under 18", "18-44", "18-44", "45-64", "45-64", "65-74", "65-74", "75-89",
                   "75-89", "90+", "Unknown", "Unknown"]


def test_yield(spark):
    vals = [79.9, 80, 94.9, 95, None]
    got = _labels(spark, vals, lambda c: band(c, V.YIELD_BANDS, V.YIELD_ELSE, V.YIELD_UNKNOWN))
    assert got == ["Low", "Normal", "Normal", "High", "Unknown"]


def test_duration(spark):
    vals = [59, 60, 480, 481, None]
    got = _labels(spark, vals, lambda c: band(c, V.DURATION_BANDS, V.DURATION_ELSE, V.DURATION_ONGOING))
    assert got == ["SHORT", "MEDIUM", "MEDIUM", "LONG", "ONGOING"]


def test_shift(spark):
    df = spark.createDataFrame([(h,) for h in [5, 6, 13, 14, 21, 22]], "h int")
    ts = F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), F.col("h"), F.lit(0), F.lit(0))
    got = [r[0] for r in df.select(shift_code(ts)).collect()]
    assert got == ["Night", "Morning", "Morning", "Afternoon", "Afternoon", "Night"]


@pytest.mark.parametrize("s,d,label", [
    (69, 60, "Hypotensive"), (100, 39, "Hypotensive"), (119, 79, "Normal"), (125, 79, "Elevated"),
    (125, 80, "HTN Stage 1"), (180, 85, "HTN Stage 1"), (140, 90, "HTN Stage 2"),
    (None, 80, "Unknown"),
])
def test_blood_pressure(spark, s, d, label):
    df = spark.createDataFrame([(None if s is None else float(s), float(d))], "s double, d double")
    assert df.select(bp_category("s", "d")).first()[0] == label
