"""Calendar gate: the reference's two assertions plus the shipped format."""

import datetime as dt

from pyspark.sql import Row
from pyspark.sql import functions as F

from stratum.operators.calendar import (gate, gate_dates, holiday_calendar, is_date_present,
                                        on_holidays, on_workdays, read_calendar)


def test_reference_fixture(spark):
    df = spark.createDataFrame([Row(Date="2024-03-29"), Row(Date="2024-05-23"), Row(Date="2024-10-12")])
    assert is_date_present(df, "2024-10-12") is True
    assert is_date_present(df, "2026-02-01") is False


def test_shipped_format_and_decision(spark):
    cal = holiday_calendar(spark)
    assert is_date_present(cal, "2024-01-26")
    row = gate(cal, "2024-01-26").first()
    assert (row.run_date, row.is_holiday, row.decision) == (dt.date(2024, 1, 26), True, "SKIP")
    assert gate(cal, "2024-01-27").first().decision == "RUN_MAIN"


def test_unparsable_dates_never_match(spark):
    cal = spark.createDataFrame([Row(Date="26-01-2024"), Row(Date="2024-10-12"), Row(Date="31-02-2024")])
    got = sorted(r[0] for r in gate_dates(
        spark.createDataFrame([(dt.date(2024, 1, 26),), (dt.date(2024, 10, 12),), (dt.date(2024, 3, 1),)],
                              "d date"), cal, F.col("d")).filter("is_holiday").collect())
    assert got == [dt.date(2024, 1, 26), dt.date(2024, 10, 12)]


def test_read_calendar_csv(spark, tmpdir_path):
    path = f"{tmpdir_path}/holidays.csv"
    with open(path, "w") as fh:
        fh.write("Date,Holiday Name\n26-01-2024,Republic Day\n25-12-2024,Christmas\n")
    cal = read_calendar(spark, path)
    assert is_date_present(cal, "2024-12-25")
    assert not is_date_present(cal, "2024-12-24")


def test_semi_anti_partition_rows(spark):
    cal = holiday_calendar(spark)
    ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 26, 10)), (2, dt.datetime(2024, 1, 27, 10)),
                                (3, None)], "id int, ts timestamp_ntz")
    hol = sorted(r.id for r in on_holidays(ev, cal, F.col("ts")).collect())
    work = sorted(r.id for r in on_workdays(ev, cal, F.col("ts")).collect())
    assert hol == [1] and work == [2, 3]
