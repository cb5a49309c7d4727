"""Holiday calendar gate and calendar membership joins.

The reference flow asks "is the run date a holiday?" and answers ``SKIP``
or ``RUN_MAIN``.  Here the answer is a DataFrame, and the same calendar
drives semi/anti joins that split dated rows into holiday and workday rows.

Calendar dates are parsed with ``try_to_date`` over several formats
(``dd-MM-yyyy`` as shipped, ISO as well), so an unparsable value becomes
NULL and never matches instead of failing the job under ANSI mode.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions import vocab as V
from stratum.functions.clean import col

CAL_DATE = "Date"
CAL_NAME = "Holiday Name"
HOLIDAY_DATE = "holiday_date"


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Read a calendar CSV (header row, inferred types)."""
    return spark.read.csv(path, header=True, inferSchema=True)


def holiday_calendar(spark: SparkSession, rows: Sequence[tuple[str, str]] = V.HOLIDAYS_2024) -> DataFrame:
    """The calendar shipped with the package, as a DataFrame."""
    schema = T.StructType([T.StructField(CAL_DATE, T.StringType()),
                           T.StructField(CAL_NAME, T.StringType())])
    return spark.createDataFrame(list(rows), schema)


def parse_date(c: str | Column, formats: Sequence[str] = V.CALENDAR_DATE_FORMATS) -> Column:
    """First format that parses wins; NULL when none does."""
    s = col(c).cast("string")
    return F.coalesce(*[F.try_to_date(s, f) for f in formats])


def holiday_dates(cal: DataFrame, date_col: str = CAL_DATE,
                  formats: Sequence[str] = V.CALENDAR_DATE_FORMATS) -> DataFrame:
    """Distinct parsed holiday dates (NULLs dropped)."""
    return (cal.select(parse_date(date_col, formats).alias(HOLIDAY_DATE))
               .filter(F.col(HOLIDAY_DATE).isNotNull())
               .distinct())


def _run_date(run_date: str | _dt.date | None) -> Column:
    if run_date is None:
        return F.current_date()
    if isinstance(run_date, _dt.date):
        return F.lit(run_date)
    return parse_date(F.lit(run_date), ["yyyy-MM-dd"] + [f for f in V.CALENDAR_DATE_FORMATS
                                                         if f != "yyyy-MM-dd"])


def decision(is_holiday: Column) -> Column:
    return F.when(is_holiday, F.lit(V.GATE_SKIP)).otherwise(F.lit(V.GATE_RUN))


def gate(cal: DataFrame, run_date: str | _dt.date | None = None, date_col: str = CAL_DATE) -> DataFrame:
    """One row: ``run_date``, ``is_holiday``, ``decision`` (SKIP / RUN_MAIN).

    ``run_date`` defaults to today's date (``current_date()``).
    """
    rd = _run_date(run_date)
    hits = holiday_dates(cal, date_col).agg(
        F.count_if(F.col(HOLIDAY_DATE) == rd).alias("__hits"))
    return hits.select(rd.alias("run_date"),
                       (F.col("__hits") > 0).alias("is_holiday"),
                       decision(F.col("__hits") > 0).alias("decision"))


def is_date_present(cal: DataFrame, run_date: str, date_col: str = CAL_DATE) -> bool:
    """Scalar form of the gate (a single aggregated row reaches the driver)."""
    return bool(gate(cal, run_date, date_col).first()["is_holiday"])


def gate_dates(dates: DataFrame, cal: DataFrame, date_expr: str | Column,
               date_col: str = CAL_DATE) -> DataFrame:
    """Gate decision for every distinct date produced by ``date_expr``."""
    runs = dates.select(col(date_expr).cast("date").alias("run_date")).distinct()
    # distinct dates: bounded by the date type (about 30 MB at the very most)
    hol = F.broadcast(holiday_dates(cal, date_col))
    j = runs.join(hol, runs["run_date"] == hol[HOLIDAY_DATE], "left")
    is_hol = F.col(HOLIDAY_DATE).isNotNull()
    return j.select("run_date", is_hol.alias("is_holiday"), decision(is_hol).alias("decision"))


def on_holidays(df: DataFrame, cal: DataFrame, date_expr: str | Column,
                date_col: str = CAL_DATE) -> DataFrame:
    """Rows of ``df`` whose date falls on a calendar holiday (semi join)."""
    return _membership(df, cal, date_expr, date_col, "left_semi")


def on_workdays(df: DataFrame, cal: DataFrame, date_expr: str | Column,
                date_col: str = CAL_DATE) -> DataFrame:
    """Rows of ``df`` whose date is not a holiday (anti join; a NULL date
    is not a holiday, so it is kept)."""
    return _membership(df, cal, date_expr, date_col, "left_anti")


def _membership(df: DataFrame, cal: DataFrame, date_expr, date_col: str, how: str) -> DataFrame:
    # distinct dates: bounded by the date type (about 30 MB at the very most)
    hol = F.broadcast(holiday_dates(cal, date_col))
    cond = col(date_expr).cast("date") == hol[HOLIDAY_DATE]
    return df.join(hol, cond, how)
