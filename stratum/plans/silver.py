"""Silver cleaners V1-V8: bronze DataFrame -> silver DataFrame.

Pure functions: no I/O, no actions.  Each returns the silver projection
without the audit timestamp (``with_audit`` adds it at write time), so
results are deterministic and comparable.  Keyed tables (DM, QC,
deviation, order) are deduplicated on their business key with
``latest_per_key`` before they are merged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions import vocab as V
from stratum.functions.clean import decode, fill_label, fill_or_trim, normalize, require, whitelist
from stratum.functions.derive import (band, bp_category, classify_range, date_parts, days_between,
                                      flag, fulfillment, invalid_flag, loss, minutes_between,
                                      mismatch_flag,
                                      parse_range, quarter_label, shift_code, sla_days, variance,
                                      year_str)
from stratum.operators.dedup import latest_per_key
from stratum.operators.quality import accept, null_flag, split_rows

# Business keys of the upserted silver tables.
KEYS = {
    "dm": ["subject_id"],
    "qc": ["lot_id", "test_id"],
    "deviation": ["deviation_id"],
    "order": ["order_id"],
}


def with_audit(df: DataFrame, name: str = "silver_processed_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


#: Sees the rows with their quality flags as a cleaner passes them on.
Watch = Callable[[DataFrame], DataFrame] | None


def _watched(df: DataFrame, watch: Watch) -> DataFrame:
    return watch(df) if watch else df


def keyed(df: DataFrame, table: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per business key (latest by ``order``; ties by row values).
    Only QC rows can come without one: the other cleaners require theirs."""
    return latest_per_key(df, KEYS[table], order, keep_null_keys=table == "qc")


# ---- V4 QC lab results -----------------------------------------------------

QC_COLUMNS = ["batch_id", "lot_id", "test_id", "test_name", "test_value", "unit", "lower_spec",
              "upper_spec", "result_flag", "analyst_id", "test_year", "date_month", "test_quarter"]
QC_FLAGS = ["hard_null_flag", "test_value_null_flag", "spec_null_flag", "unit_null_flag"]


def qc_flagged(bronze: DataFrame) -> DataFrame:
    """QC rows with normalized labels, fills, date parts and the four
    quality flags.  The hard-null flag is taken before the test-name
    whitelist, so a missing name is flagged rather than hidden as UNKNOWN."""
    df = bronze.withColumns({
        "result_flag": normalize("result_flag", trim=False),
        "test_name": normalize("test_name", trim=False),
    })
    df = df.withColumn("hard_null_flag", null_flag(["batch_id", "lot_id", "test_id", "test_name"]))
    return df.withColumns({
        "test_name": whitelist("test_name", V.VALID_TEST_NAMES, V.UNKNOWN),
        "analyst_id": fill_label("analyst_id", V.QC_ANALYST_UNKNOWN),
        "result_flag": fill_label("result_flag", V.QC_RESULT_PENDING),
        "unit": F.trim("unit"),
        "test_value_null_flag": null_flag(["test_value"]),
        "spec_null_flag": null_flag(["lower_spec", "upper_spec"]),
        "unit_null_flag": null_flag(["unit"]),
        **date_parts("test_date", {"test_year": "year", "date_month": "date_month",
                                   "test_quarter": "quarter"}),
    })


def silver_qc(bronze: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    return keyed(qc_flagged(bronze).select(*QC_COLUMNS, *order), "qc", order).select(*QC_COLUMNS)


# ---- V8 manufacturing orders ----------------------------------------------

ORDER_COLUMNS = ["order_id", "batch_id", "drug_code", "planned_qty", "actual_qty", "start_date",
                 "end_date", "status", "priority", "created_by", "created_at", "date_month", "Year",
                 "order_quarter", "qty_variance", "qty_variance_pct", "fulfillment_status",
                 "planned_duration_days"]
ORDER_REQUIRED = ["start_date", "end_date", "actual_qty", "planned_qty"]


def order_checked(bronze: DataFrame) -> DataFrame:
    """Orders with normalized labels, derived measures and the two flags."""
    df = bronze.withColumns({
        "null_flag": null_flag(["batch_id", "order_id", "drug_code"]),
        "status": normalize("status", trim=False),
        "priority": normalize("priority", trim=False),
    })
    var, var_pct = variance("actual_qty", "planned_qty")
    return df.withColumns({
        "status": whitelist("status", V.VALID_ORDER_STATUS, V.UNKNOWN),
        "priority": whitelist("priority", V.VALID_ORDER_PRIORITY, V.UNKNOWN),
        "date_invalid_flag": flag(F.col("start_date") > F.col("end_date")),
        "date_month": F.date_format("start_date", "dd MMMM"),
        "Year": F.date_format("start_date", "yyyy"),
        "order_quarter": quarter_label("start_date"),
        "qty_variance": var,
        "qty_variance_pct": var_pct,
        "fulfillment_status": fulfillment("actual_qty", "planned_qty"),
        "planned_duration_days": days_between("start_date", "end_date"),
    })


# Ordered reject rules of the order feed: the first rule that fires names
# the reason.
ORDER_RULES = [
    ("missing_required", lambda: null_flag(ORDER_REQUIRED)),
    ("zero_qty", lambda: (F.col("actual_qty") == 0) | (F.col("planned_qty") == 0)),
    ("invalid_dates", lambda: F.col("date_invalid_flag")),
    ("null_key", lambda: F.col("null_flag")),
]


def order_split(bronze: DataFrame, carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(accepted silver rows, rejected rows with ``reject_reason``).

    ``carry`` names extra input columns kept on the accepted rows (e.g. the
    ingest batch id used to order versions of a key)."""
    ok, bad = split_rows(order_checked(bronze), [(n, p()) for n, p in ORDER_RULES])
    return ok.select(*ORDER_COLUMNS, *carry), bad


def silver_order(bronze: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    ok, _ = order_split(bronze, order)
    return keyed(ok, "order", order).select(*ORDER_COLUMNS)


# ---- V7 manufacturing lots ------------------------------------------------

LOT_COLUMNS = ["batch_id", "lot_id", "drug_code", "plant_id", "equipment_id", "process_step",
               "operator_id", "start_timestamp", "end_timestamp", "input_material_qty",
               "output_material_qty", "yield_percentage", "temperature_avg", "pressure_avg",
               "status", "deviation_flag", "created_at", "manufacture_month", "manufacture_year",
               "manufacture_quarter", "shift_code", "day_of_week", "material_loss_qty",
               "material_loss_pct", "yield_class", "batch_duration_minutes"]


def silver_lot(bronze: DataFrame,
               required: Sequence[str] = ("batch_id", "lot_id", "drug_code", "plant_id"),
               carry: Sequence[str] = ()) -> DataFrame:
    df = require(bronze, required).withColumnRenamed("manufacture_date", "start_timestamp")
    qty, pct = loss("input_material_qty", "output_material_qty")
    df = df.withColumns({
        "operator_id": fill_or_trim("operator_id", "UNKNOWN"),
        "equipment_id": fill_or_trim("equipment_id", "NOT_ASSIGNED"),
        "process_step": fill_or_trim("process_step", "UNKNOWN"),
        "deviation_flag": fill_label("deviation_flag", False),
        "manufacture_month": F.date_format("start_timestamp", "yyyy-MM"),
        "manufacture_year": year_str("start_timestamp"),
        "manufacture_quarter": quarter_label("start_timestamp"),
        "shift_code": shift_code("start_timestamp"),
        "day_of_week": F.date_format("start_timestamp", "EEEE"),
        "material_loss_qty": qty,
        "material_loss_pct": pct,
        "yield_class": band("yield_percentage", V.YIELD_BANDS, V.YIELD_ELSE, V.YIELD_UNKNOWN),
        "batch_duration_minutes": minutes_between("start_timestamp", "end_timestamp"),
    })
    return df.select(*LOT_COLUMNS, *carry)


# ---- V6 equipment log -----------------------------------------------------

EQUIPMENT_COLUMNS = ["equipment_id", "plant_id", "event_type", "event_start", "downtime_minutes",
                     "calibration_status", "operator_id", "remarks", "start_date_month",
                     "start_Year", "order_quarter", "end_date_month", "end_Year",
                     "event_duration_minutes", "event_duration_hours", "event_duration_category"]
EQUIPMENT_REQUIRED = ("equipment_id", "plant_id", "event_type", "event_start", "event_end",
                      "downtime_minutes", "calibration_status", "operator_id", "remarks")


#: The required columns when ongoing events, and unfilled labels, are kept.
EQUIPMENT_REQUIRED_OPEN = ("equipment_id", "plant_id", "event_type", "event_start")


def silver_equipment(bronze: DataFrame, required: Sequence[str] = EQUIPMENT_REQUIRED, carry: Sequence[str] = ()) -> DataFrame:
    """Equipment events.  ``order_quarter`` is the quarter of the event end
    (the end-date parts overwrite the start-date one)."""
    df = require(bronze, required)
    minutes = F.when(F.col("event_end").isNotNull(), minutes_between("event_start", "event_end"))
    df = df.withColumns({
        "operator_id": fill_label("operator_id", "SYSTEM"),
        "calibration_status": fill_label("calibration_status", "UNKNOWN"),
        "remarks": fill_or_trim("remarks", "NO_REMARKS"),
        "start_date_month": F.date_format("event_start", "dd MMMM"),
        "start_Year": F.date_format("event_start", "yyyy"),
        "end_date_month": F.date_format("event_end", "dd MMMM"),
        "end_Year": F.date_format("event_end", "yyyy"),
        "order_quarter": quarter_label("event_end"),
        "event_type": normalize("event_type"),
        "event_duration_minutes": minutes,
    })
    df = df.withColumns({
        "event_duration_hours": F.round(F.col("event_duration_minutes") / 60, 2),
        "event_duration_category": band("event_duration_minutes", V.DURATION_BANDS,
                                        V.DURATION_ELSE, V.DURATION_ONGOING),
    })
    return df.select(*EQUIPMENT_COLUMNS, *carry)


# ---- V5 deviations ----------------------------------------------------------

DEVIATION_COLUMNS = ["deviation_id", "batch_id", "equipment_id", "deviation_type", "severity",
                     "description", "root_cause", "corrective_action", "reported_by",
                     "reported_date", "closure_date", "status", "sla_days", "days_to_closure"]
DEVIATION_REQUIRED = ("deviation_id", "batch_id", "equipment_id", "deviation_type", "severity",
                      "description", "root_cause", "corrective_action", "reported_by",
                      "reported_date", "closure_date", "status")


#: The required columns when open deviations, and unfilled labels, are kept.
DEVIATION_REQUIRED_OPEN = ("deviation_id", "batch_id", "deviation_type", "severity", "reported_date", "status")


def deviation_clean(bronze: DataFrame, required: Sequence[str] = DEVIATION_REQUIRED,
                    carry: Sequence[str] = ()) -> DataFrame:
    df = require(bronze, required)
    df = df.withColumns({
        "reported_by": fill_or_trim("reported_by", "UNKNOWN"),
        "description": fill_or_trim("description", "NO_DESCRIPTION"),
        "equipment_id": fill_or_trim("equipment_id", "NOT_APPLICABLE"),
        "root_cause": fill_or_trim("root_cause", "UNDER_INVESTIGATION"),
        "corrective_action": fill_or_trim("corrective_action", "PENDING"),
        "sla_days": sla_days("severity"),
        "days_to_closure": F.when(F.col("closure_date").isNotNull(),
                                  days_between("reported_date", "closure_date")),
    })
    return df.select(*DEVIATION_COLUMNS, *carry)


def silver_deviation(bronze: DataFrame, required: Sequence[str] = DEVIATION_REQUIRED,
                     order: Sequence[str] = ()) -> DataFrame:
    return (keyed(deviation_clean(bronze, required, order), "deviation", order)
            .select(*DEVIATION_COLUMNS))


# ---- V1 clinical demographics --------------------------------------------

DM_REQUIRED = ("study_id", "subject_id", "site_id", "arm_group", "age", "sex", "Origin",
               "country", "enrollment_date")


DM_FLAGS = ["hard_null_flag", "invalid_arm_flag"]


def dm_clean(bronze: DataFrame, watch: Watch = None) -> DataFrame:
    df = require(bronze.withColumnRenamed("race", "Origin"), DM_REQUIRED)
    df = df.withColumns({
        "sex": decode("sex", V.SEX_CODES, V.SEX_OTHER),
        "enrollment_date_month": F.date_format("enrollment_date", "dd MMMM"),
        "enrollment_Year": F.date_format("enrollment_date", "yyyy"),
        "enrollment_quarter": quarter_label("enrollment_date"),
        "hard_null_flag": null_flag(["study_id", "subject_id", "arm_group", "site_id"]),
        "age_group": band("age", V.AGE_BANDS, V.AGE_ELSE),
        "arm_group": normalize("arm_group"),
    }).drop("age")
    df = df.withColumn("invalid_arm_flag", invalid_flag(~F.col("arm_group").isin(V.VALID_ARMS)))
    return accept(_watched(df, watch), DM_FLAGS).drop(*DM_FLAGS)


def silver_dm(bronze: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    return keyed(dm_clean(bronze), "dm", order)


def qc_rows(bronze: DataFrame, carry: Sequence[str] = (), watch: Watch = None) -> DataFrame:
    """QC silver projection before deduplication."""
    return _watched(qc_flagged(bronze), watch).select(*QC_COLUMNS, *carry)


# ---- V2 clinical labs -------------------------------------------------------

LB_COLUMNS = ["study_id", "subject_id", "test_name", "test_value", "test_date", "unit",
              "lower_range", "upper_range", "abnormal_flag", "test_date_month", "test_Year"]
LB_REQUIRED = ("study_id", "subject_id", "test_name", "test_value", "unit", "reference_range",
               "test_date", "abnormal_flag")


LB_FLAGS = ["abnormal_mismatch_flag"]


def lb_checked(bronze: DataFrame) -> DataFrame:
    lo, hi = parse_range("reference_range")
    df = require(bronze, LB_REQUIRED).withColumns({
        "abnormal_flag": normalize("abnormal_flag", trim=False),
        "test_date_month": F.date_format("test_date", "dd MMMM"),
        "test_Year": F.date_format("test_date", "yyyy"),
        "lower_range": lo,
        "upper_range": hi,
    })
    df = df.withColumn("derived_abnormal_flag",
                       classify_range("test_value", "lower_range", "upper_range"))
    return df.withColumn("abnormal_mismatch_flag",
                         mismatch_flag("abnormal_flag", "derived_abnormal_flag"))


def silver_lb(bronze: DataFrame, carry: Sequence[str] = (), watch: Watch = None) -> DataFrame:
    """Lab rows whose recorded flag agrees with the flag derived from the
    reference range."""
    return accept(_watched(lb_checked(bronze), watch), LB_FLAGS).select(*LB_COLUMNS, *carry)


def lb_mismatches(bronze: DataFrame) -> DataFrame:
    """The lab rows ``silver_lb`` drops, with the derived flag."""
    return (lb_checked(bronze).filter(F.col("abnormal_mismatch_flag"))
            .select(*LB_COLUMNS, "derived_abnormal_flag"))


# ---- V3 clinical vitals -----------------------------------------------------

VS_COLUMNS = ["study_id", "subject_id", "heart_rate", "systolic_bp", "visit_date", "diastolic_bp",
              "temperature", "respiratory_rate", "visit_date_month", "visit_Year", "temp_category",
              "rr_category", "bp_category", "heart_rate_category"]
VS_REQUIRED = ("study_id", "subject_id", "visit_date", "heart_rate", "systolic_bp", "diastolic_bp",
               "temperature", "respiratory_rate")


def silver_vs(bronze: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    df = require(bronze, VS_REQUIRED).withColumns({
        "visit_date_month": F.date_format("visit_date", "dd MMMM"),
        "visit_Year": F.date_format("visit_date", "yyyy"),
        "heart_rate_category": band("heart_rate", V.HEART_RATE_BANDS, V.HEART_RATE_ELSE,
                                    V.VITALS_UNKNOWN),
        "bp_category": bp_category("systolic_bp", "diastolic_bp"),
        "temp_category": band("temperature", V.TEMPERATURE_BANDS, V.TEMPERATURE_ELSE,
                              V.VITALS_UNKNOWN),
        "rr_category": band("respiratory_rate", V.RESPIRATORY_BANDS, V.RESPIRATORY_ELSE,
                            V.VITALS_UNKNOWN),
    })
    return df.select(*VS_COLUMNS, *carry)
