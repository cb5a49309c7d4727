"""Oracle SQL (DuckDB dialect) for the registered queries.

Each statement recomputes a query from the benchmark tables with plain SQL:
the bronze adapters as common table expressions (same text Spark runs),
then the silver and gold logic written out by hand.  Column names match
the Spark outputs; integer results are cast to the Spark types.
"""

from __future__ import annotations

from collections.abc import Sequence

from stratum.functions import vocab as V
from stratum.sources.adapters import adapter_sql


def _cte(name: str, view: str | None = None) -> str:
    """The bronze ``view`` (its own name if not given) as ``name``."""
    return f"{name} AS (\n{adapter_sql(view or name)}\n)"


def _required(cols: Sequence[str]) -> str:
    return "WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cols)


def _quoted(values: Sequence[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def R(e: str, s: int) -> str:
    """Spark's ``round(double, s)``: half-up on the shortest decimal form."""
    return f"CAST(round(CAST(CAST({e} AS VARCHAR) AS DECIMAL(38,18)), {s}) AS DOUBLE)"


def MEAN(e: str, s: int) -> str:
    """Exact ``round(avg(e), s)``, half-up, from the decimal(38,10) sum."""
    tot = f"CAST(sum(CAST({e} AS DECIMAL(38,10))) * 10000000000 AS HUGEINT)"
    den = f"(CAST(count({e}) AS HUGEINT) * {10 ** (10 - s)})"
    return (f"(CAST(sign({tot}) * ((abs({tot}) * 2 + {den}) // (2 * {den})) AS DOUBLE)"
            f" / {10 ** s}.0)")


def RSUM(e: str, s: int) -> str:
    """Exact ``round(sum(e), s)``, half-up."""
    return f"CAST(round(sum(CAST({e} AS DECIMAL(38,10))), {s}) AS DOUBLE)"


def CI(pred: str) -> str:
    return f"CAST(count_if({pred}) AS BIGINT)"


def RATE(num: str, den: str) -> str:
    return R(f"{num} / {den} * 100", 2)


def latest_sql(src: str, keys: Sequence[str], ordered: Sequence[str]) -> str:
    """Latest row per key: greatest by ``ordered`` (NULL lowest), rows with
    a NULL key passed through."""
    part = ", ".join(keys)
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ordered)
    has_null = " OR ".join(f"{k} IS NULL" for k in keys)
    return (f"SELECT * FROM (SELECT * FROM {src} WHERE NOT ({has_null})) "
            f"QUALIFY row_number() OVER (PARTITION BY {part} ORDER BY {order}) = 1\n"
            f"UNION ALL SELECT * FROM {src} WHERE {has_null}")


def _dm_sql(d: str) -> str:
    return f"strftime({d}, '%d %B')"


def _q(d: str) -> str:
    return f"concat(CAST(year({d}) AS VARCHAR), '-Q', CAST(quarter({d}) AS VARCHAR))"


# ---- silver CTE bodies ------------------------------------------------------------

QC_FLAGGED = f"""qc_flagged AS (
SELECT batch_id, lot_id, test_id,
       CASE WHEN upper(test_name) IN ({_quoted(V.VALID_TEST_NAMES)}) THEN upper(test_name) ELSE 'UNKNOWN' END AS test_name,
       test_value, trim(unit) AS unit, lower_spec, upper_spec,
       coalesce(upper(result_flag), 'PENDING') AS result_flag,
       coalesce(analyst_id, 'UNKNOWN') AS analyst_id,
       CAST(year(test_date) AS VARCHAR) AS test_year,
       {_dm_sql('test_date')} AS date_month,
       {_q('test_date')} AS test_quarter,
       (batch_id IS NULL OR lot_id IS NULL OR test_id IS NULL OR test_name IS NULL) AS hard_null_flag,
       (test_value IS NULL) AS test_value_null_flag,
       (lower_spec IS NULL OR upper_spec IS NULL) AS spec_null_flag,
       (unit IS NULL) AS unit_null_flag
FROM bronze_qc_lab_result)"""

QC_COLS = ["batch_id", "lot_id", "test_id", "test_name", "test_value", "unit", "lower_spec",
           "upper_spec", "result_flag", "analyst_id", "test_year", "date_month", "test_quarter"]

SILVER_QC = (QC_FLAGGED + ",\nqc_proj AS (SELECT " + ", ".join(QC_COLS) + " FROM qc_flagged),\n"
             "silver_qc AS (\n" + latest_sql("qc_proj", ["lot_id", "test_id"],
                                             [c for c in QC_COLS if c not in ("lot_id", "test_id")])
             + "\n)")

ORDER_CHECKED = f"""order_checked AS (
SELECT *,
       CASE WHEN start_date IS NULL OR end_date IS NULL OR actual_qty IS NULL OR planned_qty IS NULL THEN 'missing_required'
            WHEN actual_qty = 0 OR planned_qty = 0 THEN 'zero_qty'
            WHEN start_date > end_date THEN 'invalid_dates'
            WHEN batch_id IS NULL OR order_id IS NULL OR drug_code IS NULL THEN 'null_key'
       END AS reject_reason
FROM (
SELECT order_id, batch_id, drug_code, planned_qty, actual_qty, start_date, end_date,
       CASE WHEN upper(status) IN ({_quoted(V.VALID_ORDER_STATUS)}) THEN upper(status) ELSE 'UNKNOWN' END AS status,
       CASE WHEN upper(priority) IN ({_quoted(V.VALID_ORDER_PRIORITY)}) THEN upper(priority) ELSE 'UNKNOWN' END AS priority,
       created_by, created_at,
       {_dm_sql('start_date')} AS date_month,
       strftime(start_date, '%Y') AS "Year",
       {_q('start_date')} AS order_quarter,
       {R('actual_qty - planned_qty', 2)} AS qty_variance,
       {R(R('actual_qty - planned_qty', 2) + ' / planned_qty * 100', 2)} AS qty_variance_pct,
       CASE WHEN actual_qty > planned_qty THEN 'OK' WHEN actual_qty < planned_qty THEN 'UNDER PRODUCTION'
            ELSE 'ON TARGET' END AS fulfillment_status,
       CAST(date_diff('day', start_date, end_date) AS INTEGER) AS planned_duration_days
FROM bronze_mfg_order))"""

ORDER_COLS = ["order_id", "batch_id", "drug_code", "planned_qty", "actual_qty", "start_date",
              "end_date", "status", "priority", "created_by", "created_at", "date_month", '"Year"',
              "order_quarter", "qty_variance", "qty_variance_pct", "fulfillment_status",
              "planned_duration_days"]

SILVER_ORDER = (ORDER_CHECKED + ",\norder_ok AS (SELECT " + ", ".join(ORDER_COLS)
                + " FROM order_checked WHERE reject_reason IS NULL),\n"
                "silver_order AS (\n" + latest_sql("order_ok", ["order_id"],
                                                   [c for c in ORDER_COLS if c != "order_id"])
                + "\n)")

SILVER_LOT = f"""silver_lot AS (
SELECT batch_id, lot_id, drug_code, plant_id,
       coalesce(trim(equipment_id), 'NOT_ASSIGNED') AS equipment_id,
       coalesce(trim(process_step), 'UNKNOWN') AS process_step,
       coalesce(trim(operator_id), 'UNKNOWN') AS operator_id,
       manufacture_date AS start_timestamp, end_timestamp,
       input_material_qty, output_material_qty, yield_percentage, temperature_avg, pressure_avg, status,
       coalesce(deviation_flag, false) AS deviation_flag, created_at,
       strftime(manufacture_date, '%Y-%m') AS manufacture_month,
       CAST(year(manufacture_date) AS VARCHAR) AS manufacture_year,
       concat(CAST(year(manufacture_date) AS VARCHAR), '-Q', CAST(quarter(manufacture_date) AS VARCHAR)) AS manufacture_quarter,
       CASE WHEN hour(manufacture_date) BETWEEN 6 AND 13 THEN 'Morning'
            WHEN hour(manufacture_date) BETWEEN 14 AND 21 THEN 'Afternoon' ELSE 'Night' END AS shift_code,
       dayname(manufacture_date) AS day_of_week,
       CASE WHEN input_material_qty IS NOT NULL AND output_material_qty IS NOT NULL
            THEN input_material_qty - output_material_qty END AS material_loss_qty,
       CASE WHEN input_material_qty IS NOT NULL AND output_material_qty IS NOT NULL AND input_material_qty > 0
            THEN {R('(input_material_qty - output_material_qty) / input_material_qty * 100', 2)} END AS material_loss_pct,
       CASE WHEN yield_percentage IS NULL THEN 'Unknown' WHEN yield_percentage >= 95 THEN 'High'
            WHEN yield_percentage >= 80 THEN 'Normal' ELSE 'Low' END AS yield_class,
       (epoch(date_trunc('second', end_timestamp)) - epoch(date_trunc('second', manufacture_date))) / 60 AS batch_duration_minutes
FROM bronze_mfg_lot
WHERE batch_id IS NOT NULL AND lot_id IS NOT NULL AND drug_code IS NOT NULL AND plant_id IS NOT NULL)"""

def _equipment(required: Sequence[str]) -> str:
    return f"""silver_equipment AS (
SELECT equipment_id, plant_id, upper(trim(event_type)) AS event_type, event_start, downtime_minutes,
       coalesce(calibration_status, 'UNKNOWN') AS calibration_status,
       coalesce(operator_id, 'SYSTEM') AS operator_id,
       coalesce(trim(remarks), 'NO_REMARKS') AS remarks,
       strftime(event_start, '%d %B') AS start_date_month,
       strftime(event_start, '%Y') AS "start_Year",
       CAST(year(event_end) AS VARCHAR) || '-Q' || CAST(quarter(event_end) AS VARCHAR) AS order_quarter,
       strftime(event_end, '%d %B') AS end_date_month,
       strftime(event_end, '%Y') AS "end_Year",
       mins AS event_duration_minutes,
       {R('mins / 60', 2)} AS event_duration_hours,
       CASE WHEN mins IS NULL THEN 'ONGOING' WHEN mins < 60 THEN 'SHORT' WHEN mins <= 480 THEN 'MEDIUM'
            ELSE 'LONG' END AS event_duration_category
FROM (SELECT *, CASE WHEN event_end IS NOT NULL THEN
                (epoch(date_trunc('second', event_end)) - epoch(date_trunc('second', event_start))) / 60 END AS mins
      FROM bronze_mfg_equipment_lot
      {_required(required)}))"""


SILVER_EQUIPMENT = _equipment(["equipment_id", "plant_id", "event_type", "event_start", "event_end",
                               "downtime_minutes", "calibration_status", "operator_id", "remarks"])
SILVER_EQUIPMENT_ONGOING = _equipment(["equipment_id", "plant_id", "event_type", "event_start"])

DEV_COLS = ["deviation_id", "batch_id", "equipment_id", "deviation_type", "severity", "description",
            "root_cause", "corrective_action", "reported_by", "reported_date", "closure_date",
            "status", "sla_days", "days_to_closure"]

def _deviation(required: Sequence[str]) -> str:
    return f"""deviation_clean AS (
SELECT deviation_id, batch_id,
       coalesce(trim(equipment_id), 'NOT_APPLICABLE') AS equipment_id,
       deviation_type, severity,
       coalesce(trim(description), 'NO_DESCRIPTION') AS description,
       coalesce(trim(root_cause), 'UNDER_INVESTIGATION') AS root_cause,
       coalesce(trim(corrective_action), 'PENDING') AS corrective_action,
       coalesce(trim(reported_by), 'UNKNOWN') AS reported_by,
       reported_date, closure_date, status,
       CASE WHEN severity = 'CRITICAL' THEN 3 WHEN severity = 'MAJOR' THEN 15
            WHEN severity = 'MINOR' THEN 30 ELSE 30 END AS sla_days,
       CASE WHEN closure_date IS NOT NULL THEN CAST(date_diff('day', reported_date, closure_date) AS INTEGER) END
           AS days_to_closure
FROM bronze_mfg_deviation
{_required(required)}),
silver_deviation AS (
""" + latest_sql("deviation_clean", ["deviation_id"], DEV_COLS[1:]) + "\n)"


SILVER_DEVIATION = _deviation(["deviation_id", "batch_id", "equipment_id", "deviation_type", "severity", "description",
                               "root_cause", "corrective_action", "reported_by", "reported_date", "closure_date",
                               "status"])
SILVER_DEVIATION_OPEN = _deviation(["deviation_id", "batch_id", "deviation_type", "severity", "reported_date", "status"])

DM_COLS = ["study_id", "subject_id", "site_id", "arm_group", "sex", "Origin", "country",
           "enrollment_date", "enrollment_date_month", "enrollment_Year", "enrollment_quarter",
           "age_group"]

SILVER_DM = f"""dm_clean AS (
SELECT study_id, subject_id, site_id, upper(trim(arm_group)) AS arm_group,
       CASE WHEN upper(sex) = 'M' THEN 'Male' WHEN upper(sex) = 'F' THEN 'Female' ELSE 'Other' END AS sex,
       race AS "Origin", country, enrollment_date,
       strftime(enrollment_date, '%d %B') AS enrollment_date_month,
       strftime(enrollment_date, '%Y') AS "enrollment_Year",
       concat(CAST(year(enrollment_date) AS VARCHAR), '-Q', CAST(quarter(enrollment_date) AS VARCHAR)) AS enrollment_quarter,
       CASE WHEN age < 18 THEN 'Under 18' WHEN age BETWEEN 18 AND 44 THEN '18-44'
            WHEN age BETWEEN 45 AND 64 THEN '45-64' WHEN age BETWEEN 65 AND 74 THEN '65-74'
            WHEN age BETWEEN 75 AND 89 THEN '75-89' WHEN age >= 90 THEN '90+' ELSE 'Unknown' END AS age_group
FROM bronze_clinical_dm
WHERE study_id IS NOT NULL AND subject_id IS NOT NULL AND site_id IS NOT NULL AND arm_group IS NOT NULL
  AND age IS NOT NULL AND sex IS NOT NULL AND race IS NOT NULL AND country IS NOT NULL
  AND enrollment_date IS NOT NULL
  AND coalesce(upper(trim(arm_group)) IN ({_quoted(V.VALID_ARMS)}), false)),
silver_dm AS (
""" + latest_sql("dm_clean", ["subject_id"], [c for c in DM_COLS if c != "subject_id"]) + "\n)"

LB_CHECKED = """lb_checked AS (
SELECT *, CASE WHEN test_value < lower_range THEN 'LOW' WHEN test_value > upper_range THEN 'HIGH'
               ELSE 'NORMAL' END AS derived_abnormal_flag
FROM (SELECT study_id, subject_id, test_name, test_value, test_date, unit,
             TRY_CAST(string_split(reference_range, '-')[1] AS DOUBLE) AS lower_range,
             TRY_CAST(string_split(reference_range, '-')[2] AS DOUBLE) AS upper_range,
             upper(abnormal_flag) AS abnormal_flag,
             strftime(test_date, '%d %B') AS test_date_month,
             strftime(test_date, '%Y') AS "test_Year"
      FROM bronze_clinical_lb
      WHERE study_id IS NOT NULL AND subject_id IS NOT NULL AND test_name IS NOT NULL AND test_value IS NOT NULL
        AND unit IS NOT NULL AND reference_range IS NOT NULL AND test_date IS NOT NULL
        AND abnormal_flag IS NOT NULL))"""

LB_COLS = ["study_id", "subject_id", "test_name", "test_value", "test_date", "unit", "lower_range",
           "upper_range", "abnormal_flag", "test_date_month", '"test_Year"']

SILVER_LB = (LB_CHECKED + ",\nsilver_lb AS (SELECT " + ", ".join(LB_COLS)
             + " FROM lb_checked WHERE NOT coalesce(abnormal_flag <> derived_abnormal_flag, false))")

SILVER_VS = """silver_vs AS (
SELECT study_id, subject_id, heart_rate, systolic_bp, visit_date, diastolic_bp, temperature, respiratory_rate,
       strftime(visit_date, '%d %B') AS visit_date_month,
       strftime(visit_date, '%Y') AS "visit_Year",
       CASE WHEN temperature IS NULL THEN 'Unknown' WHEN temperature < 35.0 THEN 'Hypothermia'
            WHEN temperature <= 37.2 THEN 'Normal' WHEN temperature <= 38.0 THEN 'Low Grade Fever'
            WHEN temperature <= 40.0 THEN 'High Fever' ELSE 'Hyperpyrexia' END AS temp_category,
       CASE WHEN respiratory_rate IS NULL THEN 'Unknown' WHEN respiratory_rate < 8 THEN 'Severe Bradypnea'
            WHEN respiratory_rate < 12 THEN 'Bradypnea' WHEN respiratory_rate <= 20 THEN 'Normal'
            WHEN respiratory_rate <= 30 THEN 'Tachypnea' ELSE 'Severe Tachypnea' END AS rr_category,
       CASE WHEN systolic_bp IS NULL OR diastolic_bp IS NULL THEN 'Unknown'
            WHEN systolic_bp < 70 OR diastolic_bp < 40 THEN 'Hypotensive'
            WHEN systolic_bp < 120 AND diastolic_bp < 80 THEN 'Normal'
            WHEN systolic_bp < 130 AND diastolic_bp < 80 THEN 'Elevated'
            WHEN systolic_bp < 140 OR diastolic_bp < 90 THEN 'HTN Stage 1'
            WHEN systolic_bp >= 140 OR diastolic_bp >= 90 THEN 'HTN Stage 2'
            ELSE 'HTN Crisis' END AS bp_category,
       CASE WHEN heart_rate IS NULL THEN 'Unknown' WHEN heart_rate < 40 THEN 'Severe Bradycardia'
            WHEN heart_rate < 60 THEN 'Bradycardia' WHEN heart_rate <= 100 THEN 'Normal'
            WHEN heart_rate <= 150 THEN 'Tachycardia' ELSE 'Severe Tachycardia' END AS heart_rate_category
FROM bronze_clinical_vs
WHERE study_id IS NOT NULL AND subject_id IS NOT NULL AND visit_date IS NOT NULL AND heart_rate IS NOT NULL
  AND systolic_bp IS NOT NULL AND diastolic_bp IS NOT NULL AND temperature IS NOT NULL
  AND respiratory_rate IS NOT NULL)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


QC = _with(_cte("bronze_qc_lab_result"), SILVER_QC)
ORDER = _with(_cte("bronze_mfg_order"), SILVER_ORDER)
LOT = _with(_cte("bronze_mfg_lot"), SILVER_LOT)
EQUIP = _with(_cte("bronze_mfg_equipment_lot"), SILVER_EQUIPMENT)
EQUIP_ONGOING = _with(_cte("bronze_mfg_equipment_lot", "bronze_mfg_equipment_ongoing"), SILVER_EQUIPMENT_ONGOING)
DEV_OPEN = _with(_cte("bronze_mfg_deviation", "bronze_mfg_deviation_open"), SILVER_DEVIATION_OPEN)
DEV = _with(_cte("bronze_mfg_deviation"), SILVER_DEVIATION)
DM = _with(_cte("bronze_clinical_dm"), SILVER_DM)
LB = _with(_cte("bronze_clinical_lb"), SILVER_LB)
VS = _with(_cte("bronze_clinical_vs"), SILVER_VS)

_ABN = f"abnormal_flag NOT IN ({_quoted(V.LAB_NORMAL_LABELS)})"
LB_PER_SUBJECT = f"""lb_ps AS (
SELECT subject_id, study_id,
       count(test_name) AS total_lab_tests,
       {CI(_ABN)} AS abnormal_lab_count,
       {MEAN('test_value', 2)} AS avg_lab_value,
       count(DISTINCT test_name) AS distinct_tests,
       count(DISTINCT test_date_month) AS lab_visit_months,
       {RATE(f'count_if({_ABN})', 'count(test_name)')} AS abnormal_lab_rate_pct
FROM silver_lb GROUP BY subject_id, study_id)"""

_CONCERN = ("heart_rate_category <> 'Normal' OR bp_category <> 'Normal' OR temp_category <> 'Normal'"
            " OR rr_category <> 'Normal'")
VS_PER_SUBJECT = f"""vs_ps AS (
SELECT subject_id, study_id,
       count(visit_date_month) AS total_vs_visits,
       {CI(_CONCERN)} AS concern_visit_count,
       {MEAN('heart_rate', 2)} AS avg_heart_rate,
       {MEAN('systolic_bp', 2)} AS avg_systolic_bp,
       {MEAN('diastolic_bp', 2)} AS avg_diastolic_bp,
       {MEAN('temperature', 2)} AS avg_temperature,
       {RATE(f'count_if({_CONCERN})', 'count(visit_date_month)')} AS vs_concern_rate_pct
FROM silver_vs GROUP BY subject_id, study_id)"""

SAFETY = """safety AS (
SELECT dm.*, lb_ps.total_lab_tests, lb_ps.abnormal_lab_count, lb_ps.avg_lab_value, lb_ps.distinct_tests,
       lb_ps.lab_visit_months, lb_ps.abnormal_lab_rate_pct,
       vs_ps.total_vs_visits, vs_ps.concern_visit_count, vs_ps.avg_heart_rate, vs_ps.avg_systolic_bp,
       vs_ps.avg_diastolic_bp, vs_ps.avg_temperature, vs_ps.vs_concern_rate_pct
FROM silver_dm dm
LEFT JOIN lb_ps ON dm.subject_id = lb_ps.subject_id AND dm.study_id = lb_ps.study_id
LEFT JOIN vs_ps ON dm.subject_id = vs_ps.subject_id AND dm.study_id = vs_ps.study_id)"""

CLINICAL = _with(_cte("bronze_clinical_dm"), _cte("bronze_clinical_lb"), _cte("bronze_clinical_vs"),
                 SILVER_DM, SILVER_LB, SILVER_VS, LB_PER_SUBJECT, VS_PER_SUBJECT, SAFETY)

FLAG = "coalesce(abnormal_lab_rate_pct > 20 OR vs_concern_rate_pct > 30, false)"

CAL_VALUES = ", ".join(f"('{d}', '{n}')" for d, n in V.HOLIDAYS_2024)
HOLIDAYS = f"""cal AS (SELECT * FROM (VALUES {CAL_VALUES}) AS t("Date", "Holiday Name")),
hol AS (SELECT DISTINCT CAST(coalesce(try_strptime("Date", '%d-%m-%Y'), try_strptime("Date", '%Y-%m-%d')) AS DATE)
            AS holiday_date
        FROM cal
        WHERE coalesce(try_strptime("Date", '%d-%m-%Y'), try_strptime("Date", '%Y-%m-%d')) IS NOT NULL)"""

LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
              "l_tax", "l_returnflag", "l_linestatus"]
LINES = f"""first_load AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-07-01'),
batch AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-07-01' OR l_shipdate IS NULL),
tbl AS ({latest_sql('first_load', ['l_orderkey', 'l_linenumber'], LINE_ORDER)}),
src AS ({latest_sql('batch', ['l_orderkey', 'l_linenumber'], LINE_ORDER)}),
merged AS (SELECT * FROM tbl t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.l_orderkey = t.l_orderkey
                                                   AND s.l_linenumber = t.l_linenumber)
           UNION ALL SELECT * FROM src)"""


def _change_rows_sql() -> str:
    o = ", ".join(f"o.{c} AS o_{c}" for c in LINE_COLS)
    n = ", ".join(f"n.{c} AS n_{c}" for c in LINE_COLS)
    same = " AND ".join(f"o_{c} IS NOT DISTINCT FROM n_{c}" for c in LINE_COLS
                        if c not in ("l_orderkey", "l_linenumber"))
    ocols = ", ".join(f"o_{c} AS {c}" for c in LINE_COLS)
    ncols = ", ".join(f"n_{c} AS {c}" for c in LINE_COLS)
    return (f"WITH {LINES},\nj AS (SELECT {o}, {n}, coalesce(o.mark, false) AS has_o,"
            f" coalesce(n.mark, false) AS has_n\n"
            f"       FROM (SELECT *, true AS mark FROM tbl) o FULL OUTER JOIN (SELECT *, true AS mark FROM merged) n\n"
            f"       ON o.l_orderkey = n.l_orderkey AND o.l_linenumber = n.l_linenumber)\n"
            f"SELECT 'insert' AS _change_type, {ncols} FROM j WHERE NOT has_o\n"
            f"UNION ALL SELECT 'delete' AS _change_type, {ocols} FROM j WHERE NOT has_n\n"
            f"UNION ALL SELECT 'update_preimage' AS _change_type, {ocols} FROM j WHERE has_o AND has_n AND NOT ({same})\n"
            f"UNION ALL SELECT 'update_postimage' AS _change_type, {ncols} FROM j WHERE has_o AND has_n AND NOT ({same})")


_QC_PASS, _QC_FAIL = "result_flag = 'PASS'", "result_flag = 'FAIL'"

ORACLE: dict[str, str] = {
    "silver_qc": QC + "SELECT * FROM silver_qc",
    "silver_order": ORDER + "SELECT * FROM silver_order",
    "silver_lot": LOT + "SELECT * FROM silver_lot",
    "silver_equipment": EQUIP + "SELECT * FROM silver_equipment",
    "silver_deviation": DEV + "SELECT * FROM silver_deviation",
    "silver_deviation_open": DEV_OPEN + "SELECT * FROM silver_deviation",
    "silver_equipment_ongoing": EQUIP_ONGOING + "SELECT * FROM silver_equipment",
    "silver_dm": DM + "SELECT * FROM silver_dm",
    "silver_lb": LB + "SELECT * FROM silver_lb",
    "silver_vs": VS + "SELECT * FROM silver_vs",
    "lb_mismatches": _with(_cte("bronze_clinical_lb"), LB_CHECKED)
    + "SELECT " + ", ".join(LB_COLS) + ", derived_abnormal_flag FROM lb_checked"
      " WHERE coalesce(abnormal_flag <> derived_abnormal_flag, false)",
    "dq_metrics_qc": _with(_cte("bronze_qc_lab_result"), QC_FLAGGED) + f"""SELECT
       count(*) AS total_rows,
       {CI('hard_null_flag')} AS hard_null_flag_rows,
       {CI('test_value_null_flag')} AS test_value_null_flag_rows,
       {CI('spec_null_flag')} AS spec_null_flag_rows,
       {CI('unit_null_flag')} AS unit_null_flag_rows,
       {CI('NOT hard_null_flag AND NOT test_value_null_flag AND NOT spec_null_flag AND NOT unit_null_flag')}
           AS clean_rows
FROM qc_flagged""",
    "rejected_orders": _with(_cte("bronze_mfg_order"), ORDER_CHECKED)
    + """SELECT order_id, batch_id, drug_code, planned_qty, actual_qty, start_date, end_date, status, priority,
       reject_reason FROM order_checked WHERE reject_reason IS NOT NULL""",
    "qc_summary": QC + f"""SELECT test_name, count(*) AS total_tests,
       {CI(_QC_PASS)} AS pass_count, {CI(_QC_FAIL)} AS fail_count,
       {RATE(f'count_if({_QC_PASS})', 'count(*)')} AS pass_pct,
       {RATE(f'count_if({_QC_FAIL})', 'count(*)')} AS fail_pct
FROM silver_qc GROUP BY test_name""",
    "qc_trend": QC + f"""SELECT test_name, date_month, count(*) AS total_tests,
       {CI(_QC_FAIL)} AS fail_count,
       {RATE(f'count_if({_QC_FAIL})', 'count(*)')} AS fail_pct
FROM silver_qc GROUP BY test_name, date_month""",
    "qc_batch_quality": QC + f"""SELECT batch_id, count(*) AS total_tests,
       {CI(_QC_FAIL)} AS fail_count,
       {R(f'100 - count_if({_QC_FAIL}) / count(*) * 100', 2)} AS batch_quality_score
FROM silver_qc GROUP BY batch_id""",
    "qc_analyst": QC + f"""SELECT analyst_id, count(*) AS tests_performed,
       {CI(_QC_FAIL)} AS fail_count, {CI(_QC_PASS)} AS pass_count,
       {RATE(f'count_if({_QC_FAIL})', 'count(*)')} AS fail_pct,
       {RATE(f'count_if({_QC_PASS})', 'count(*)')} AS pass_pct
FROM silver_qc GROUP BY analyst_id""",
    "lb_enriched": _with(_cte("bronze_clinical_dm"), _cte("bronze_clinical_lb"), SILVER_DM, SILVER_LB)
    + """SELECT lb.*, dm.arm_group, dm.age_group, dm.sex, dm.country, dm.site_id, dm.enrollment_date_month
FROM silver_lb lb LEFT JOIN silver_dm dm ON lb.subject_id = dm.subject_id AND lb.study_id = dm.study_id""",
    "vs_enriched": _with(_cte("bronze_clinical_dm"), _cte("bronze_clinical_vs"), SILVER_DM, SILVER_VS)
    + """SELECT vs.*, dm.arm_group, dm.age_group, dm.sex, dm.country, dm.site_id
FROM silver_vs vs LEFT JOIN silver_dm dm ON vs.subject_id = dm.subject_id AND vs.study_id = dm.study_id""",
    "lb_per_subject": _with(_cte("bronze_clinical_lb"), SILVER_LB, LB_PER_SUBJECT) + "SELECT * FROM lb_ps",
    "vs_per_subject": _with(_cte("bronze_clinical_vs"), SILVER_VS, VS_PER_SUBJECT) + "SELECT * FROM vs_ps",
    "gold_subject_safety": CLINICAL + f"""SELECT study_id, subject_id, arm_group, sex, age_group, country, site_id,
       enrollment_date_month, "enrollment_Year", total_lab_tests, abnormal_lab_count, abnormal_lab_rate_pct,
       distinct_tests, total_vs_visits, concern_visit_count, vs_concern_rate_pct, avg_heart_rate,
       avg_systolic_bp, avg_diastolic_bp, avg_temperature, {FLAG} AS overall_safety_flag
FROM safety""",
    "gold_demo_safety": CLINICAL + f"""SELECT study_id, arm_group, sex, age_group, country,
       count(DISTINCT subject_id) AS subject_count,
       {MEAN('abnormal_lab_rate_pct', 2)} AS avg_abnormal_lab_rate_pct,
       {MEAN('vs_concern_rate_pct', 2)} AS avg_vs_concern_rate_pct,
       {MEAN('total_lab_tests', 1)} AS avg_lab_tests_per_subject,
       {MEAN('total_vs_visits', 1)} AS avg_vs_visits_per_subject,
       {CI(FLAG)} AS flagged_subjects,
       {RATE(f'count_if({FLAG})', 'count(DISTINCT subject_id)')} AS flagged_subject_rate_pct
FROM safety GROUP BY study_id, arm_group, sex, age_group, country""",
    "gold_capa": _with(_cte("bronze_mfg_deviation"), _cte("bronze_mfg_lot"), SILVER_DEVIATION, SILVER_LOT,
                       """lot_keys AS (SELECT DISTINCT batch_id, plant_id, drug_code, manufacture_month, yield_class
             FROM silver_lot)""",
                       """enr AS (SELECT d.*, k.plant_id, k.drug_code, strftime(d.reported_date, '%Y-%m') AS reported_month
        FROM silver_deviation d LEFT JOIN lot_keys k ON d.batch_id = k.batch_id)""",
                       f"""agg AS (SELECT plant_id, drug_code, reported_month,
       count(deviation_id) AS total_deviations,
       {CI("status = 'OPEN'")} AS open_count,
       {CI("status = 'CLOSED'")} AS closed_count,
       {CI("status = 'IN_REVIEW'")} AS in_review_count,
       {CI("severity = 'CRITICAL'")} AS critical_count,
       {CI("severity = 'MAJOR'")} AS major_count,
       {CI("severity = 'MINOR'")} AS minor_count,
       {CI("severity = 'CRITICAL' AND status <> 'CLOSED'")} AS critical_open_count,
       {MEAN('days_to_closure', 1)} AS avg_days_to_closure,
       CAST(min(days_to_closure) AS INTEGER) AS min_days_to_closure,
       CAST(max(days_to_closure) AS INTEGER) AS max_days_to_closure,
       {CI('days_to_closure IS NOT NULL AND days_to_closure > sla_days')} AS sla_breach_count,
       {CI("deviation_type = 'PROCESS'")} AS process_deviations,
       {CI("deviation_type = 'EQUIPMENT'")} AS equipment_deviations,
       {CI("deviation_type = 'MATERIAL'")} AS material_deviations,
       count(DISTINCT batch_id) AS affected_batches,
       count(DISTINCT equipment_id) AS affected_equipment
FROM enr GROUP BY plant_id, drug_code, reported_month)""",
                       f"""rated AS (SELECT *, {RATE('sla_breach_count', 'total_deviations')} AS sla_breach_rate_pct,
       {RATE('closed_count', 'total_deviations')} AS closure_rate_pct FROM agg)""")
    + """SELECT *, CASE WHEN critical_open_count > 0 THEN 'Critical'
            WHEN sla_breach_rate_pct > 30 THEN 'High'
            WHEN sla_breach_rate_pct > 15 THEN 'Medium'
            ELSE 'Low' END AS capa_risk_level
FROM rated""",
    "lot_summary": LOT + f"""SELECT plant_id, drug_code, manufacture_month, manufacture_year, manufacture_quarter,
       count(batch_id) AS total_batches,
       {CI("status = 'COMPLETED'")} AS completed_batches,
       {CI("status = 'FAILED'")} AS failed_batches,
       {CI("status = 'IN_PROGRESS'")} AS inprogress_batches,
       {MEAN('yield_percentage', 2)} AS avg_yield_pct,
       {R('min(yield_percentage)', 2)} AS min_yield_pct,
       {R('max(yield_percentage)', 2)} AS max_yield_pct,
       {CI("yield_class = 'High'")} AS high_yield_batches,
       {CI("yield_class = 'Low'")} AS low_yield_batches,
       {CI('deviation_flag = true')} AS deviation_batches,
       {MEAN('batch_duration_minutes', 1)} AS avg_batch_duration_mins,
       {MEAN('material_loss_pct', 2)} AS avg_material_loss_pct,
       {RSUM('input_material_qty', 2)} AS total_input_qty,
       {RSUM('output_material_qty', 2)} AS total_output_qty,
       {RATE("count_if(status = 'COMPLETED')", 'count(batch_id)')} AS batch_pass_rate_pct,
       {RATE("count_if(status = 'FAILED')", 'count(batch_id)')} AS batch_fail_rate_pct
FROM silver_lot GROUP BY plant_id, drug_code, manufacture_month, manufacture_year, manufacture_quarter""",
    "order_summary": ORDER + f"""SELECT drug_code, date_month,
       count(order_id) AS total_orders,
       {CI("status = 'DONE'")} AS completed_orders,
       {MEAN('qty_variance_pct', 2)} AS avg_qty_variance_pct,
       {CI("fulfillment_status = 'ON TARGET'")} AS on_target_orders,
       {CI("fulfillment_status = 'UNDER PRODUCTION'")} AS under_orders,
       {MEAN('planned_duration_days', 1)} AS avg_planned_duration_days,
       {RATE("count_if(fulfillment_status = 'ON TARGET')", 'count(order_id)')} AS qty_fulfillment_rate_pct,
       {RATE("count_if(status = 'DONE')", 'count(order_id)')} AS on_time_orders_pct
FROM silver_order GROUP BY drug_code, date_month""",
    "label_census_orders": """SELECT 'o_orderstatus' AS column_name, CAST(o_orderstatus AS VARCHAR) AS label,
       count(*) AS row_count FROM orders GROUP BY o_orderstatus
UNION ALL
SELECT 'o_orderpriority' AS column_name, CAST(o_orderpriority AS VARCHAR) AS label,
       count(*) AS row_count FROM orders GROUP BY o_orderpriority""",
    "latest_order_per_customer": "WITH src AS (SELECT * FROM orders)\n"
    + latest_sql("src", ["o_custkey"], ["o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice",
                                        "o_orderpriority"]),
    "date_parts_orders": """SELECT o_orderkey,
       strftime(o_orderdate, '%d %B') AS order_date_month,
       strftime(o_orderdate, '%Y-%m') AS order_month,
       CAST(year(o_orderdate) AS VARCHAR) AS order_year,
       concat(CAST(year(o_orderdate) AS VARCHAR), '-Q', CAST(quarter(o_orderdate) AS VARCHAR)) AS order_quarter,
       dayname(o_orderdate) AS order_day_of_week,
       strftime(o_orderdate, '%Y-%m-%d') AS order_iso
FROM orders""",
    "upsert_lines": f"WITH {LINES}\nSELECT * FROM merged",
    "upsert_late_versions": latest_sql("lineitem", ["l_orderkey"], [
        "l_shipdate", *[c for c in LINE_COLS if c not in ("l_orderkey", "l_shipdate")]]),
    "upsert_null_keys": """WITH src AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS o_custkey,
       o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, CAST(o_orderkey % 2 AS INTEGER) AS delivery FROM orders)
""" + latest_sql("src", ["o_custkey"], ["o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]),
    "change_rows_lines": _change_rows_sql(),
    "holiday_gate": f"""WITH {HOLIDAYS},
runs AS (SELECT DISTINCT CAST(ts AS DATE) AS run_date FROM events)
SELECT r.run_date, h.holiday_date IS NOT NULL AS is_holiday,
       CASE WHEN h.holiday_date IS NOT NULL THEN 'SKIP' ELSE 'RUN_MAIN' END AS decision
FROM runs r LEFT JOIN hol h ON r.run_date = h.holiday_date""",
    "holiday_gate_single": f"""WITH {HOLIDAYS},
run AS (SELECT max(CAST(ts AS DATE)) AS run_date FROM events)
SELECT run_date, run_date IN (SELECT holiday_date FROM hol) AS is_holiday,
       CASE WHEN run_date IN (SELECT holiday_date FROM hol) THEN 'SKIP' ELSE 'RUN_MAIN' END AS decision FROM run""",
    "rows_on_holidays": f"""WITH {HOLIDAYS}
SELECT * FROM events e WHERE EXISTS (SELECT 1 FROM hol h WHERE h.holiday_date = CAST(e.ts AS DATE))""",
    "rows_on_workdays": f"""WITH {HOLIDAYS}
SELECT * FROM events e WHERE NOT EXISTS (SELECT 1 FROM hol h WHERE h.holiday_date = CAST(e.ts AS DATE))""",
}

# The layer-job queries write and read back the same marts.
ORACLE["job_qc_summary"] = ORACLE["qc_summary"]
ORACLE["holiday_gate_csv"] = ORACLE["holiday_gate"]
ORACLE["job_gold_capa"] = ORACLE["gold_capa"]
ORACLE["gold_capa_open"] = (ORACLE["gold_capa"].replace(SILVER_DEVIATION, SILVER_DEVIATION_OPEN)
                            .replace(_cte("bronze_mfg_deviation"), _cte("bronze_mfg_deviation", "bronze_mfg_deviation_open")))
ORACLE["job_qc_replay"] = ORACLE["silver_qc"].replace(
    "SELECT batch_id, lot_id, test_id,", "SELECT batch_id, CASE WHEN lot_id % 10 <> 0 THEN lot_id END AS lot_id, test_id,").replace(
    "(batch_id IS NULL OR lot_id IS NULL", "(batch_id IS NULL OR lot_id % 10 = 0 OR lot_id IS NULL")
ORACLE["job_gold_subject"] = ORACLE["gold_subject_safety"]
