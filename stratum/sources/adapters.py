"""Bronze-shaped views over the benchmark tables (test and bench inputs).

Each adapter is data: a source table and a list of SQL expressions.  Spark
evaluates them with ``selectExpr`` over the Parquet scan (so column pruning
and pushdown still apply); the oracle SQL uses the very same text as a
``SELECT ... FROM <table>`` common table expression.  The text is valid in
both Spark SQL and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.sources.tables import read_source

ADAPTERS: dict[str, tuple[str, list[str]]] = {
    "bronze_mfg_order": ("orders", [
        "o_orderkey AS order_id",
        "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderkey END AS batch_id",
        "concat('DRUG_', CAST(o_custkey % 12 AS STRING)) AS drug_code",
        "CAST(100 + o_orderkey % 50 AS DOUBLE) AS planned_qty",
        "CASE WHEN o_orderkey % 59 = 0 THEN NULL WHEN o_orderkey % 53 = 0 THEN CAST(0 AS DOUBLE) "
        "ELSE CAST(100 + o_orderkey % 50 + o_custkey % 5 - 2 AS DOUBLE) END AS actual_qty",
        "CAST(o_orderdate AS DATE) AS start_date",
        "CAST(o_orderdate AS DATE) + CAST(o_custkey % 20 - 1 AS INT) AS end_date",
        "CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'O' THEN 'In Progress' "
        "WHEN o_orderkey % 2 = 0 THEN 'Planned' ELSE 'on hold' END AS status",
        "CASE WHEN o_orderpriority = '2-HIGH' THEN 'high' WHEN o_orderpriority = '3-MEDIUM' THEN 'Medium' "
        "WHEN o_orderpriority = '5-LOW' THEN 'LOW' WHEN o_orderpriority = '1-URGENT' THEN 'urgent' END AS priority",
        "concat('U_', CAST(o_custkey % 9 AS STRING)) AS created_by",
        "o_orderdate AS created_at",
    ]),
    "bronze_mfg_lot": ("lineitem", [
        "l_orderkey AS batch_id",
        "CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE concat('L', CAST(l_partkey AS STRING)) END AS lot_id",
        "concat('DRUG_', CAST(l_partkey % 12 AS STRING)) AS drug_code",
        "concat('PLANT_', CAST(l_suppkey % 8 AS STRING)) AS plant_id",
        "CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE concat(' EQ_', CAST(l_suppkey % 40 AS STRING), ' ') END AS equipment_id",
        "CASE WHEN l_linenumber = 7 THEN NULL ELSE concat('STEP_', CAST(l_linenumber AS STRING)) END AS process_step",
        "CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE concat('OP_', CAST(l_partkey % 13 AS STRING)) END AS operator_id",
        "l_shipdate + INTERVAL '1' HOUR * (l_partkey % 24) AS manufacture_date",
        "l_shipdate + INTERVAL '1' HOUR * (l_partkey % 24) + INTERVAL '1' MINUTE * CAST(60 + l_quantity * 10 AS INT) AS end_timestamp",
        "CASE WHEN l_partkey % 31 = 0 THEN NULL WHEN l_partkey % 37 = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity * 10 END AS input_material_qty",
        "l_quantity * (10 - l_linenumber) AS output_material_qty",
        "CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE CAST(60 + (l_partkey + l_linenumber) % 41 AS DOUBLE) END AS yield_percentage",
        "CAST(20 + l_linenumber AS DOUBLE) AS temperature_avg",
        "CAST(1 + l_linenumber AS DOUBLE) AS pressure_avg",
        "CASE WHEN l_returnflag = 'A' THEN 'COMPLETED' WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'IN_PROGRESS' END AS status",
        "CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_partkey % 3 = 0 END AS deviation_flag",
        "l_shipdate AS created_at",
    ]),
    "bronze_mfg_equipment_lot": ("events", [
        "concat('EQ_', CAST(user_id % 40 AS STRING)) AS equipment_id",
        "concat('PLANT_', CAST(user_id % 8 AS STRING)) AS plant_id",
        "concat(' ', event_type, ' ') AS event_type",
        "ts AS event_start",
        "CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts + INTERVAL '1' MINUTE * CAST(event_id % 700 AS INT) END AS event_end",
        "CAST(event_id % 90 AS DOUBLE) AS downtime_minutes",
        "CASE WHEN event_id % 3 = 0 THEN 'VALID' WHEN event_id % 3 = 1 THEN 'DUE' ELSE 'EXPIRED' END AS calibration_status",
        "CASE WHEN event_id % 19 = 0 THEN NULL ELSE concat('OP_', CAST(event_id % 13 AS STRING)) END AS operator_id",
        "concat('  note ', CAST(event_id % 5 AS STRING)) AS remarks",
    ]),
    "bronze_mfg_deviation": ("events", [
        "event_id AS deviation_id",
        "event_id AS batch_id",
        "concat(' EQ_', CAST(user_id % 40 AS STRING)) AS equipment_id",
        "CASE WHEN event_type = 'view' THEN 'PROCESS' WHEN event_type = 'error' THEN 'EQUIPMENT' "
        "WHEN event_type = 'click' THEN 'MATERIAL' ELSE 'OTHER' END AS deviation_type",
        "CASE WHEN event_id % 23 = 0 THEN 'CRITICAL' WHEN event_id % 3 = 0 THEN 'MAJOR' "
        "WHEN event_id % 3 = 1 THEN 'MINOR' ELSE 'TRIVIAL' END AS severity",
        "concat(' dev ', CAST(event_id AS STRING), ' ') AS description",
        "'cause' AS root_cause",
        "'action' AS corrective_action",
        "concat('REP_', CAST(user_id % 7 AS STRING)) AS reported_by",
        "CAST(ts AS DATE) AS reported_date",
        "CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(ts AS DATE) + CAST(event_id % 40 AS INT) END AS closure_date",
        "CASE WHEN event_id % 4 = 0 THEN 'OPEN' WHEN event_id % 4 = 1 THEN 'IN_REVIEW' ELSE 'CLOSED' END AS status",
    ]),
    "bronze_qc_lab_result": ("lineitem", [
        "l_orderkey AS batch_id",
        "l_partkey AS lot_id",
        "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS test_id",
        "CASE WHEN l_linenumber = 1 THEN 'pH' WHEN l_linenumber = 2 THEN 'Sterility' WHEN l_linenumber = 3 THEN 'Potency' "
        "WHEN l_linenumber = 4 THEN 'endotoxin' WHEN l_linenumber = 5 THEN 'Viscosity' WHEN l_linenumber = 6 THEN 'PH' END AS test_name",
        "CASE WHEN l_partkey % 43 = 0 THEN NULL ELSE l_quantity END AS test_value",
        "CASE WHEN l_partkey % 47 = 0 THEN NULL ELSE ' mg ' END AS unit",
        "CAST(5 AS DOUBLE) AS lower_spec",
        "CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE CAST(45 AS DOUBLE) END AS upper_spec",
        "CASE WHEN l_returnflag = 'A' THEN 'Pass' WHEN l_returnflag = 'R' THEN 'fail' END AS result_flag",
        "CASE WHEN l_suppkey % 15 = 0 THEN NULL ELSE concat('AN_', CAST(l_suppkey % 15 AS STRING)) END AS analyst_id",
        "l_shipdate AS test_date",
    ]),
    "bronze_clinical_dm": ("customer", [
        "concat('ST_', CAST(c_custkey % 3 AS STRING)) AS study_id",
        "c_custkey AS subject_id",
        "CASE WHEN c_custkey % 61 = 0 THEN NULL ELSE concat('SITE_', CAST(c_nationkey AS STRING)) END AS site_id",
        "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN ' treatment' WHEN c_mktsegment = 'BUILDING' THEN 'Placebo' "
        "WHEN c_mktsegment = 'FURNITURE' THEN 'control ' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Low Dose' ELSE 'open label' END AS arm_group",
        "CAST(10 + c_custkey % 85 AS INT) AS age",
        "CASE WHEN c_custkey % 4 = 0 THEN 'M' WHEN c_custkey % 4 = 1 THEN 'f' WHEN c_custkey % 4 = 2 THEN 'F' ELSE 'x' END AS sex",
        "concat('R_', CAST(c_custkey % 6 AS STRING)) AS race",
        "concat('C_', CAST(c_nationkey % 5 AS STRING)) AS country",
        "DATE '2023-01-01' + CAST(c_custkey % 600 AS INT) AS enrollment_date",
    ]),
    "bronze_clinical_lb": ("orders", [
        "concat('ST_', CAST(o_custkey % 3 AS STRING)) AS study_id",
        "o_custkey AS subject_id",
        "o_orderpriority AS test_name",
        "CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE CAST(o_orderkey % 100 AS DOUBLE) END AS test_value",
        "'mg/dL' AS unit",
        "CASE WHEN o_orderkey % 71 = 0 THEN '<80' WHEN o_orderkey % 73 = 0 THEN '-5-80' ELSE '20.5 - 80' END AS reference_range",
        "CAST(o_orderdate AS DATE) AS test_date",
        "CASE WHEN o_orderkey % 13 = 0 THEN 'n' WHEN o_orderkey % 100 < 21 THEN 'Low' "
        "WHEN o_orderkey % 100 > 80 THEN 'high' ELSE 'normal' END AS abnormal_flag",
    ]),
    "bronze_clinical_vs": ("events", [
        "concat('ST_', CAST(user_id % 3 AS STRING)) AS study_id",
        "user_id AS subject_id",
        "CAST(ts AS DATE) AS visit_date",
        "CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(30 + event_id % 150 AS DOUBLE) END AS heart_rate",
        "CAST(60 + event_id % 120 AS DOUBLE) AS systolic_bp",
        "CAST(35 + event_id % 71 AS DOUBLE) AS diastolic_bp",
        "CAST(34 AS DOUBLE) + CAST(event_id % 80 AS DOUBLE) / 10 AS temperature",
        "CAST(5 + event_id % 35 AS DOUBLE) AS respiratory_rate",
    ]),
}


def _variant(name: str, exprs: dict[str, str]) -> tuple[str, list[str]]:
    """The view ``name`` with other expressions for some of its columns."""
    table, base = ADAPTERS[name]
    return table, [f"{exprs[c]} AS {c}" if (c := e.rsplit(" AS ", 1)[1]) in exprs else e for e in base]


def _gaps(value: str, every: int) -> str:
    return f"CASE WHEN event_id % {every} = 0 THEN NULL ELSE {value} END"


# Feeds in which records still run: no closure or end, labels not filled in.
ADAPTERS["bronze_mfg_deviation_open"] = _variant("bronze_mfg_deviation", {
    "equipment_id": _gaps("concat(' EQ_', CAST(user_id % 40 AS STRING))", 19), "description": _gaps("' dev '", 17),
    "root_cause": _gaps("' cause '", 11), "corrective_action": _gaps("' action'", 7), "reported_by": _gaps("'REP '", 13)})
ADAPTERS["bronze_mfg_equipment_ongoing"] = _variant("bronze_mfg_equipment_lot", {
    "remarks": _gaps("concat('  note ', CAST(event_id % 5 AS STRING))", 7),
    "calibration_status": _gaps("'VALID'", 5)})


def adapter_sql(name: str) -> str:
    table, exprs = ADAPTERS[name]
    return "SELECT " + ",\n       ".join(exprs) + f"\nFROM {table}"


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The bronze view ``name`` computed by Spark from ``sf_dir``."""
    table, exprs = ADAPTERS[name]
    return read_source(spark, sf_dir, table).selectExpr(*exprs)
