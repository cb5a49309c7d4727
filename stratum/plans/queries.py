"""Registered queries: ``(spark, sf_dir) -> DataFrame``.

Each query reads the benchmark tables in ``sf_dir`` through the bronze
adapters (whole tables) and runs the silver / gold plans on top.  Queries
that exercise ingest or incremental append write their inputs and outputs
under the session's shared checkpoint folder and return the table read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.calendar import gate, gate_dates, holiday_calendar, on_holidays, on_workdays
from stratum.operators.changes import change_rows
from stratum.operators.dedup import latest_per_key
from stratum.operators.quality import dq_metrics, label_census
from stratum.operators.upsert import BUCKET_COL, upsert, upsert_table
from stratum.functions.derive import date_parts
from stratum.plans import gold as G
from stratum.plans import silver as S
from stratum.session import apply_defaults, scratch_dir
from stratum.sources.adapters import bronze
from stratum.sources.tables import read_source, write_batch

Query = Callable[[SparkSession, str], DataFrame]

# Cut-over date of the two-load upsert scenario: lines shipped before it
# form the first load, lines shipped on or after it the second batch.
UPSERT_CUTOVER = "1998-07-01"
LINE_KEYS = ["l_orderkey", "l_linenumber"]


def _prep(spark: SparkSession) -> None:
    apply_defaults(spark)


# ---- silver -----------------------------------------------------------------

def q_silver_qc(spark, sf):
    _prep(spark)
    return S.silver_qc(bronze(spark, sf, "bronze_qc_lab_result"))


def q_silver_order(spark, sf):
    _prep(spark)
    return S.silver_order(bronze(spark, sf, "bronze_mfg_order"))


def q_silver_lot(spark, sf):
    _prep(spark)
    return S.silver_lot(bronze(spark, sf, "bronze_mfg_lot"))


def q_silver_equipment(spark, sf):
    _prep(spark)
    return S.silver_equipment(bronze(spark, sf, "bronze_mfg_equipment_lot"))


def q_silver_deviation(spark, sf):
    _prep(spark)
    return S.silver_deviation(bronze(spark, sf, "bronze_mfg_deviation"))


def q_silver_equipment_ongoing(spark, sf):
    """Equipment events with those that have not ended."""
    _prep(spark)
    return S.silver_equipment(bronze(spark, sf, "bronze_mfg_equipment_ongoing"), S.EQUIPMENT_REQUIRED_OPEN)


def q_silver_deviation_open(spark, sf):
    """Deviations with those that are still open or under investigation."""
    _prep(spark)
    return S.silver_deviation(bronze(spark, sf, "bronze_mfg_deviation_open"), S.DEVIATION_REQUIRED_OPEN)


def q_silver_dm(spark, sf):
    _prep(spark)
    return S.silver_dm(bronze(spark, sf, "bronze_clinical_dm"))


def q_silver_lb(spark, sf):
    _prep(spark)
    return S.silver_lb(bronze(spark, sf, "bronze_clinical_lb"))


def q_silver_vs(spark, sf):
    _prep(spark)
    return S.silver_vs(bronze(spark, sf, "bronze_clinical_vs"))


def q_lb_mismatches(spark, sf):
    _prep(spark)
    return S.lb_mismatches(bronze(spark, sf, "bronze_clinical_lb"))


def q_dq_metrics_qc(spark, sf):
    _prep(spark)
    return dq_metrics(S.qc_flagged(bronze(spark, sf, "bronze_qc_lab_result")), S.QC_FLAGS)


def q_rejected_orders(spark, sf):
    _prep(spark)
    _, bad = S.order_split(bronze(spark, sf, "bronze_mfg_order"))
    return bad.select("order_id", "batch_id", "drug_code", "planned_qty", "actual_qty",
                      "start_date", "end_date", "status", "priority", "reject_reason")


# ---- gold -------------------------------------------------------------------

def q_qc_summary(spark, sf):
    return G.qc_summary(q_silver_qc(spark, sf))


def q_qc_trend(spark, sf):
    return G.qc_trend(q_silver_qc(spark, sf))


def q_qc_batch_quality(spark, sf):
    return G.qc_batch_quality(q_silver_qc(spark, sf))


def q_qc_analyst(spark, sf):
    return G.qc_analyst(q_silver_qc(spark, sf))


def q_lb_enriched(spark, sf):
    return G.lb_enriched(q_silver_lb(spark, sf), q_silver_dm(spark, sf), keyed=True)


def q_vs_enriched(spark, sf):
    return G.vs_enriched(q_silver_vs(spark, sf), q_silver_dm(spark, sf), keyed=True)


def q_lb_per_subject(spark, sf):
    return G.lb_per_subject(q_silver_lb(spark, sf))


def q_vs_per_subject(spark, sf):
    return G.vs_per_subject(q_silver_vs(spark, sf))


def _safety(spark, sf):
    return G.subject_safety(q_silver_dm(spark, sf), q_lb_per_subject(spark, sf),
                            q_vs_per_subject(spark, sf))


def q_gold_subject_safety(spark, sf):
    return G.gold_subject_safety(_safety(spark, sf))


def q_gold_demo_safety(spark, sf):
    return G.gold_demo_safety(_safety(spark, sf))


def q_gold_capa(spark, sf):
    return G.gold_capa(q_silver_deviation(spark, sf), q_silver_lot(spark, sf))


def q_gold_capa_open(spark, sf):
    return G.gold_capa(q_silver_deviation_open(spark, sf), q_silver_lot(spark, sf))


def q_lot_summary(spark, sf):
    return G.lot_summary(q_silver_lot(spark, sf))


def q_order_summary(spark, sf):
    return G.order_summary(q_silver_order(spark, sf))


# ---- generic operators over the raw tables ---------------------------------

def q_label_census_orders(spark, sf):
    _prep(spark)
    return label_census(read_source(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


def q_latest_order_per_customer(spark, sf):
    _prep(spark)
    return latest_per_key(read_source(spark, sf, "orders"), ["o_custkey"], ["o_orderdate"])


def q_date_parts_orders(spark, sf):
    _prep(spark)
    o = read_source(spark, sf, "orders")
    return o.select("o_orderkey", *[c.alias(n) for n, c in date_parts("o_orderdate", {
        "order_date_month": "date_month", "order_month": "month", "order_year": "year",
        "order_quarter": "quarter", "order_day_of_week": "day_of_week", "order_iso": "iso",
    }).items()])


def _lines(spark, sf):
    li = read_source(spark, sf, "lineitem")
    early = F.col("l_shipdate") < F.lit(UPSERT_CUTOVER).cast("timestamp_ntz")
    return li.filter(early), li.filter(~F.coalesce(early, F.lit(False)))


def q_upsert_lines(spark, sf):
    """Two loads of lineitem keyed by (order, line): the first load is the
    table (latest version per key), the second batch is merged into it."""
    _prep(spark)
    first, batch = _lines(spark, sf)
    table = latest_per_key(first, LINE_KEYS, ["l_shipdate"])
    return upsert(table, batch, LINE_KEYS, ["l_shipdate"])


def q_upsert_late_versions(spark, sf):
    """The later lines of each order are the table; the earlier ones arrive
    after them and must not replace anything newer."""
    _prep(spark)
    early, late = _lines(spark, sf)
    return upsert(latest_per_key(late, ["l_orderkey"], ["l_shipdate"]), early, ["l_orderkey"], ["l_shipdate"])


def q_upsert_null_keys(spark, sf):
    """Orders, some without a customer, delivered in two batches, of which the
    second comes twice: rows without a key stay, each once."""
    _prep(spark)
    o = read_source(spark, sf, "orders").withColumns({
        "o_custkey": F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey")),
        "delivery": (F.col("o_orderkey") % 2).cast("int")})
    path = scratch_dir(spark, "upsert_null_keys") + "/orders"
    for n in (0, 1, 1):
        upsert_table(spark, path, o.filter(F.col("delivery") == n), ["o_custkey"], ["o_orderdate", "o_orderkey"],
                     delivery="delivery")
    return spark.read.parquet(path).drop(BUCKET_COL)


def q_change_rows_lines(spark, sf):
    """Row-level changes the second lineitem batch makes to the table."""
    _prep(spark)
    first, batch = _lines(spark, sf)
    table = latest_per_key(first, LINE_KEYS, ["l_shipdate"])
    return change_rows(table, upsert(table, batch, LINE_KEYS, ["l_shipdate"]), LINE_KEYS)


# ---- calendar -----------------------------------------------------------------

def q_holiday_gate(spark, sf):
    """SKIP / RUN_MAIN for every date on which events were recorded."""
    _prep(spark)
    ev = read_source(spark, sf, "events")
    return gate_dates(ev, holiday_calendar(spark), F.col("ts"))


def q_holiday_gate_single(spark, sf):
    """The gate's decision for one run date: the last day with events."""
    _prep(spark)
    last = read_source(spark, sf, "events").agg(F.max(F.col("ts").cast("date")).alias("d")).first()["d"]
    return gate(holiday_calendar(spark), last)


def q_holiday_gate_csv(spark, sf):
    """The same gate with the calendar read from a CSV file (header, inferred
    types), as a deployment would ship it."""
    from stratum.operators.calendar import read_calendar
    _prep(spark)
    path = scratch_dir(spark, "calendar") + "/schedule_holidays"
    holiday_calendar(spark).coalesce(1).write.option("header", "true").csv(path)
    ev = read_source(spark, sf, "events")
    return gate_dates(ev, read_calendar(spark, path), F.col("ts"))


def q_rows_on_holidays(spark, sf):
    _prep(spark)
    ev = read_source(spark, sf, "events")
    return on_holidays(ev, holiday_calendar(spark), F.col("ts"))


def q_rows_on_workdays(spark, sf):
    _prep(spark)
    ev = read_source(spark, sf, "events")
    return on_workdays(ev, holiday_calendar(spark), F.col("ts"))


# ---- layer jobs end to end (bronze tables -> silver writes -> gold writes) ----

def _job_layout(spark, name):
    from stratum.sources.tables import Layout
    return Layout(scratch_dir(spark, name))


def q_job_qc_summary(spark, sf):
    """QC feed delivered twice (a full re-delivery) -> bucketed silver upsert
    -> gold mart written and read back."""
    from stratum.plans import jobs as J
    _prep(spark)
    lay = _job_layout(spark, "job_qc")
    b = bronze(spark, sf, "bronze_qc_lab_result")
    write_batch(b, lay.bronze("qc_lab_result"), 0)
    J.silver_job(spark, lay, "qc_lab_result")
    write_batch(b, lay.bronze("qc_lab_result"), 1)
    J.silver_job(spark, lay, "qc_lab_result")
    J.gold_job(spark, lay, "qc_summary")
    return spark.read.parquet(lay.gold("qc_summary"))


def q_job_qc_replay(spark, sf):
    """A QC ingest batch is rewritten under new file names after silver has
    read it; some rows have no lot.  Silver stays as it was."""
    from stratum.plans import jobs as J
    _prep(spark)
    lay = _job_layout(spark, "job_qc_replay")
    b = bronze(spark, sf, "bronze_qc_lab_result").withColumn(
        "lot_id", F.when(F.col("lot_id") % 10 != 0, F.col("lot_id")))
    for batch in (0, 1):
        write_batch(b.filter(F.col("batch_id") % 2 == batch), lay.bronze("qc_lab_result"), batch)
        J.silver_job(spark, lay, "qc_lab_result")
    write_batch(b.filter(F.col("batch_id") % 2 == 0), lay.bronze("qc_lab_result"), 0)
    J.silver_job(spark, lay, "qc_lab_result")
    return spark.read.parquet(lay.silver("qc_lab_result")).select(*S.QC_COLUMNS)


def q_job_gold_capa(spark, sf):
    """Deviation upsert + lot full refresh -> CAPA mart written and read back."""
    from stratum.plans import jobs as J
    _prep(spark)
    lay = _job_layout(spark, "job_capa")
    write_batch(bronze(spark, sf, "bronze_mfg_deviation"), lay.bronze("mfg_deviation"), 0)
    write_batch(bronze(spark, sf, "bronze_mfg_lot"), lay.bronze("mfg_lot"), 0)
    J.silver_job(spark, lay, "mfg_deviation")
    J.silver_job(spark, lay, "mfg_lot")
    J.gold_job(spark, lay, "gold_capa")
    return spark.read.parquet(lay.gold("gold_capa")).drop("gold_processed_at")


def q_job_gold_subject(spark, sf):
    """DM upsert, LB full refresh, VS streamed append -> subject mart
    (partitioned by study) written and read back."""
    from stratum.plans import jobs as J
    _prep(spark)
    lay = _job_layout(spark, "job_subject")
    write_batch(bronze(spark, sf, "bronze_clinical_dm"), lay.bronze("clinical_dm"), 0)
    write_batch(bronze(spark, sf, "bronze_clinical_lb"), lay.bronze("clinical_lb"), 0)
    write_batch(bronze(spark, sf, "bronze_clinical_vs"), lay.bronze("clinical_vs"), 0)
    for t in ("clinical_dm", "clinical_lb", "clinical_vs"):
        J.silver_job(spark, lay, t)
    J.gold_job(spark, lay, "gold_subject", partition_by=["study_id"])
    return spark.read.parquet(lay.gold("gold_subject")).drop("gold_processed_at")


QUERIES: dict[str, Query] = {
    "qc_summary": q_qc_summary,
    "qc_trend": q_qc_trend,
    "qc_batch_quality": q_qc_batch_quality,
    "qc_analyst": q_qc_analyst,
    "silver_qc": q_silver_qc,
    "silver_order": q_silver_order,
    "silver_lot": q_silver_lot,
    "silver_equipment": q_silver_equipment,
    "silver_deviation": q_silver_deviation,
    "silver_deviation_open": q_silver_deviation_open,
    "silver_equipment_ongoing": q_silver_equipment_ongoing,
    "silver_dm": q_silver_dm,
    "silver_lb": q_silver_lb,
    "silver_vs": q_silver_vs,
    "lb_mismatches": q_lb_mismatches,
    "dq_metrics_qc": q_dq_metrics_qc,
    "rejected_orders": q_rejected_orders,
    "lb_enriched": q_lb_enriched,
    "vs_enriched": q_vs_enriched,
    "lb_per_subject": q_lb_per_subject,
    "vs_per_subject": q_vs_per_subject,
    "gold_subject_safety": q_gold_subject_safety,
    "gold_demo_safety": q_gold_demo_safety,
    "gold_capa": q_gold_capa,
    "gold_capa_open": q_gold_capa_open,
    "lot_summary": q_lot_summary,
    "order_summary": q_order_summary,
    "label_census_orders": q_label_census_orders,
    "latest_order_per_customer": q_latest_order_per_customer,
    "date_parts_orders": q_date_parts_orders,
    "upsert_lines": q_upsert_lines,
    "upsert_late_versions": q_upsert_late_versions,
    "upsert_null_keys": q_upsert_null_keys,
    "change_rows_lines": q_change_rows_lines,
    "holiday_gate": q_holiday_gate,
    "holiday_gate_single": q_holiday_gate_single,
    "holiday_gate_csv": q_holiday_gate_csv,
    "rows_on_holidays": q_rows_on_holidays,
    "rows_on_workdays": q_rows_on_workdays,
    "job_qc_summary": q_job_qc_summary,
    "job_qc_replay": q_job_qc_replay,
    "job_gold_capa": q_job_gold_capa,
    "job_gold_subject": q_job_gold_subject,
}
