"""Gold marts G1-G9 kept up to date from the change rows of silver.

``maintain(mart)`` takes the deliveries that the mart has not seen from the
change logs of its silver tables and adds them to its state; what a delivery
does not touch is neither read nor written again.  The silver tables are
written with ``silver_job(..., changes=True)``.  A mart equals the one that
``plans.gold`` builds from the same silver tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions import vocab as V
from stratum.functions.derive import grade
from stratum.functions.rollup import complement_pct, rate_pct
from stratum.operators.bitmaps import LabelIds
from stratum.operators.changes import ChangeLog
from stratum.operators.rollup_state import SIGN, Rollup, RollupState, net, signed
from stratum.operators.upsert import BUCKET_COL, upsert_table
from stratum.plans import gold as G
from stratum.plans.jobs import read_silver
from stratum.session import scratch_dir
from stratum.sources.tables import Layout, names_in, touch

# mart -> the silver table it aggregates
SOURCES = {"qc_summary": "qc_lab_result", "qc_trend": "qc_lab_result", "qc_batch_quality": "qc_lab_result",
           "qc_analyst": "qc_lab_result", "lb_per_subject": "clinical_lb", "vs_per_subject": "clinical_vs",
           "lot_summary": "mfg_lot", "order_summary": "mfg_order"}
# text columns whose distinct values a mart counts, by the name of their ids
LABELS = {"lb_per_subject": {"test_name": "test_name_id", "test_date_month": "test_month_id"},
          "gold_capa": {"equipment_id": "equipment_no"}}


def _is(c: str, v) -> Column:
    return F.col(c) == F.lit(v)


def _round(*cols: tuple[str, int]):
    return lambda df: df.withColumns({c: F.round(c, n) for c, n in cols})


def rollup(mart: str) -> Rollup:
    """What the mart aggregates (a function, as columns need a session)."""
    every, failed, passed = F.lit(True), _is("result_flag", "FAIL"), _is("result_flag", "PASS")
    if mart == "qc_summary":
        return Rollup(["test_name"], {"total_tests": every, "pass_count": passed, "fail_count": failed},
                      finish=lambda df: df.withColumns({"pass_pct": rate_pct("pass_count", "total_tests"),
                                                        "fail_pct": rate_pct("fail_count", "total_tests")}))
    if mart == "qc_trend":
        return Rollup(["test_name", "date_month"], {"total_tests": every, "fail_count": failed},
                      finish=lambda df: df.withColumn("fail_pct", rate_pct("fail_count", "total_tests")))
    if mart == "qc_batch_quality":
        return Rollup(["batch_id"], {"total_tests": every, "fail_count": failed},
                      finish=lambda df: df.withColumn("batch_quality_score", complement_pct("fail_count", "total_tests")))
    if mart == "qc_analyst":
        return Rollup(["analyst_id"], {"tests_performed": every, "fail_count": failed, "pass_count": passed},
                      finish=lambda df: df.withColumns({"fail_pct": rate_pct("fail_count", "tests_performed"),
                                                        "pass_pct": rate_pct("pass_count", "tests_performed")}))
    if mart == "lb_per_subject":
        abnormal = ~F.col("abnormal_flag").isin(list(V.LAB_NORMAL_LABELS))
        return Rollup(G.SUBJECT_KEYS, {"total_lab_tests": F.col("test_name").isNotNull(), "abnormal_lab_count": abnormal},
                      means={"avg_lab_value": (F.col("test_value"), 2)},
                      distinct={"distinct_tests": "test_name_id", "lab_visit_months": "test_month_id"},
                      finish=lambda df: df.withColumn("abnormal_lab_rate_pct", rate_pct("abnormal_lab_count", "total_lab_tests")))
    if mart == "vs_per_subject":
        concern = F.lit(False)
        for c in ("heart_rate_category", "bp_category", "temp_category", "rr_category"):
            concern = concern | (F.col(c) != "Normal")
        values = ("heart_rate", "systolic_bp", "diastolic_bp", "temperature")
        return Rollup(G.SUBJECT_KEYS, {"total_vs_visits": F.col("visit_date_month").isNotNull(), "concern_visit_count": concern},
                      means={f"avg_{c}": (F.col(c), 2) for c in values},
                      finish=lambda df: df.withColumn("vs_concern_rate_pct", rate_pct("concern_visit_count", "total_vs_visits")))
    if mart == "lot_summary":
        return Rollup(["plant_id", "drug_code", "manufacture_month", "manufacture_year", "manufacture_quarter"],
                      {"total_batches": F.col("batch_id").isNotNull(), "completed_batches": _is("status", "COMPLETED"),
                       "failed_batches": _is("status", "FAILED"), "inprogress_batches": _is("status", "IN_PROGRESS"),
                       "high_yield_batches": _is("yield_class", "High"), "low_yield_batches": _is("yield_class", "Low"),
                       "deviation_batches": _is("deviation_flag", True)},
                      means={"avg_yield_pct": (F.col("yield_percentage"), 2),
                             "avg_batch_duration_mins": (F.col("batch_duration_minutes"), 1),
                             "avg_material_loss_pct": (F.col("material_loss_pct"), 2)},
                      totals={"total_input_qty": (F.col("input_material_qty"), 2), "total_output_qty": (F.col("output_material_qty"), 2)},
                      lows={"min_yield_pct": F.col("yield_percentage")}, highs={"max_yield_pct": F.col("yield_percentage")},
                      finish=lambda df: _round(("min_yield_pct", 2), ("max_yield_pct", 2))(df).withColumns({
                          "batch_pass_rate_pct": rate_pct("completed_batches", "total_batches"),
                          "batch_fail_rate_pct": rate_pct("failed_batches", "total_batches")}))
    if mart == "order_summary":
        return Rollup(["drug_code", "date_month"],
                      {"total_orders": F.col("order_id").isNotNull(), "completed_orders": _is("status", "DONE"),
                       "on_target_orders": _is("fulfillment_status", "ON TARGET"),
                       "under_orders": _is("fulfillment_status", "UNDER PRODUCTION")},
                      means={"avg_qty_variance_pct": (F.col("qty_variance_pct"), 2),
                             "avg_planned_duration_days": (F.col("planned_duration_days"), 1)},
                      finish=lambda df: df.withColumns({"qty_fulfillment_rate_pct": rate_pct("on_target_orders", "total_orders"),
                                                        "on_time_orders_pct": rate_pct("completed_orders", "total_orders")}))
    if mart == "gold_demo_safety":
        return Rollup(["study_id", "arm_group", "sex", "age_group", "country"], {"flagged_subjects": F.col("overall_safety_flag")},
                      means={"avg_abnormal_lab_rate_pct": (F.col("abnormal_lab_rate_pct"), 2),
                             "avg_vs_concern_rate_pct": (F.col("vs_concern_rate_pct"), 2),
                             "avg_lab_tests_per_subject": (F.col("total_lab_tests"), 1),
                             "avg_vs_visits_per_subject": (F.col("total_vs_visits"), 1)},
                      distinct={"subject_count": "subject_id"},
                      finish=lambda df: df.withColumn("flagged_subject_rate_pct", rate_pct("flagged_subjects", "subject_count")))
    if mart == "gold_capa":
        days, critical = F.col("days_to_closure"), _is("severity", "CRITICAL")
        return Rollup(["plant_id", "drug_code", "reported_month"],
                      {"total_deviations": F.col("deviation_id").isNotNull(), "open_count": _is("status", "OPEN"),
                       "closed_count": _is("status", "CLOSED"), "in_review_count": _is("status", "IN_REVIEW"),
                       "critical_count": critical, "major_count": _is("severity", "MAJOR"), "minor_count": _is("severity", "MINOR"),
                       "critical_open_count": critical & (F.col("status") != "CLOSED"),
                       "sla_breach_count": days.isNotNull() & (days > F.col("sla_days")),
                       "process_deviations": _is("deviation_type", "PROCESS"), "equipment_deviations": _is("deviation_type", "EQUIPMENT"),
                       "material_deviations": _is("deviation_type", "MATERIAL")},
                      means={"avg_days_to_closure": (days, 1)}, lows={"min_days_to_closure": days}, highs={"max_days_to_closure": days},
                      distinct={"affected_batches": "batch_id", "affected_equipment": "equipment_no"},
                      finish=lambda df: _round(("min_days_to_closure", 0), ("max_days_to_closure", 0))(df).withColumns({
                          "sla_breach_rate_pct": rate_pct("sla_breach_count", "total_deviations"),
                          "closure_rate_pct": rate_pct("closed_count", "total_deviations")}).withColumn(
                          "capa_risk_level", grade(V.CAPA_RISK_RULES, V.CAPA_RISK_ELSE)))
    raise ValueError(f"no such mart: {mart}")


def _state(spark: SparkSession, layout: Layout, mart: str) -> RollupState:
    return RollupState(spark, layout.state(mart), rollup(mart))


def _log(spark: SparkSession, layout: Layout, table: str) -> ChangeLog:
    return ChangeLog(spark, layout.changes(table))


def _encode(spark: SparkSession, layout: Layout, mart: str, rows: DataFrame, base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ids beside the texts whose distinct values are counted; new texts get theirs first."""
    for col, name in LABELS.get(mart, {}).items():
        ids = LabelIds(spark, layout.labels(col))
        ids.extend(rows.select(col))
        rows, base = ids.encode(rows, col, name), ids.encode(base, col, name)
    return rows, base


def maintain(spark: SparkSession, layout: Layout, mart: str) -> DataFrame:
    """Bring a mart up to date with its silver tables and return it."""
    if mart == "gold_subject":
        return _maintain_subjects(spark, layout)
    state = _state(spark, layout, mart)
    if mart == "gold_capa":
        _maintain_capa(spark, layout, state)
        return state.mart()
    if mart == "gold_demo_safety":
        base = _maintain_subjects(spark, layout)
        log = ChangeLog(spark, f"{layout.gold('gold_subject')}__changes")
    else:
        base, log = read_silver(spark, layout, SOURCES[mart]), _log(spark, layout, SOURCES[mart])
    last = log.last()
    if last is not None and last > state.applied():
        rows, base = _encode(spark, layout, mart, signed(log.read(state.applied() + 1, last)), base)
        state.apply(rows, last, base)
    return state.mart()


def _staged(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``rows`` written to the shared scratch folder, as they are read several times."""
    path = scratch_dir(spark, "staged")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _seen(spark: SparkSession, path: str, done: int, sources: int) -> list[int]:
    """Deliveries of each source that a state has in its delivery ``done``."""
    for name in names_in(spark, f"{path}/sources"):
        version, *positions = map(int, name.split("."))
        if version == done:
            return positions
    return [-1] * sources


def _claim(spark: SparkSession, path: str, version: int, positions: Sequence[int]) -> None:
    """Say, before a delivery is applied, what it holds of each source."""
    touch(spark, f"{path}/sources/" + ".".join(map(str, [version, *positions])))


def _maintain_subjects(spark: SparkSession, layout: Layout) -> DataFrame:
    """G5: the rows of subjects whose demographics, labs or vitals changed are built and merged."""
    path, gold = layout.state("gold_subject"), layout.gold("gold_subject")
    log = ChangeLog(spark, f"{gold}__changes")
    for part in ("lb_per_subject", "vs_per_subject"):
        maintain(spark, layout, part)
    lb, vs = _state(spark, layout, "lb_per_subject"), _state(spark, layout, "vs_per_subject")
    dm_log, done = _log(spark, layout, "clinical_dm"), log.last()
    done = -1 if done is None else done
    seen = _seen(spark, path, done, 3)
    now = [-1 if dm_log.last() is None else dm_log.last(), lb.applied(), vs.applied()]
    if now != seen:
        touched = dm_log.read(seen[0] + 1, now[0]).select("subject_id")
        for state, after in ((lb, seen[1]), (vs, seen[2])):
            touched = touched.unionByName(state.touched(after).select("subject_id"))
        dm = read_silver(spark, layout, "clinical_dm").join(touched.distinct(), "subject_id", "left_semi")
        rows = G.gold_subject_safety(G.subject_safety(dm, lb.mart(), vs.mart()))
        _claim(spark, path, done + 1, now)
        upsert_table(spark, gold, _staged(spark, rows), ["subject_id"], changes=log.path, version=done + 1)
    return read_gold(spark, layout, "gold_subject")


def read_gold(spark: SparkSession, layout: Layout, mart: str) -> DataFrame:
    return spark.read.parquet(layout.gold(mart)).drop(BUCKET_COL)


#: What the CAPA mart takes from a deviation.
CAPA_COLUMNS = ["deviation_id", "batch_id", "equipment_id", "deviation_type", "severity", "reported_date", "status", "sla_days", "days_to_closure"]


def _by_month(dev: DataFrame) -> DataFrame:
    return dev.withColumn("reported_month", F.date_format("reported_date", "yyyy-MM"))


def _attributed(dev: DataFrame, weights: DataFrame) -> DataFrame:
    """Deviations with the plants and drugs of their batch and how often each counts."""
    return _by_month(dev.join(weights, "batch_id", "left")).withColumn("__w", F.coalesce("__w", F.lit(1).cast("long")))


def _weights(lots: DataFrame) -> DataFrame:
    """Lot rows per (batch, plant, drug), of the distinct attributes that deviations are attributed by."""
    return lots.groupBy("batch_id", "plant_id", "drug_code").agg(F.count(F.lit(1)).alias("__w"))


def _of_batches(df: DataFrame, other: DataFrame) -> DataFrame:
    """Rows of ``df`` in batches of ``other``; they lie by batch then, where counts and joins by batch take them."""
    return df.join(other.select("batch_id").distinct(), "batch_id", "left_semi")


def _weight_changes(lot: DataFrame, d_lot: DataFrame, dev: DataFrame) -> DataFrame:
    """How many more lot rows per (batch, plant, drug) there are than before the signed rows ``d_lot``, for batches of ``dev``.

    A batch without lots counts once, without plant and drug.
    """
    keys, one = list(G.LOT_KEY_COLUMNS), F.lit(1).cast("long")
    touched = _of_batches(d_lot.select("batch_id"), dev)
    rows = lot.select(*keys, one.alias("__now"), one.alias("__was")).unionByName(
        d_lot.select(*keys, F.lit(0).cast("long").alias("__now"), (-F.col(SIGN)).alias("__was")))
    met = _of_batches(rows, touched).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("__now", "__was")])
    n = met.groupBy("batch_id", "plant_id", "drug_code").agg(*[F.count_if(F.col(c) > 0).alias(c) for c in ("__now", "__was")])
    more = F.struct("plant_id", "drug_code", (F.col("__now") - F.col("__was")).alias("__w"))
    by_batch = n.groupBy("batch_id").agg(F.collect_list(more).alias("__more"), *[F.sum(c).alias(c) for c in ("__now", "__was")])
    types = {f.name: f.dataType for f in lot.schema.fields}
    none = F.struct(*[F.lit(None).cast(types[c]).alias(c) for c in ("plant_id", "drug_code")],
                    ((F.col("__now") == 0).cast("long") - (F.col("__was") == 0).cast("long")).alias("__w"))
    return by_batch.select("batch_id", F.inline(F.concat("__more", F.array(none)))).filter("__w <> 0")


def _maintain_capa(spark: SparkSession, layout: Layout, state: RollupState) -> None:
    """G7: deviations that changed come and go with the plants and drugs of their batch as it is now; those that were
    there before come and go as often as the lots of their batch count more or less."""
    logs = [_log(spark, layout, t) for t in ("mfg_deviation", "mfg_lot")]
    now = [-1 if log.last() is None else log.last() for log in logs]
    seen = _seen(spark, state.path, state.applied(), 2)
    if now == seen:
        return
    d_dev, d_lot = (signed(log.read(s + 1, n)) for log, s, n in zip(logs, seen, now, strict=True))
    d_dev = d_dev.select(*CAPA_COLUMNS, SIGN)
    dev = read_silver(spark, layout, "mfg_deviation").select(*CAPA_COLUMNS)
    lot = read_silver(spark, layout, "mfg_lot").select(*G.LOT_KEY_COLUMNS)
    parts = []
    if now[1] > seen[1] and seen[0] >= 0:
        was = dev.withColumn(SIGN, F.lit(1).cast("long"))
        if now[0] > seen[0]:  # as they were: what is there now, less what came and with what went
            was = net(_of_batches(was.unionByName(d_dev.withColumn(SIGN, -F.col(SIGN))), d_lot))
        moved = was.join(_weight_changes(lot, d_lot, was), "batch_id")
        parts.append(_by_month(moved).withColumn(SIGN, F.col(SIGN) * F.col("__w")).drop("__w"))
    if now[0] > seen[0] or not parts:
        changed = _attributed(d_dev, _weights(_of_batches(lot, d_dev).distinct()))
        parts.append(changed.withColumn(SIGN, F.col(SIGN) * F.col("__w")).drop("__w"))
    rows = _staged(spark, reduce(DataFrame.unionByName, parts))
    base = _attributed(dev, _weights(_of_batches(lot.distinct(), dev)))
    rows, base = _encode(spark, layout, "gold_capa", rows, base)
    version = now[0] + now[1] + 2
    _claim(spark, state.path, version, now)
    state.apply(rows, version, base, weight="__w")
