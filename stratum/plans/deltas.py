"""Registered queries of tables that are kept up to date by deliveries.

Each takes its deliveries from a benchmark table, writes through the library's
tables under the shared checkpoint folder, and returns what is read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.bitmaps import LabelIds, bitmaps, count_bitmaps, merge_bitmaps
from stratum.operators.changes import CHANGE_COL, DELIVERY_COL, ChangeLog
from stratum.operators.upsert import upsert_table
from stratum.plans import gold as G
from stratum.plans import jobs as J
from stratum.plans import silver as S
from stratum.plans.gold_state import SOURCES, maintain
from stratum.plans.oracle import ORACLE, QC, SILVER_DEVIATION, SILVER_DM, SILVER_LB, SILVER_LOT, _cte, _with
from stratum.session import apply_defaults, scratch_dir
from stratum.sources.adapters import bronze
from stratum.sources.catalog import LayerCatalog
from stratum.sources.tables import Layout, read_source, write_batch


def q_change_rows_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Change rows that an upserted table keeps: the latest order of each
    customer, some orders without one, in three deliveries.  The third comes
    twice; then the second comes again with fewer orders without a customer."""
    apply_defaults(spark)
    base = scratch_dir(spark, "change_rows_upsert")
    log = ChangeLog(spark, f"{base}/changes")
    o = read_source(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderkey", "o_totalprice", "o_orderdate",
        (F.col("o_orderkey") % 3).alias("delivery"))
    second = (F.col("delivery") == 1) & (F.col("o_orderkey") % 20 != 0)
    for version, rows in enumerate([F.col("delivery") == 0, F.col("delivery") == 1, F.col("delivery") == 2, second]):
        for _ in range(2 if version == 2 else 1):
            upsert_table(spark, f"{base}/orders", o.filter(rows), ["o_custkey"], ["o_orderdate", "o_orderkey"],
                         delivery="delivery", changes=log.path, version=version)
    return log.read().select(CHANGE_COL, F.col(DELIVERY_COL).alias("version"), "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")


# ---- marts kept up to date from change rows -------------------------------------
# Each feed comes in two deliveries.  The first is wrong in places, the second
# puts it right: keyed rows are updated, batches of un-keyed rows are rewritten.

def _wrong(df: DataFrame, col: str, value) -> DataFrame:
    return df.withColumn(col, F.lit(value).cast(df.schema[col].dataType))


def _deliver_keyed(spark: SparkSession, sf: str, lay: Layout, feed: str, table: str, part, col: str, value, after=None) -> None:
    """A part of the feed with wrong values, then the whole feed; ``after`` runs behind each delivery."""
    rows = bronze(spark, sf, f"bronze_{feed}")
    for n, b in enumerate([_wrong(rows.filter(part), col, value), rows]):
        write_batch(b, lay.bronze(feed), n)
        J.silver_job(spark, lay, table, buckets=8, changes=True)
        if after:
            after()


def _deliver_batches(spark: SparkSession, sf: str, lay: Layout, feed: str, table: str, part, col: str, value, after=None) -> None:
    """Two batches, the first with wrong values; then the first again as it should be, and the second once more as it was."""
    rows = bronze(spark, sf, f"bronze_{feed}")
    rest = rows.filter(~F.coalesce(part, F.lit(False)))
    write_batch(_wrong(rows.filter(part), col, value), lay.bronze(feed), 0)
    write_batch(rest, lay.bronze(feed), 1)
    J.silver_job(spark, lay, table, changes=True)
    if after:
        after()
    write_batch(rows.filter(part), lay.bronze(feed), 0)
    write_batch(rest, lay.bronze(feed), 1)
    J.silver_job(spark, lay, table, changes=True)
    if after:
        after()


def _kept(mart: str, deliver, feed: str, table: str, part: str, col: str, value) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        apply_defaults(spark)
        lay = Layout(scratch_dir(spark, f"kept_{mart}"))
        deliver(spark, sf, lay, feed, table, F.expr(part), col, value, after=lambda: maintain(spark, lay, mart))
        return maintain(spark, lay, mart)

    query.__doc__ = f"{mart} kept up to date over two deliveries of {feed}."
    return query


_QC = (_deliver_keyed, "qc_lab_result", "qc_lab_result", "batch_id % 3 = 0", "result_flag", "fail")
_LB = (_deliver_batches, "clinical_lb", "clinical_lb", "subject_id % 2 = 0", "test_value", 55.5)
_VS = (_deliver_batches, "clinical_vs", "clinical_vs", "subject_id % 2 = 0", "heart_rate", 190.0)
_LOT = (_deliver_batches, "mfg_lot", "mfg_lot", "batch_id % 2 = 0", "plant_id", "PLANT_X")
_ORDER = (_deliver_keyed, "mfg_order", "mfg_order", "order_id % 3 = 0", "status", "done")


def _subjects(spark: SparkSession, sf: str, mart: str) -> DataFrame:
    apply_defaults(spark)
    lay = Layout(scratch_dir(spark, f"kept_{mart}"))
    _LB[0](spark, sf, lay, *_LB[1:3], F.expr(_LB[3]), *_LB[4:])
    _VS[0](spark, sf, lay, *_VS[1:3], F.expr(_VS[3]), *_VS[4:])
    _deliver_keyed(spark, sf, lay, "clinical_dm", "clinical_dm", F.expr("subject_id % 3 = 0"), "country", "nowhere",
                   after=lambda: maintain(spark, lay, mart))
    return maintain(spark, lay, mart)


def q_kept_gold_subject(spark: SparkSession, sf: str) -> DataFrame:
    """The subject mart: only rows of subjects with a change are built and merged."""
    return _subjects(spark, sf, "gold_subject")


def q_kept_gold_demo_safety(spark: SparkSession, sf: str) -> DataFrame:
    """The demographic safety mart, from the change rows of the subject mart."""
    return _subjects(spark, sf, "gold_demo_safety")


def q_kept_gold_capa(spark: SparkSession, sf: str) -> DataFrame:
    """The CAPA mart: deviations updated, then their lots moved to other plants."""
    apply_defaults(spark)
    lay = Layout(scratch_dir(spark, "kept_gold_capa"))
    lots = bronze(spark, sf, "bronze_mfg_lot")
    write_batch(_wrong(lots, "plant_id", "PLANT_X"), lay.bronze("mfg_lot"), 0)
    J.silver_job(spark, lay, "mfg_lot", changes=True)
    _deliver_keyed(spark, sf, lay, "mfg_deviation", "mfg_deviation", F.expr("deviation_id % 2 = 0"), "severity", "CRITICAL",
                   after=lambda: maintain(spark, lay, "gold_capa"))
    write_batch(lots, lay.bronze("mfg_lot"), 0)
    J.silver_job(spark, lay, "mfg_lot", changes=True)
    return maintain(spark, lay, "gold_capa")


def _refreshed(table: str, *how) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        apply_defaults(spark)
        lay = Layout(scratch_dir(spark, f"refresh_{table}"))
        deliver, feed, name, part, col, value = how
        deliver(spark, sf, lay, feed, name, F.expr(part), col, value)
        return J.read_silver(spark, lay, table).drop("__batch", J.STAMP)

    query.__doc__ = f"Silver {table}, without a key, refreshed by rewritten batches."
    return query


_EQUIPMENT = (_deliver_batches, "mfg_equipment_lot", "mfg_equipment_log", "equipment_id < 'EQ_2'", "operator_id", "OP_X")


def q_dq_metrics_written(spark: SparkSession, sf: str) -> DataFrame:
    """Quality metrics of the QC feed, counted by the writes of its silver table."""
    apply_defaults(spark)
    lay = Layout(scratch_dir(spark, "dq_metrics"))
    rows = bronze(spark, sf, "bronze_qc_lab_result")
    for n in (0, 1):
        write_batch(rows.filter(F.col("batch_id") % 2 == n), lay.bronze("qc_lab_result"), n)
        J.silver_job(spark, lay, "qc_lab_result", buckets=8, metrics=True)
    kept = spark.read.parquet(lay.metrics("qc_lab_result")).drop("__batch")
    return kept.agg(*[F.sum(c).alias(c) for c in kept.columns])


def q_stamped_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Silver lots with their processing time, which lies in the run that wrote them."""
    apply_defaults(spark)
    lay = Layout(scratch_dir(spark, "stamped"))
    begun = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    write_batch(bronze(spark, sf, "bronze_mfg_lot"), lay.bronze("mfg_lot"), 0)
    J.silver_job(spark, lay, "mfg_lot")
    stamp = F.col(J.STAMP)
    return J.read_silver(spark, lay, "mfg_lot").select(
        "batch_id", "lot_id", "process_step", ((stamp >= F.lit(begun)) & (stamp <= F.current_timestamp())).alias("in_run"))


def q_bucketed_subject_safety(spark: SparkSession, sf: str) -> DataFrame:
    """The subject mart over silver tables in buckets of the subject keys: the facts are aggregated and joined
    where they lie."""
    apply_defaults(spark)
    cat = _catalog(spark, "bucketed")
    for table, rows in (("clinical_dm", S.silver_dm(bronze(spark, sf, "bronze_clinical_dm"))),
                        ("clinical_lb", S.silver_lb(bronze(spark, sf, "bronze_clinical_lb"))),
                        ("clinical_vs", S.silver_vs(bronze(spark, sf, "bronze_clinical_vs")))):
        cat.write_bucketed(rows, "silver", table, G.SUBJECT_KEYS, 8)
    dm, lb, vs = (cat.table("silver", t) for t in ("clinical_dm", "clinical_lb", "clinical_vs"))
    return G.gold_subject_safety(G.subject_safety(dm, G.lb_per_subject(lb), G.vs_per_subject(vs)))


def _catalog(spark: SparkSession, name: str) -> LayerCatalog:
    lay = Layout(scratch_dir(spark, name))
    cat = LayerCatalog(spark, lay, f"{lay.root.rsplit('/', 1)[1].replace('-', '_')}_")
    cat.create()
    return cat


def q_catalog_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Three layers read by name: QC tests as delivered, as cleaned and as summed up."""
    apply_defaults(spark)
    cat = _catalog(spark, "catalog")
    lay = cat.layout
    rows = bronze(spark, sf, "bronze_qc_lab_result")
    for n in (0, 1):
        write_batch(rows.filter(F.col("batch_id") % 2 == n), lay.bronze("qc_lab_result"), n)
    J.silver_job(spark, lay, "qc_lab_result", buckets=8)
    J.gold_job(spark, lay, "qc_summary")
    b, s, g = (cat.register(layer, t) for layer, t in (("bronze", "qc_lab_result"), ("silver", "qc_lab_result"), ("gold", "qc_summary")))
    return spark.sql(f"""SELECT g.test_name, g.total_tests, s.batches, b.delivered FROM {g} AS g
JOIN (SELECT test_name, count(DISTINCT batch_id) AS batches FROM {s} GROUP BY test_name) AS s ON s.test_name = g.test_name
LEFT JOIN (SELECT upper(test_name) AS test_name, count(*) AS delivered FROM {b} WHERE __batch IN (0, 1) GROUP BY 1) AS b
ON b.test_name = g.test_name""")


_DISTINCT = {"distinct_tests": ["study_id", "subject_id"], "affected_batches": ["plant_id", "drug_code", "reported_month"],
             "subject_count": ["study_id", "arm_group", "sex", "age_group", "country"]}


def q_distinct_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct counts from bitmaps stored by two deliveries of each feed, merged: tests of each subject, batches
    with deviations, subjects of each demographic group."""
    apply_defaults(spark)
    base = scratch_dir(spark, "distinct_merged")
    labs, dm = S.silver_lb(bronze(spark, sf, "bronze_clinical_lb")), S.silver_dm(bronze(spark, sf, "bronze_clinical_dm"))
    lots = G.lot_keys(S.silver_lot(bronze(spark, sf, "bronze_mfg_lot")), ["batch_id", "plant_id", "drug_code"])
    dev = S.silver_deviation(bronze(spark, sf, "bronze_mfg_deviation")).join(lots, "batch_id", "left").withColumn(
        "reported_month", F.date_format("reported_date", "yyyy-MM"))
    late = {"distinct_tests": F.month("test_date") > 6, "affected_batches": F.col("deviation_id") % 2 == 0, "subject_count": F.col("subject_id") % 5 < 2}
    names, out = LabelIds(spark, f"{base}/test_names"), []
    for measure, (rows, col) in {"distinct_tests": (labs, "test_id"), "affected_batches": (dev, "batch_id"), "subject_count": (dm, "subject_id")}.items():
        keys, path = _DISTINCT[measure], f"{base}/{measure}"
        for part in (rows.filter(late[measure]), rows.filter(~F.coalesce(late[measure], F.lit(False)))):
            if measure == "distinct_tests":
                names.extend(part.select("test_name"))
                part = names.encode(part, "test_name", col)
            bitmaps(part, keys, col).write.mode("append").parquet(path)
        counts = count_bitmaps(merge_bitmaps(spark.read.parquet(path), keys), keys, "n")
        out.append(counts.select(F.lit(measure).alias("measure"), F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys]).alias("grp"),
                                 F.col("n").cast("long").alias("distinct_count")))
    return out[0].unionByName(out[1]).unionByName(out[2])


def _distinct_sql(measure: str, col: str, rows: str) -> str:
    key = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in _DISTINCT[measure])
    return f"SELECT '{measure}' AS measure, {key} AS grp, count(DISTINCT {col}) AS distinct_count FROM {rows} GROUP BY ALL"


_STATES = "\n".join(f""", s{n} AS (SELECT * FROM o WHERE d <= {n} AND o_custkey IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)""" for n in (0, 1, 2))
_ROW = "o_custkey, o_orderkey, o_totalprice, o_orderdate"


def _step(n: int) -> str:
    kept = f"EXISTS (SELECT 1 FROM s{n - 1} p WHERE p.o_custkey = s{n}.o_custkey)"
    new = f"NOT EXISTS (SELECT 1 FROM s{n - 1} p WHERE p.o_orderkey = s{n}.o_orderkey)"
    gone = f"NOT EXISTS (SELECT 1 FROM s{n} q WHERE q.o_orderkey = s{n - 1}.o_orderkey)"
    return f"""UNION ALL SELECT CASE WHEN {kept} THEN 'update_postimage' ELSE 'insert' END AS _change_type, {n}, {_ROW} FROM s{n} WHERE {new}
UNION ALL SELECT 'update_preimage', {n}, {_ROW} FROM s{n - 1} WHERE {gone}
"""


DELTA_QUERIES = {
    "change_rows_upsert": q_change_rows_upsert,
    "dq_metrics_written": q_dq_metrics_written,
    "stamped_rows": q_stamped_rows,
    "bucketed_subject_safety": q_bucketed_subject_safety,
    "catalog_layers": q_catalog_layers,
    "distinct_merged": q_distinct_merged,
    "refresh_lb": _refreshed("clinical_lb", *_LB),
    "refresh_lot": _refreshed("mfg_lot", *_LOT),
    "refresh_equipment": _refreshed("mfg_equipment_log", *_EQUIPMENT),
    "kept_qc_summary": _kept("qc_summary", *_QC),
    "kept_qc_trend": _kept("qc_trend", *_QC),
    "kept_qc_batch_quality": _kept("qc_batch_quality", *_QC),
    "kept_qc_analyst": _kept("qc_analyst", *_QC),
    "kept_lb_per_subject": _kept("lb_per_subject", *_LB),
    "kept_vs_per_subject": _kept("vs_per_subject", *_VS),
    "kept_gold_subject": q_kept_gold_subject,
    "kept_gold_demo_safety": q_kept_gold_demo_safety,
    "kept_gold_capa": q_kept_gold_capa,
    "kept_lot_summary": _kept("lot_summary", *_LOT),
    "kept_order_summary": _kept("order_summary", *_ORDER),
}

DELTA_ORACLE = {
    "dq_metrics_written": ORACLE["dq_metrics_qc"],
    "stamped_rows": ORACLE["silver_lot"].replace("SELECT * FROM silver_lot", "SELECT batch_id, lot_id, process_step, true AS in_run FROM silver_lot"),
    "bucketed_subject_safety": ORACLE["gold_subject_safety"],
    "catalog_layers": QC + """SELECT s.test_name, s.total_tests, s.batches, b.delivered
FROM (SELECT test_name, count(*) AS total_tests, count(DISTINCT batch_id) AS batches FROM silver_qc GROUP BY test_name) s
LEFT JOIN (SELECT upper(test_name) AS test_name, count(*) AS delivered FROM bronze_qc_lab_result GROUP BY 1) b ON b.test_name = s.test_name""",
    "distinct_merged": _with(_cte("bronze_clinical_lb"), SILVER_LB, _cte("bronze_clinical_dm"), SILVER_DM, _cte("bronze_mfg_lot"),
                             SILVER_LOT, _cte("bronze_mfg_deviation"), SILVER_DEVIATION,
                             """lots AS (SELECT DISTINCT batch_id, plant_id, drug_code FROM silver_lot)""",
                             """enr AS (SELECT d.*, l.plant_id, l.drug_code, strftime(d.reported_date, '%Y-%m') AS reported_month
  FROM silver_deviation d LEFT JOIN lots l ON d.batch_id = l.batch_id)""")
    + " UNION ALL ".join([_distinct_sql("distinct_tests", "test_name", "silver_lb"), _distinct_sql("affected_batches", "batch_id", "enr"),
                          _distinct_sql("subject_count", "subject_id", "silver_dm")]),
    **{f"refresh_{k}": ORACLE[f"silver_{k}"] for k in ("lb", "lot", "equipment")},
    **{f"kept_{k}": ORACLE["gold_subject_safety" if k == "gold_subject" else k] for k in (*SOURCES, "gold_subject", "gold_demo_safety", "gold_capa")},
    "change_rows_upsert": f"""WITH o AS (SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS o_custkey, o_orderkey, o_totalprice,
  o_orderdate, o_orderkey % 3 AS d FROM orders)
{_STATES}
SELECT 'insert' AS _change_type, 0::BIGINT AS version, {_ROW} FROM s0
{_step(1)}{_step(2)}UNION ALL SELECT 'insert', d, {_ROW} FROM o WHERE o_custkey IS NULL
UNION ALL SELECT 'delete', 3, {_ROW} FROM o WHERE o_custkey IS NULL AND d = 1 AND o_orderkey % 20 = 0""",
}
