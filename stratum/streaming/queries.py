"""Registered queries that exercise streaming ingest and incremental append.

Each query writes its inputs (derived from the benchmark tables) as files
under a fresh folder in the shared checkpoint root, runs the streams with
``availableNow`` (twice, to show a re-run adds nothing), and returns the
resulting table read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.plans import silver as S
from stratum.plans.oracle import VS, _cte, _with
from stratum.session import apply_defaults, scratch_dir
from stratum.sources.adapters import bronze
from stratum.sources.tables import append_table, read_source, write_batch
from stratum.streaming.incremental import append_available
from stratum.streaming.ingest import FILE_COL, RESCUED_COL, ingest_available, read_bronze

# Declared bronze contract of the order feed (types after ingest).
ORDER_CONTRACT = [("order_id", "bigint"), ("batch_id", "bigint"), ("drug_code", "string"),
                  ("planned_qty", "double"), ("actual_qty", "double"), ("start_date", "date"),
                  ("end_date", "date"), ("status", "string"), ("priority", "string"),
                  ("created_by", "string"), ("created_at", "timestamp_ntz")]
FIRST_COLS = ["order_id", "batch_id", "drug_code", "planned_qty", "actual_qty", "start_date",
              "end_date", "status"]
# The second batch adds three columns, one of them between known ones.
SECOND_COLS = ["order_id", "priority", "batch_id", "drug_code", "planned_qty", "actual_qty",
               "start_date", "end_date", "status", "created_by", "created_at"]
SPLIT_DATE = "1998-01-01"


def _typed(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in ORDER_CONTRACT],
                     F.col(FILE_COL).isNotNull().alias("has_lineage"))


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", "true").csv(path)


def q_ingest_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Order feed as CSV files -> incremental ingest -> bronze, typed."""
    apply_defaults(spark)
    base = scratch_dir(spark, "ingest_roundtrip")
    src, table, ckpt = f"{base}/src", f"{base}/bronze", f"{base}/_checkpoint"
    _write_csv(bronze(spark, sf, "bronze_mfg_order"), src)
    ingest_available(spark, src, table, ckpt)
    ingest_available(spark, src, table, ckpt)          # no new files: adds nothing
    return _typed(read_bronze(spark, table))


def q_ingest_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """Two CSV drops; the second adds columns (one in the middle)."""
    apply_defaults(spark)
    base = scratch_dir(spark, "ingest_evolution")
    src, table, ckpt = f"{base}/src", f"{base}/bronze", f"{base}/_checkpoint"
    orders = bronze(spark, sf, "bronze_mfg_order")
    early = F.col("start_date") < F.lit(SPLIT_DATE).cast("date")
    _write_csv(orders.filter(early).select(*FIRST_COLS), src)
    ingest_available(spark, src, table, ckpt)
    _write_csv(orders.filter(~F.coalesce(early, F.lit(False))).select(*SECOND_COLS), src)
    ingest_available(spark, src, table, ckpt)
    return _typed(read_bronze(spark, table))


def q_vs_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Vitals bronze arriving in two drops, streamed into silver: each bronze
    row reaches silver exactly once however often the stream runs."""
    apply_defaults(spark)
    base = scratch_dir(spark, "vs_incremental")
    src, dst, ckpt = f"{base}/bronze_vs", f"{base}/silver_vs", f"{base}/_checkpoint"
    vs = bronze(spark, sf, "bronze_clinical_vs")
    early = F.col("visit_date") < F.lit("2024-01-16").cast("date")
    append_table(vs.filter(early), src)
    append_available(spark, src, dst, ckpt, S.silver_vs)
    append_available(spark, src, dst, ckpt, S.silver_vs)   # re-run: nothing new
    append_table(vs.filter(~F.coalesce(early, F.lit(False))), src)
    append_available(spark, src, dst, ckpt, S.silver_vs)
    return spark.read.parquet(dst)


def q_ingest_type_change(spark: SparkSession, sf: str) -> DataFrame:
    """Order amounts come as whole numbers first, later partly with cents, and
    in the last drop beside a new column: what does not fit is rescued."""
    apply_defaults(spark)
    base = scratch_dir(spark, "ingest_type_change")
    src, table, ckpt = f"{base}/src", f"{base}/bronze", f"{base}/_checkpoint"
    orders = read_source(spark, sf, "orders")
    amount = F.when(F.col("o_orderkey") % 3 == 0, F.floor("o_totalprice").cast("string")).otherwise(
        F.col("o_totalprice").cast("decimal(15,2)").cast("string"))
    for part in (0, 1, 2):
        rows = orders.filter(F.col("o_orderkey") % 3 == part).select("o_orderkey", amount.alias("amount"), *([F.lit("late").alias("note")] if part == 2 else []))
        _write_csv(rows, src)
        ingest_available(spark, src, table, ckpt)
    rescued = F.get_json_object(RESCUED_COL, "$.amount").cast("double")
    return read_bronze(spark, table).select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                                            F.col("amount").cast("bigint").alias("amount"),
                                            rescued.alias("rescued_amount"), "note")


def q_ingest_type_widening(spark: SparkSession, sf: str) -> DataFrame:
    """The same amounts: the second drop is ingested as it was, so that cents are rescued; the third widens the
    column.  Read across the versions, every amount is in its column and nothing is rescued."""
    apply_defaults(spark)
    base = scratch_dir(spark, "ingest_type_widening")
    src, table, ckpt = f"{base}/src", f"{base}/bronze", f"{base}/_checkpoint"
    orders = read_source(spark, sf, "orders")
    amount = F.when(F.col("o_orderkey") % 3 == 0, F.floor("o_totalprice").cast("string")).otherwise(
        F.col("o_totalprice").cast("decimal(15,2)").cast("string"))
    for part in (0, 1, 2):
        _write_csv(orders.filter(F.col("o_orderkey") % 3 == part).select("o_orderkey", amount.alias("amount")), src)
        ingest_available(spark, src, table, ckpt, widen=part == 2)
    rows = read_bronze(spark, table, ckpt + "_schema")
    return rows.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "amount", RESCUED_COL)


HEADERS = 500


def q_ingest_many_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in 500 CSV files, no two with the same header (columns turned round, one of its own), in one batch."""
    apply_defaults(spark)
    base = scratch_dir(spark, "ingest_headers")
    src, table, ckpt = f"{base}/src", f"{base}/bronze", f"{base}/_checkpoint"
    k = (F.col("o_orderkey") % HEADERS).cast("int")
    orders = read_source(spark, sf, "orders").withColumn("k", k)
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    own = F.concat(F.lit("t"), F.col("k").cast("string"))

    def turned(fields):
        fields = F.array(*fields)
        return F.array_join(F.concat(F.slice(fields, k % 6 + 1, 6), F.slice(fields, F.lit(1), k % 6)), ",", "")

    k = F.col("k")
    heads = orders.select("k").distinct().select("k", F.lit(0).alias("line"), turned([*map(F.lit, cols), own]).alias("value"))
    lines = orders.select("k", F.lit(1).alias("line"), turned([*[F.col(c).cast("string") for c in cols], own]).alias("value"))
    # a file per k, its header first
    rows = heads.unionByName(lines).repartition("k").sortWithinPartitions("k", "line")
    rows.select("k", "value").write.partitionBy("k").text(f"{src}")
    ingest_available(spark, src, table, ckpt, glob="*.txt")
    bronze_rows = read_bronze(spark, table, ckpt + "_schema")
    tags = [c for c in bronze_rows.columns if c.startswith("t")]
    return bronze_rows.select(*[F.col(c).cast(t).alias(c) for c, t in zip(cols, ("bigint", "bigint", "string", "double", "string"), strict=True)],
                              F.coalesce(*tags).alias("tag"))


def q_vs_replay(spark: SparkSession, sf: str) -> DataFrame:
    """A bronze batch is written again under new file names after silver has
    read it: silver has each row once."""
    apply_defaults(spark)
    base = scratch_dir(spark, "vs_replay")
    src, dst, ckpt = f"{base}/bronze_vs", f"{base}/silver_vs", f"{base}/_checkpoint"
    vs = bronze(spark, sf, "bronze_clinical_vs")
    early = F.coalesce(F.col("visit_date") < F.lit("2024-01-16").cast("date"), F.lit(False))
    for rows, batch in ((vs.filter(early), 0), (vs.filter(~early), 1), (vs.filter(early), 0)):
        write_batch(rows, src, batch)
        append_available(spark, src, dst, ckpt, S.silver_vs)
    return spark.read.parquet(dst).drop("__batch")


_ORDER_SQL = ("SELECT order_id, batch_id, drug_code, planned_qty, actual_qty, start_date, end_date, status, "
              "{late}priority, {late}created_by, {late}created_at, true AS has_lineage FROM bronze_mfg_order")

STREAM_QUERIES = {
    "ingest_roundtrip": q_ingest_roundtrip,
    "ingest_evolution": q_ingest_evolution,
    "ingest_type_change": q_ingest_type_change,
    "ingest_type_widening": q_ingest_type_widening,
    "ingest_many_headers": q_ingest_many_headers,
    "vs_incremental": q_vs_incremental,
    "vs_replay": q_vs_replay,
}

_LATE = f"CASE WHEN start_date < DATE '{SPLIT_DATE}' THEN NULL ELSE {{c}} END AS {{c}}"

STREAM_ORACLE = {
    "ingest_roundtrip": _with(_cte("bronze_mfg_order")) + _ORDER_SQL.format(late=""),
    "ingest_evolution": _with(_cte("bronze_mfg_order"))
    + ("SELECT order_id, batch_id, drug_code, planned_qty, actual_qty, start_date, end_date, status, "
       + ", ".join(_LATE.format(c=c) for c in ("priority", "created_by", "created_at"))
       + ", true AS has_lineage FROM bronze_mfg_order"),
    "ingest_type_change": """SELECT o_orderkey,
       CASE WHEN o_orderkey % 3 = 0 OR p = floor(p) AND o_orderkey % 3 = 2 THEN CAST(floor(p) AS BIGINT) END AS amount,
       CASE WHEN o_orderkey % 3 = 0 OR p = floor(p) AND o_orderkey % 3 = 2 THEN NULL ELSE p END AS rescued_amount,
       CASE WHEN o_orderkey % 3 = 2 THEN 'late' END AS note
FROM (SELECT o_orderkey, o_totalprice AS p FROM orders)""",
    "ingest_type_widening": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN floor(o_totalprice) ELSE o_totalprice END AS amount,
       NULL AS __rescued FROM orders""",
    "ingest_many_headers": f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
       't' || CAST(o_orderkey % {HEADERS} AS VARCHAR) AS tag FROM orders""",
    "vs_incremental": VS + "SELECT * FROM silver_vs",
    "vs_replay": VS + "SELECT * FROM silver_vs",
}
