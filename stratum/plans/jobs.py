"""Layer jobs: read one layer, write the next (the runnable form of the plans).

``bronze_job``  incremental CSV ingest of one feed (streaming, availableNow).
``silver_job``  bronze -> silver with the table's write mode: incremental
                keyed upsert into a hash-bucketed table (DM, QC, deviation,
                order; only new bronze files are read, latest ``__batch``
                wins), full refresh (LB, equipment, lot) or incremental
                streaming append (VS).
``gold_job``    silver -> gold mart, full refresh, optional partitioning.

Each job is one Spark write (plus the read of its inputs); there are no
intermediate actions.  Every path comes from a ``Layout`` rooted in shared
storage, so a lost executor only costs task retries.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.quality import dq_aggregates
from stratum.plans import gold as G
from stratum.plans import silver as S
from stratum.session import finer_splits
from stratum.sources.tables import Layout, load_schema, overwrite_table, read_table, replace_batches
from stratum.streaming.incremental import append_available, refresh_available, upsert_available
from stratum.streaming.ingest import BATCH_COL, FILE_COL, RESCUED_COL, ingest_available, read_bronze

# Bronze feed names (one ingest source folder each).
FEEDS = ["clinical_dm", "clinical_lb", "clinical_vs", "qc_lab_result", "mfg_order", "mfg_lot",
         "mfg_equipment_lot", "mfg_deviation"]

# silver table -> (bronze feed, transform(bronze, carry), write mode, keys).
# ``carry`` lists bronze columns to keep (the ingest batch id, by which the
# latest version of a key wins an upsert); cleaners of WATCHED tables also take
# ``watch``, which sees the rows with their flags.
Transform = Callable[..., DataFrame]
SILVER: dict[str, tuple[str, Transform, str, list[str]]] = {
    "clinical_dm": ("clinical_dm", lambda b, c, watch=None: S.dm_clean(b, watch), "upsert", S.KEYS["dm"]),
    "clinical_lb": ("clinical_lb", S.silver_lb, "overwrite", []),
    "clinical_vs": ("clinical_vs", S.silver_vs, "append", []),
    "qc_lab_result": ("qc_lab_result", S.qc_rows, "upsert", S.KEYS["qc"]),
    "mfg_order": ("mfg_order", lambda b, c: S.order_split(b, c)[0], "upsert", S.KEYS["order"]),
    "mfg_lot": ("mfg_lot", lambda b, c: S.silver_lot(b, carry=c), "overwrite", []),
    "mfg_equipment_log": ("mfg_equipment_lot", lambda b, c: S.silver_equipment(b, carry=c), "overwrite", []),
    "mfg_deviation": ("mfg_deviation", lambda b, c: S.deviation_clean(b, carry=c), "upsert",
                      S.KEYS["deviation"]),
}

# Silver tables stamped with a processing time (as in the reference).
# Flags counted while a table is written (``silver_job(metrics=True)``).
WATCHED = {"qc_lab_result": S.QC_FLAGS, "clinical_dm": S.DM_FLAGS, "clinical_lb": S.LB_FLAGS}

STAMP = "silver_processed_at"
STAMPED = {"clinical_lb", "clinical_vs", "qc_lab_result", "mfg_lot", "mfg_equipment_log",
           "mfg_deviation"}


def bronze_job(spark: SparkSession, layout: Layout, feed: str, src_dir: str, **kwargs) -> None:
    """Ingest new CSV files of ``feed`` from ``src_dir`` into bronze."""
    ingest_available(spark, src_dir, layout.bronze(feed), layout.checkpoint(f"bronze_{feed}"),
                     schema_store=layout.schema_store(feed), **kwargs)


def read_bronze_table(spark: SparkSession, layout: Layout, feed: str) -> DataFrame:
    """A bronze table; one that ingest wrote is read across its schema versions."""
    return read_bronze(spark, layout.bronze(feed), layout.schema_store(feed))


def bronze_schema(spark: SparkSession, layout: Layout, feed: str) -> T.StructType:
    """The feed's schema as ingest remembers it; for a table that ingest did
    not write, merged from its files."""
    known = load_schema(spark, layout.schema_store(feed))
    if known is None:
        return read_bronze_table(spark, layout, feed).schema
    return T.StructType([*known.fields, T.StructField(FILE_COL, T.StringType()),
                         T.StructField(RESCUED_COL, T.StringType()), T.StructField(BATCH_COL, T.LongType())])


def silver_job(spark: SparkSession, layout: Layout, table: str, buckets: int = 64,
               bucket: Column | None = None, merge_table: str | None = None, changes: bool = False,
               metrics: bool = False) -> None:
    """Build one silver table from its bronze feed with the table's write mode.

    Of an upserted table, ``bucket`` is the bucketing (``range_bucket`` for
    ids assigned in order; else ``buckets`` hash buckets), and ``merge_table``
    a catalog table to merge into by its format's own ``MERGE``; ``changes``
    keeps its change rows (``Layout.changes``), stamps left aside.  A table
    without a key is with ``changes`` not built anew but refreshed by ingest
    batch: only batches that changed are written.  ``metrics`` keeps the
    counts of quality flags (``Layout.metrics``), one row per micro-batch or
    full refresh; the write itself counts them.
    """
    finer_splits(spark)
    feed, transform, mode, keys = SILVER[table]
    dst = layout.silver(table)

    if metrics and table not in WATCHED:
        raise ValueError(f"{table} has no quality flags to count")
    seen: list[Observation] = []

    def build(b: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        if metrics:
            seen[:] = [Observation()]
            df = transform(b, carry, watch=lambda flagged: flagged.observe(seen[0], *dq_aggregates(WATCHED[table])))
        else:
            df = transform(b, carry)
        return S.with_audit(df) if table in STAMPED else df

    def keep_metrics(session: SparkSession, batch_id: int) -> None:
        if metrics:
            counts = {k: v for k, v in seen[0].get.items()}
            row = session.createDataFrame([tuple(counts.values())], ", ".join(f"{k} long" for k in counts))
            replace_batches(row.coalesce(1).withColumn(BATCH_COL, F.lit(batch_id).cast("long")), layout.metrics(table), [batch_id])

    ckpt = layout.checkpoint(f"silver_{table}")
    if mode == "overwrite" and not changes:
        overwrite_table(build(read_bronze_table(spark, layout, feed)), dst)
        keep_metrics(spark, 0)
        return
    # Only bronze rows not taken before are read; the ingest batch id orders
    # versions of a key (latest wins).
    schema = bronze_schema(spark, layout, feed)
    carry = [BATCH_COL] if BATCH_COL in schema.fieldNames() else []
    bronze_rows = lambda session: read_bronze_table(session, layout, feed)
    if mode != "upsert" and changes:
        refresh_available(spark, layout.bronze(feed), dst, ckpt, lambda b: build(b, carry), layout.changes(table),
                          schema=schema, ignore=[STAMP], after=keep_metrics, read=bronze_rows)
    elif mode == "append":
        append_available(spark, layout.bronze(feed), dst, ckpt, lambda b: build(b, carry), schema=schema, read=bronze_rows)
    else:
        upsert_available(spark, layout.bronze(feed), dst, ckpt, lambda b: build(b, carry), keys, order=carry,
                         buckets=buckets, schema=schema, bucket=bucket, merge_table=merge_table,
                         changes=layout.changes(table) if changes else None, ignore=[*carry, STAMP], after=keep_metrics, read=bronze_rows)


def read_silver(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    return read_table(spark, layout.silver(table), merge_schema=True)


# gold mart -> builder over the silver tables
def _gold_builders(spark: SparkSession, layout: Layout) -> dict[str, Callable[[], DataFrame]]:
    rs = lambda t: read_silver(spark, layout, t)

    def safety():
        return G.subject_safety(rs("clinical_dm"), G.lb_per_subject(rs("clinical_lb")),
                                G.vs_per_subject(rs("clinical_vs")))

    return {
        "qc_summary": lambda: G.qc_summary(rs("qc_lab_result")),
        "qc_trend": lambda: G.qc_trend(rs("qc_lab_result")),
        "qc_batch_quality": lambda: G.qc_batch_quality(rs("qc_lab_result")),
        "qc_analyst": lambda: G.qc_analyst(rs("qc_lab_result")),
        "gold_subject": lambda: G.with_audit(G.gold_subject_safety(safety())),
        "gold_demo_safety": lambda: G.with_audit(G.gold_demo_safety(safety())),
        "gold_capa": lambda: G.with_audit(G.gold_capa(rs("mfg_deviation"), rs("mfg_lot"))),
        "lot_summary": lambda: G.lot_summary(rs("mfg_lot")),
        "order_summary": lambda: G.order_summary(rs("mfg_order")),
    }


GOLD = ["qc_summary", "qc_trend", "qc_batch_quality", "qc_analyst", "gold_subject",
        "gold_demo_safety", "gold_capa", "lot_summary", "order_summary"]


def gold_job(spark: SparkSession, layout: Layout, mart: str,
             partition_by: Sequence[str] | None = None) -> None:
    """Rebuild one gold mart; e.g. ``partition_by=["study_id"]`` for the
    clinical marts so readers can prune by study."""
    overwrite_table(_gold_builders(spark, layout)[mart](), layout.gold(mart), partition_by)


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Run one layer job.")
    p.add_argument("--root", required=True, help="base folder of the layers (shared storage)")
    p.add_argument("--stage", required=True, choices=["bronze", "silver", "gold"])
    p.add_argument("--table", required=True)
    p.add_argument("--src", help="CSV source folder (bronze)")
    p.add_argument("--partition-by", nargs="*")
    p.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE",
                   help="extra Spark setting (repeatable), e.g. spark.sql.shuffle.partitions=20000")
    a = p.parse_args(argv)
    from stratum.session import get_session
    spark = get_session(extra=dict(kv.split("=", 1) for kv in a.conf))
    layout = Layout(a.root)
    if a.stage == "bronze":
        bronze_job(spark, layout, a.table, a.src)
    elif a.stage == "silver":
        silver_job(spark, layout, a.table)
    else:
        gold_job(spark, layout, a.table, a.partition_by)


if __name__ == "__main__":
    main()
