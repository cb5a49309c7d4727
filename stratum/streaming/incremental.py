"""Incremental bronze -> silver (Structured Streaming): append and upsert.

A silver table fed by append must only receive bronze rows it has not seen:
re-reading all of bronze and appending would duplicate every row on each
run.  Here the bronze Parquet table is a streaming file source, the silver
transformation is applied per micro-batch, and the Parquet file sink commits
each batch exactly once through its own log (``_spark_metadata``), so a
re-run with no new bronze files appends nothing.

A bronze table written by ingest batches (``write_batch``) marks each batch that
is complete.  The stream then reads these marks instead of the data files: a
batch is handled once, whole, however many files it has and however few a
trigger may take, and its silver partition is replaced.  A batch that is written
again is marked again, and its rows replace the ones from before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratum.operators.changes import ChangeLog
from stratum.operators.refresh import refresh_partitions
from stratum.operators.upsert import DEFAULT_BUCKETS, merge_into_table, upsert_table
from stratum.sources.tables import completed_batches, path_exists, replace_batches
from stratum.streaming.ingest import BATCH_COL

MERGE_COL = "__merge"
After = Callable[[SparkSession, int], None] | None
#: How to read the bronze table, if not as plain Parquet (a table whose types were widened).
Read = Callable[[SparkSession], DataFrame] | None


def _marks(spark: SparkSession, src: str, per_trigger: int) -> DataFrame | None:
    """Stream of the batches of ``src`` as they are completed; None for a table without such marks."""
    if not path_exists(spark, completed_batches(src)):
        return None
    return spark.readStream.schema("batch long").option("maxFilesPerTrigger", str(per_trigger)).parquet(completed_batches(src))


def _whole(session: SparkSession, src: str, schema, marks: DataFrame, read: Read = None) -> tuple[DataFrame, list[int]]:
    """The completed batches of a trigger, read once, and their ids (one per mark at most)."""
    ids = sorted(r[0] for r in marks.select("batch").distinct().collect())
    rows = read(session) if read is not None else session.read.schema(schema).parquet(src)
    return rows.filter(F.col(BATCH_COL).isin(ids)), ids


def append_incremental(spark: SparkSession, src: str, dst: str, checkpoint: str,
                       transform: Callable[[DataFrame], DataFrame],
                       max_files_per_trigger: int | None = 1000,
                       available_now: bool = True, schema=None, max_batches_per_trigger: int = 32,
                       read: Read = None) -> StreamingQuery:
    """Stream new Parquet files of ``src`` through ``transform`` into ``dst``.

    ``schema`` (the bronze schema) is read from the table as it is now when
    not given (``mergeSchema``), so columns added by ingest evolution are
    picked up on the next start.  With a ``__batch`` column the silver table
    has it too, as its partition; a ``transform`` that keeps it handles all
    batches of a trigger in one plan.  ``max_files_per_trigger`` is for tables
    without marks of completed batches.
    """
    schema = schema or spark.read.option("mergeSchema", "true").parquet(src).schema
    marks = _marks(spark, src, max_batches_per_trigger)

    def replace(batch: DataFrame, batch_id: int) -> None:
        whole, ids = _whole(batch.sparkSession, src, schema, batch, read)
        if not ids:
            return
        rows = transform(whole)
        if BATCH_COL not in rows.columns:
            parts = [transform(whole.filter(F.col(BATCH_COL) == i)).withColumn(BATCH_COL, F.lit(i).cast("long")) for i in ids]
            rows = reduce(DataFrame.unionByName, parts)
        replace_batches(rows, dst, ids)

    if marks is not None:
        writer = marks.writeStream.foreachBatch(replace)
    else:
        reader = spark.readStream.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        writer = transform(reader.parquet(src)).writeStream.format("parquet").outputMode("append").option("path", dst)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def refresh_incremental(spark: SparkSession, src: str, dst: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame],
                        changes: str, schema=None, max_batches_per_trigger: int = 32, ignore: Sequence[str] = (),
                        available_now: bool = True, after: After = None, read: Read = None) -> StreamingQuery:
    """Keep a silver table without a key in step with the completed batches of ``src``.

    ``dst`` is partitioned by ingest batch (``transform`` keeps ``__batch``).
    A new or rewritten batch is compared, row by row and copy by copy, with
    its silver partition; only partitions that changed are written, and their
    change rows go to ``changes``, numbered as the stream numbers them.
    """
    schema = schema or spark.read.option("mergeSchema", "true").parquet(src).schema
    marks = _marks(spark, src, max_batches_per_trigger)
    if marks is None:
        raise ValueError(f"{src} has no marks of completed batches: write it with write_batch")

    def refresh(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        whole, ids = _whole(session, src, schema, batch, read)
        if ids:
            ChangeLog(session, changes).claim(session.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"])
            if ChangeLog(session, changes).merged(batch_id):
                return
            refresh_partitions(session, dst, transform(whole), ids, BATCH_COL, changes, batch_id, ignore)
            if after is not None:
                after(session, batch_id)

    writer = marks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(refresh)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def refresh_available(spark: SparkSession, src: str, dst: str, checkpoint: str,
                      transform: Callable[[DataFrame], DataFrame], changes: str, **kwargs) -> None:
    """Run ``refresh_incremental`` until all completed batches are in step."""
    q = refresh_incremental(spark, src, dst, checkpoint, transform, changes, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def append_available(spark: SparkSession, src: str, dst: str, checkpoint: str,
                     transform: Callable[[DataFrame], DataFrame], **kwargs) -> None:
    """Run ``append_incremental`` until all present source files are done."""
    q = append_incremental(spark, src, dst, checkpoint, transform, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def upsert_incremental(spark: SparkSession, src: str, dst: str, checkpoint: str,
                       transform: Callable[[DataFrame], DataFrame], keys: Sequence[str],
                       order: Sequence[str] = (), buckets: int = DEFAULT_BUCKETS,
                       bucket: Column | None = None, max_files_per_trigger: int | None = 1000,
                       available_now: bool = True, schema=None, merge_table: str | None = None,
                       max_batches_per_trigger: int = 32, changes: str | None = None,
                       ignore: Sequence[str] = (), after: After = None, read: Read = None) -> StreamingQuery:
    """Upsert only the bronze rows not seen before into a keyed silver table.

    The bronze Parquet table is a streaming source (its completed batches, or
    its files); each micro-batch is cleaned by ``transform`` and merged with
    ``upsert_table`` (latest version per key by ``order``).  A run costs the
    new data plus the target buckets it touches, not the bronze history.  A
    micro-batch replayed after a failure, or an ingest batch written again,
    merges the same rows again, which leaves the table unchanged: rows with a
    NULL key carry their ingest batch (else the ids of stream and micro-batch)
    and are replaced.
    ``schema`` (the bronze schema) is read from the table when not given.
    ``changes`` keeps the change rows of every micro-batch there, numbered as
    the stream numbers them; ``ignore`` names columns that don't make a change.
    ``after`` is called when a micro-batch has been merged.
    With ``merge_table``, a catalog table whose format supports ``MERGE``, the
    batches go there by the format's own merge instead of to ``dst``.
    """
    schema = schema or spark.read.option("mergeSchema", "true").parquet(src).schema
    marks = _marks(spark, src, max_batches_per_trigger)

    def merge(batch: DataFrame, batch_id: int) -> None:
        session, delivery = batch.sparkSession, BATCH_COL
        if marks is not None:
            batch, ids = _whole(session, src, schema, batch, read)
            if not ids:
                return
        rows = transform(batch)
        if merge_table is not None:
            merge_into_table(merge_table, rows, keys, order)
            return
        stream = session.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]
        if changes is not None:
            ChangeLog(session, changes).claim(stream)
            if ChangeLog(session, changes).merged(batch_id):
                return
        if marks is None or BATCH_COL not in rows.columns:
            rows, delivery = rows.withColumn(MERGE_COL, F.lit(f"{stream}/{batch_id}")), MERGE_COL
        upsert_table(session, dst, rows, keys, order, buckets, bucket, delivery, changes,
                     batch_id if changes is not None else None, ignore)
        if after is not None:
            after(session, batch_id)

    if marks is not None:
        source = marks
    else:
        reader = spark.readStream.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        source = reader.parquet(src)
    writer = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def upsert_available(spark: SparkSession, src: str, dst: str, checkpoint: str,
                     transform: Callable[[DataFrame], DataFrame], keys: Sequence[str],
                     **kwargs) -> None:
    """Run ``upsert_incremental`` until all present bronze files are merged."""
    q = upsert_incremental(spark, src, dst, checkpoint, transform, keys, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
