"""Keyed upsert ("update all / insert all") and row-level change output on
plain Parquet, as DataFrame recipes.

``upsert``         merged DataFrame: target rows whose key the source does
                   not carry, plus the (deduplicated) source rows.
``upsert_table``   the same against a Parquet table hash-bucketed by key:
                   only buckets the source touches are read and rewritten
                   (dynamic partition overwrite).  With hash buckets a
                   batch of more keys than buckets touches all of them.
``upsert_table`` can also keep the change rows of every delivery
(``stratum.operators.changes``).

Match semantics are SQL equality: a NULL key never matches, so a target row
with a NULL key is kept and a source row with a NULL key is inserted.  Pass
``delivery``, a column that names the delivery a row came with, and a delivery
merged again replaces the NULL-key rows that it inserted before.
Limits: one writer at a time; readers during a rewrite may see a mix of old
and new buckets (no snapshot isolation on plain Parquet), and a failure
while the rewritten buckets are put in place can lose their rows: restore
them by a full rebuild from bronze.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.changes import CHANGE_COL, DELIVERY_COL, INSERT, ChangeLog, merge_events, multiset_changes
from stratum.operators.dedup import latest_per_key
from stratum.operators.quality import any_null
from stratum.session import scratch_dir
from stratum.sources.tables import folder_bytes, load_schema, path_exists, save_schema

BUCKET_COL = "__b"
DEFAULT_BUCKETS = 64
#: Bucket ids of a batch come to the driver as a partition filter; a batch that touches more is refused.
MAX_TOUCHED = 100_000
#: Bytes of a bucket from which a merge warns.
LARGE_BUCKET = 8 << 30
#: Rows of a bucket that are merged in one place.
PART_ROWS = 500_000
#: Rows from which each part gets a shuffle partition of its own, so that these are of one size.
MANY_ROWS = 2_000_000
#: Such partitions at most: up to here (``spark.shuffle.sort.bypassMergeThreshold``) a task writes the rows it
#: shuffles as they come; with more it would hold them all, or spill.
MAX_PLACES = 200
#: Rows from which they go to their places through a staged table in Spark's own buckets, not a shuffle: staged
#: columns, compressed, take a fraction of shuffled rows, but about twice the CPU.
STAGED_ROWS = 500_000_000
#: Rows of a staged bucket, which one task merges; they differ, by the parts that meet there.
STAGED_BUCKET_ROWS = 1_000_000
#: Parts that share a staged bucket, on average.
STAGED_PARTS = 6
#: Staged buckets at most, as a task writes all at a time; with more rows the buckets get larger.
STAGED_WRITERS = 512


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           order: Sequence[str] = (), dedup: bool = True) -> DataFrame:
    """Rows of ``target`` with those of ``source`` merged in by key.

    With ``order``, the latest version of a key wins whichever side it comes
    from (a tie goes to the source), so a version that arrives late replaces
    nothing newer.  Without it, the source's row replaces the target's.
    """
    keys = list(keys)
    if order:
        both = target.withColumn("__new", F.lit(False)).unionByName(
            source.withColumn("__new", F.lit(True)), allowMissingColumns=True)
        return latest_per_key(both, keys, [*order, "__new"]).drop("__new")
    src = latest_per_key(source, keys, order) if dedup else source
    # left_anti never multiplies target rows, so the source keys need no
    # separate distinct; AQE picks broadcast vs. sort-merge from real sizes
    # and splits a skewed target partition.
    kept = target.join(src.select(*keys), keys, "left_anti")
    return kept.unionByName(src, allowMissingColumns=True)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when there is none yet (no folder, or
    a folder without data files, e.g. left by a first load that failed)."""
    if not path_exists(spark, path):
        return None
    if (schema := load_schema(spark, _schema_store(path))) is not None:
        return spark.read.schema(schema).parquet(path)
    try:
        # Buckets rewritten after a column was added carry it, older ones do
        # not: merge the file schemas so no column is lost on the next rewrite.
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException:
        return None


def _schema_store(path: str) -> str:
    return f"{path.rstrip('/')}__schema"


def _remember_schema(df: DataFrame, path: str) -> T.StructType:
    """Keep the table's schema beside it (columns are only ever added), so a
    later merge needs no pass over the file footers."""
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    if load_schema(df.sparkSession, _schema_store(path)) != schema:
        save_schema(df.sparkSession, _schema_store(path), schema, len(schema))
    return schema


def _check_bucketing(spark: SparkSession, path: str, spec: str) -> None:
    """Store the table's bucketing on first use; refuse a different one."""
    beside = f"{path.rstrip('/')}__buckets"
    if not path_exists(spark, beside):
        spark.createDataFrame([(spec,)], "spec string").coalesce(1).write.parquet(beside)
    elif (was := spark.read.parquet(beside).first()["spec"]) != spec:
        raise ValueError(f"the table at {path} is bucketed by {was}, not by {spec}")


def range_bucket(key: str, width: int) -> Column:
    """Bucket of a monotonically assigned numeric key: ``floor(key / width)``.
    New keys land in new buckets and updates to recent keys touch few, so a
    batch rewrites about its own key range instead of the whole table."""
    return F.floor(F.col(key) / F.lit(width)).cast("long")


def _bucket_rows(df: DataFrame) -> dict:
    """Rows by bucket."""
    return {r[0]: r[1] for r in df.groupBy(BUCKET_COL).count().collect()}


def _both(target: DataFrame, src: DataFrame) -> DataFrame:
    """Rows of both, those of the source marked ``__new``; the source's columns come first, as ties go by their order."""
    return src.withColumn("__new", F.lit(True)).unionByName(target.withColumn("__new", F.lit(False)), allowMissingColumns=True)


def _all_columns(target: DataFrame, src: DataFrame) -> list[str]:
    return list(dict.fromkeys([*target.columns, *src.columns]))


def _spread(df: DataFrame, keys: Sequence[str], sizes: dict) -> DataFrame:
    """Rows of a bucket in one place, or in parts (``__part``) by key if it has many; rows without a key in any."""
    parts, rows, spark = 1 + max(sizes.values(), default=0) // PART_ROWS, sum(sizes.values()), df.sparkSession
    places = max(spark.sparkContext.defaultParallelism, 1 + rows // PART_ROWS)
    own = F.when(any_null(keys), F.monotonically_increasing_id())
    by_key = F.xxhash64(F.lit("part"), *[F.col(k) for k in keys], own)
    if rows >= STAGED_ROWS:
        places = min(STAGED_WRITERS, max(spark.sparkContext.defaultParallelism, 1 + rows // STAGED_BUCKET_ROWS))
        parts = max(parts, -(-places * STAGED_PARTS // len(sizes)))
    elif rows >= MANY_ROWS and isinstance(df.schema[BUCKET_COL].dataType, T.IntegralType):
        # parts numbered through the buckets; a number is its rows' partition
        parts = max(1, min(places, MAX_PLACES) // len(sizes))
        places = min(parts * len(sizes), MAX_PLACES)
        part = F.pmod(F.coalesce(F.col(BUCKET_COL), F.lit(0)).cast("long") * parts + F.pmod(by_key, F.lit(parts)), F.lit(places))
        return df.withColumn("__part", part.cast("int")).repartitionById(places, F.col("__part"))
    df = df.withColumn("__part", F.pmod(by_key, F.lit(parts)).cast("int"))
    by = [BUCKET_COL, "__part"]
    return _staged_buckets(df, by, places) if rows >= STAGED_ROWS else df.repartition(*by)


def _staged_buckets(df: DataFrame, by: Sequence[str], buckets: int) -> DataFrame:
    """``df`` written as a scratch table in ``buckets`` buckets of ``by``: an aggregation that groups by
    these columns, too, needs no exchange."""
    spark = df.sparkSession
    path = scratch_dir(spark, "buckets")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    limit, before = "spark.sql.maxConcurrentOutputFileWriters", spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    spark.conf.set(limit, str(buckets + 1))  # a task that reaches the limit sorts its other rows, and may spill
    try:
        (df.write.format("parquet").option("compression", "zstd").option("path", path)
           .bucketBy(buckets, *by).saveAsTable(name))
    finally:
        spark.conf.set(limit, before)
    staged = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name alone: what was resolved reads the files, which stay
    return staged


def _at(keys: Sequence[str]) -> list[str]:
    """Keys and bucket, which few rows differ in: sorted by last."""
    return [*keys, *([] if BUCKET_COL in keys else [BUCKET_COL])]


def _latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], sizes: dict) -> DataFrame:
    """``latest_per_key`` of rows with their bucket, left where a write by bucket wants them."""
    return latest_per_key(df, _at(keys), order, spread=lambda rows: _spread(rows, keys, sizes))


def _merge_logged(log: ChangeLog, version: int, target: DataFrame, src: DataFrame, keys: Sequence[str], order: Sequence[str],
                  replaced: DataFrame | None, ignore: Sequence[str], sizes: dict, bucket: Column) -> DataFrame:
    """The merged rows, after the change rows were written; both come from one pass, whose other rows the log holds meanwhile."""
    keyed, unkeyed = ~any_null(keys), any_null(keys)
    both = _both(target.filter(keyed), src.filter(keyed))
    events = merge_events(both, _at(keys), order, "__new", ignore=ignore, spread=lambda rows: _spread(rows, keys, sizes))
    events = events.drop("__kept", BUCKET_COL)
    gone = target.limit(0) if replaced is None else replaced
    loose = multiset_changes(gone.drop(BUCKET_COL), src.filter(unkeyed).drop(BUCKET_COL), CHANGE_COL, ignore)
    log.write(events.unionByName(loose, allowMissingColumns=True), version)
    kept = log.after(version).filter(keyed).drop(CHANGE_COL, DELIVERY_COL).withColumn(BUCKET_COL, bucket)
    return (kept.unionByName(target.filter(unkeyed), allowMissingColumns=True)
                .unionByName(src.filter(unkeyed), allowMissingColumns=True).select(*_all_columns(target, src)))


def upsert_table(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
                 order: Sequence[str] = (), buckets: int = DEFAULT_BUCKETS,
                 bucket: Column | None = None, delivery: str | None = None, changes: str | None = None,
                 version: int | None = None, ignore: Sequence[str] = ()) -> DataFrame:
    """Upsert ``source`` into the bucketed Parquet table at ``path``.

    Creates the table on first load.  Otherwise the distinct bucket ids of the
    batch become a static partition filter, so only the touched bucket folders
    of the target are listed, read and rewritten.  Rows of batch and target go
    once, by a shuffle or, if they are many, a staged bucketed table, to their
    bucket and part of a bucket, where they are deduplicated and merged and from
    where they are written.  ``source`` is read twice (for the rows of each
    bucket, then for the merge): stage one that is expensive.

    Bucketing is a property of the table: it is stored beside it
    (``<path>__buckets``) and another one is refused.  The default is ``pmod(xxhash64(keys), buckets)``: even sizes,
    but a batch with many more keys than buckets touches every bucket.  For
    keys with locality (ids assigned in order, keys that embed a date) pass
    ``bucket=range_bucket(...)`` or another expression of the key columns
    only; a batch then rewrites roughly its own key range.

    ``delivery`` is a column of ``source``; each of its values names a
    delivery that ``source`` holds whole.  Merged again, a delivery replaces
    the NULL-key rows it inserted before.

    ``changes`` is where to keep the change rows (``ChangeLog``) that this
    delivery, numbered ``version``, makes: inserts, pre- and post-images, and
    deletes of replaced NULL-key rows, found in the touched buckets alone.
    They are written before the table.  A version merged before is a replay
    and changes neither the table nor its change rows.  Columns in ``ignore``
    (stamps) don't make a change.
    Returns the table as read back after the write.
    """
    keys = list(keys)
    log = ChangeLog(spark, changes) if changes is not None else None
    if log is not None:
        if version is None:
            raise ValueError("change rows are kept by delivery: give its version")
        if log.merged(version):
            return _read_or_none(spark, path)
    _check_bucketing(spark, path, str(bucket) if bucket is not None else f"hash {buckets} of {', '.join(keys)}")
    bucket_col = bucket if bucket is not None else bucket_of(keys, buckets)
    src = source.withColumn(BUCKET_COL, bucket_col)
    target, sizes = _read_or_none(spark, path), _bucket_rows(src)
    if target is None:
        merged = _latest(src, keys, order, sizes)  # first load: nothing to merge with
        if log is not None:               # every row is an insert; the table is written from them
            if not log.written(version):
                log.write(merged.drop(BUCKET_COL).withColumn(CHANGE_COL, F.lit(INSERT)), version)
            merged = log.read(version, version).select(*source.columns).withColumn(BUCKET_COL, bucket_col)
    else:
        hit = list(sizes)
        if not hit:
            if log is not None:
                log.write(src.drop(BUCKET_COL).withColumn(CHANGE_COL, F.lit(INSERT)), version)
                log.finish(version)
            return target
        if len(hit) > MAX_TOUCHED:
            raise ValueError(f"the batch touches {len(hit)} buckets of {path}, more than {MAX_TOUCHED}: use wider buckets")
        if path_exists(spark, first := f"{path.rstrip('/')}/{BUCKET_COL}={hit[0]}") and folder_bytes(spark, first) > LARGE_BUCKET:
            warnings.warn(f"a bucket of {path} has over {LARGE_BUCKET} bytes, which each batch that touches it rewrites: "
                          "rebuild the table with more buckets", stacklevel=2)
        target_hit, replaced = target.filter(F.col(BUCKET_COL).isin(hit)), None
        for b, n in _bucket_rows(target_hit).items():
            sizes[b] = sizes.get(b, 0) + n
        if delivery is not None and delivery in target.columns:
            come = src.select(delivery).distinct()
            replaced = target_hit.filter(any_null(keys)).join(come, delivery, "left_semi").select(*target_hit.columns)
            unkeyed = target_hit.filter(any_null(keys)).join(come, delivery, "left_anti").select(*target_hit.columns)
            target_hit = target_hit.filter(~any_null(keys)).unionByName(unkeyed)
        if log is not None and not log.written(version):
            merged = _merge_logged(log, version, target_hit, src, keys, order, replaced, ignore, sizes, bucket_col)
        else:
            merged = _latest(_both(target_hit, src), keys, [*order, "__new"], sizes).select(*_all_columns(target_hit, src))
    schema = _remember_schema(merged, path)
    (merged.write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic")
           .partitionBy(BUCKET_COL)
           .parquet(path))
    if log is not None:
        log.finish(version)
    return spark.read.schema(schema).parquet(path)


def merge_into_table(table: str, source: DataFrame, keys: Sequence[str],
                     order: Sequence[str] = ()) -> None:
    """Upsert into a catalog table whose format supports ``MERGE`` (e.g. a
    Delta or Iceberg table): same semantics as ``upsert_table`` -- the batch
    is deduplicated to its latest row per key, matched rows are replaced,
    new keys inserted, a NULL key never matches -- executed by the format's
    own merge (file-level rewrite, snapshot isolation).  Plain Parquet tables
    reject ``MERGE``; use ``upsert_table`` for those."""
    keys = list(keys)
    src = latest_per_key(source, keys, order).alias("s")
    cond = None
    for k in keys:
        p = F.col(f"t.{k}") == F.col(f"s.{k}")
        cond = p if cond is None else (cond & p)
    (src.mergeInto(table, cond)
        .whenMatched().updateAll()
        .whenNotMatched().insertAll()
        .merge())
