"""Table layout and batch reads / writes (Parquet directories).

A layer is a folder; a table is a Parquet directory inside it.  Readers are
plain ``spark.read.parquet`` so Catalyst prunes columns and pushes filters
into the scan; writers are full-refresh overwrite (optionally partitioned)
or append.  Keyed upsert lives in ``stratum.operators.upsert``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.session import finer_splits

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the Hadoop file system that Spark
    itself uses for it (local, HDFS or an object store)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return bool(hpath.getFileSystem(conf).exists(hpath))


def touch(spark: SparkSession, path: str) -> None:
    """Create the empty file ``path``: a mark that something is complete."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hpath, True).close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete the folder or file ``path``, if there is one."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in ``folder`` (none if it does not exist), hidden ones left out."""
    if not path_exists(spark, folder):
        return []
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(hpath)
    names = [f.getPath().getName() for f in found]
    return [n for n in names if not n.startswith(".")]


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of all files in ``folder``."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(hpath).getLength()


def load_schema(spark: SparkSession, store: str) -> T.StructType | None:
    """Latest remembered schema in ``store`` (None before the first batch)."""
    if not path_exists(spark, store):
        return None
    rows = (spark.read.text(store)
            .select(F.col("v").cast("long").alias("v"), "value")
            .orderBy(F.col("v").desc()).limit(1).collect())
    return T.StructType.fromJson(json.loads(rows[0]["value"])) if rows else None


def load_versions(spark: SparkSession, store: str) -> list[tuple[int, T.StructType]]:
    """All remembered schemas in ``store`` with their versions, oldest first."""
    if not path_exists(spark, store):
        return []
    rows = spark.read.text(store).select(F.col("v").cast("long").alias("v"), "value").orderBy("v").collect()
    return [(r["v"], T.StructType.fromJson(json.loads(r["value"]))) for r in rows]


def save_schema(spark: SparkSession, store: str, schema: T.StructType, version: int) -> None:
    """Write a new schema version (``store/v=<version>``); older versions stay."""
    (spark.createDataFrame([(schema.json(),)], "value string")
          .coalesce(1).write.mode("overwrite").text(f"{store.rstrip('/')}/v={version}"))


def read_source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One benchmark table, ``<sf_dir>/<table>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


@dataclass(frozen=True)
class Layout:
    """Directory roots of the three layers under one base path."""

    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def bronze(self, table: str) -> str:
        return self.path(BRONZE, table)

    def silver(self, table: str) -> str:
        return self.path(SILVER, table)

    def gold(self, table: str) -> str:
        return self.path(GOLD, table)

    def changes(self, table: str) -> str:
        """Change rows of a silver table."""
        return f"{self.silver(table)}__changes"

    def metrics(self, table: str) -> str:
        """Counts of quality flags that a silver table's writes kept."""
        return self.path("_metrics", table)

    def state(self, mart: str) -> str:
        """Partial results that a mart is kept up to date from."""
        return self.path("_state", mart)

    def labels(self, column: str) -> str:
        """Dictionary of the texts of a column."""
        return self.path("_labels", column)

    def checkpoint(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{name}"

    def schema_store(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_schemas/{name}"


def read_table(spark: SparkSession, path: str, merge_schema: bool = False, fmt: str = "parquet") -> DataFrame:
    """Read the table at ``path``; ``merge_schema`` unions file schemas
    written before and after a column was added (Parquet)."""
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                    fmt: str = "parquet") -> None:
    """Full-refresh write.  With ``partition_by`` the output is rebalanced
    on those columns first (AQE splits a skewed partition value across
    several writers and merges tiny ones), so each value is written by
    few tasks and later reads can prune partitions."""
    w = df
    if partition_by:
        w = df.hint("rebalance", *partition_by)
    writer = w.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                 fmt: str = "parquet") -> None:
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)


def replace_batches(df: DataFrame, path: str, ids: Sequence[int], batch_col: str = "__batch") -> None:
    """Write the rows of the batches ``ids``, replacing what the table holds of
    them.  Dynamic overwrite replaces the partitions that have rows now; one
    that is left without any is removed.  The write itself tells which."""
    seen = Observation()
    (df.observe(seen, F.collect_set(batch_col).alias("ids")).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(batch_col).parquet(path))
    for i in set(ids) - set(seen.get["ids"]):
        remove(df.sparkSession, f"{path.rstrip('/')}/{batch_col}={i}")


def completed_batches(path: str) -> str:
    """Where the table at ``path`` keeps a mark (a small Parquet file with
    ``batch``) of every batch written whole, one more each time it is written."""
    return f"{path.rstrip('/')}__complete"


def write_batch(df: DataFrame, path: str, batch_id: int, batch_col: str = "__batch") -> None:
    """Write one ingest batch as partition ``<batch_col>=<batch_id>``.

    Only that partition is replaced, so writing the same batch again (a
    retried or replayed micro-batch) leaves no duplicate.  The batch is then
    marked as complete; incremental readers wait for the mark.
    """
    finer_splits(df.sparkSession)
    replace_batches(df.withColumn(batch_col, F.lit(batch_id).cast("long")), path, [batch_id], batch_col)
    (df.sparkSession.createDataFrame([(batch_id,)], "batch long").coalesce(1)
       .write.mode("append").parquet(completed_batches(path)))
