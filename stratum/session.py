"""Session defaults and the shared scratch location.

The scratch location is always derived from ``spark.checkpoint.dir`` (the
shared folder a cluster names for reliable checkpoints).  Only when the
setting is absent *and* Spark runs in local mode (tests, laptops) do we
create a private temporary folder and register it as the checkpoint dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package relies on.  AQE re-plans joins and
# shuffle partition counts at run time and splits skewed join partitions.
# (Writers that need dynamic partition overwrite set it per write.)
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Whole-stage codegen for sort-based aggregation: latest-per-key packs a
    # row into a struct, whose max is planned as a sort aggregate.
    "spark.sql.codegen.aggregate.sortAggregate.enabled": "true",
    # Shuffle partitions are only merged up to this size: rows of text and numbers unpack
    # to many times their shuffled bytes, and a task sorts or hashes them unpacked.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Tables, change rows and staged rows take about a third less than with snappy.
    "spark.sql.parquet.compression.codec": "zstd",
    # A task that writes a few partitions keeps a file open for each; sorted by
    # partition, its whole input would be held or spilled first.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def get_session(master: str | None = None, app: str = "stratum",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    # Remove reliable-checkpoint files (upsert batches) once they are no
    # longer referenced, instead of leaving them in the shared folder.
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Apply the runtime-settable defaults to an existing session."""
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)


#: Bytes of files that a task of a layer job reads: compressed, they hold many rows.
SPLIT_BYTES = 32 << 20


def finer_splits(spark: SparkSession) -> None:
    """Read files in pieces of ``SPLIT_BYTES`` at most, for jobs that take much CPU a byte."""
    size = "spark.sql.files.maxPartitionBytes"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(size)) > SPLIT_BYTES:
        spark.conf.set(size, str(SPLIT_BYTES))


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session.  If it is unset, a
    private folder is created, but only in local mode; on a cluster a
    machine-local folder would be lost with its executor, so we refuse.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        jdir = sc._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            root = jdir.get()
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; set it to a shared folder "
                "(HDFS/object store) reachable by every executor")
        root = tempfile.mkdtemp(prefix="stratum-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not _checkpoint_dir_set(spark):
        sc.setCheckpointDir(root)
    return root


def _checkpoint_dir_set(spark: SparkSession) -> bool:
    return spark.sparkContext._jsc.sc().getCheckpointDir().isDefined()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, uniquely named folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/stratum/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything ``scratch_dir`` handed out: what operators wrote to cut
    their lineage.  For the end of an application, when no DataFrame is read any
    more that came from them; nothing else deletes these folders."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark).rstrip('/')}/stratum")
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so plain Python can write small files."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
