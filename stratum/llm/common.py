"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor can read, so a lost executor
    costs no more than its running tasks.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(col: str = "text"):
    """The text, with null read as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def unused(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column (whatever its case) has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def within_share(hashed, share: float):
    """Whether a 64-bit hash falls into a share from 0 to 1, which may be as small as one row of very many."""
    return F.shiftrightunsigned(hashed, 1) <= F.lit(min(int(share * 2.0 ** 63), (1 << 63) - 1))


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of the undirected graph ``edges (a, b)``, as ``(node, component)``.

    Alternates the large-star and small-star steps: each round hangs a node's
    neighbours on the smallest id next to it, until the edges are stars round
    the smallest id of each component.  A round is two aggregations with
    map-side combine and two equi-joins, written to the checkpoint folder; no
    neighbour list is ever gathered.  Nodes without an edge are not returned;
    self-loops and repeated edges are allowed, edges with a null end dropped.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialize(edges.filter("a is not null and b is not null and a <> b").distinct(), "cc")
    state = None
    while (now := _digest(edges)) != state:
        state = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
        edges = materialize(small.filter("a <> b").distinct(), "cc")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _digest(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
