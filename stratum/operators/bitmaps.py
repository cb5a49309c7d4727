"""Exact distinct counts that merge: bitmaps of integer ids per group.

``bitmaps`` keeps the ids of a group as words of 64 bits, one per range of 64
ids that occurs, so a group of a few ids takes a few bytes and a word is merged
in place by hash aggregates.  Words merge by ``bit_or``, whatever ids they
share, so the distinct counts of deliveries add up to the distinct count of
all rows, which stored counts do not.  Text gets its ids from ``LabelIds``,
a stored dictionary that only grows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.session import scratch_dir
from stratum.sources.tables import path_exists


def bitmaps(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """``(keys..., bucket, bits)``: the distinct non-NULL ids of each group."""
    rows = df.filter(F.col(id_col).isNotNull()).select(*keys, F.col(id_col).cast("long").alias("__id"))
    bit = F.expr("shiftleft(1L, cast(__id & 63L AS int))")
    return rows.groupBy(*keys, F.shiftright("__id", 6).alias("bucket")).agg(F.bit_or(bit).alias("bits"))


def merge_bitmaps(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One bitmap per group and bucket, of several partial ones."""
    return parts.groupBy(*keys, "bucket").agg(F.bit_or("bits").alias("bits"))


def count_bitmaps(merged: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct ids of each group; ``merged`` has one bitmap per group and bucket."""
    return merged.groupBy(*keys).agg(F.sum(F.bit_count("bits")).alias(name))


def dense_numbers(df: DataFrame, order: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """``df`` (without repeated rows) with consecutive numbers from ``start`` in the order of ``order``.

    Ranges of rows are numbered apart; only their sizes are summed in one place.
    """
    path = scratch_dir(df.sparkSession, "numbers")
    df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()).write.parquet(path)
    ranged = df.sparkSession.read.parquet(path)
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = ranged.join(sizes.select("__part", before.alias("__before")), "__part")
    number = F.col("__before") + F.row_number().over(Window.partitionBy("__part").orderBy(*order)) + (start - 1)
    return rows.withColumn(name, number).drop("__part", "__before")


@dataclass(frozen=True)
class LabelIds:
    """Dictionary ``(label, id)`` of texts at ``path``; a label keeps its id for good."""

    spark: SparkSession
    path: str

    def table(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], "label string, id long")
        return self.spark.read.schema("label string, id long").parquet(self.path)

    def extend(self, labels: DataFrame) -> None:
        """Give the labels (one column) that are not in the dictionary the next ids."""
        col = labels.columns[0]
        known = self.table()
        new = labels.select(F.col(col).cast("string").alias("label")).filter("label is not null").distinct().join(known, "label", "left_anti")
        start = (known.agg(F.max("id")).first()[0] or 0) + 1
        dense_numbers(new, ["label"], "id", start).select("label", F.col("id").cast("long")).write.mode("append").parquet(self.path)

    def encode(self, df: DataFrame, col: str, name: str) -> DataFrame:
        """``df`` with the id of ``col`` as ``name`` (NULL for NULL and unknown labels)."""
        ids = self.table().select(F.col("label").alias("__label"), F.col("id").alias(name))
        return df.join(ids, F.col(col).cast("string") == F.col("__label"), "left").drop("__label")
