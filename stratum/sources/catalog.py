"""The layers as schemas of the session catalog, their tables by name.

A layer is a schema located in the layer's folder.  ``register`` enters a
table that the jobs write there as an external table with its partitions;
``write_bucketed`` writes a table in Spark's own buckets, so that joins and
aggregations on its keys need no exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stratum.sources.tables import BRONZE, GOLD, SILVER, Layout, names_in

LAYERS = (BRONZE, SILVER, GOLD)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class LayerCatalog:
    """Schemas ``<prefix>bronze``, ``<prefix>silver`` and ``<prefix>gold`` over a layout."""

    spark: SparkSession
    layout: Layout
    prefix: str = ""

    def schema(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"no such layer: {layer}")
        return self.prefix + layer

    def name(self, layer: str, table: str) -> str:
        return f"{_quoted(self.schema(layer))}.{_quoted(table)}"

    def create(self) -> None:
        """Create the schemas that are not there yet."""
        for layer in LAYERS:
            folder = f"{self.layout.root.rstrip('/')}/{layer}"
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(self.schema(layer))} LOCATION {_text(folder)}")

    def register(self, layer: str, table: str) -> str:
        """Enter (or enter anew) the Parquet table written at its place in the layout; returns its full name."""
        path, name = self.layout.path(layer, table), self.name(layer, table)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: its files stay
        self.spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {_text(path)}")
        if any("=" in n for n in names_in(self.spark, path)):
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return name

    def write_bucketed(self, df: DataFrame, layer: str, table: str, keys: Sequence[str], buckets: int) -> str:
        """Write ``df`` as an external table in ``buckets`` buckets of ``keys``, sorted by them.

        The rows are repartitioned alike first, so that each bucket is one file; a bucket must fit one task.
        """
        keys, name = list(keys), self.name(layer, table)
        (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
           .option("path", self.layout.path(layer, table)).saveAsTable(name))
        return name

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))
