"""Sources and sinks: layout, Parquet tables, bronze adapters, CSV."""

from stratum.sources.adapters import ADAPTERS, adapter_sql, bronze
from stratum.sources.tables import (Layout, append_table, overwrite_table, read_source,
                                    read_table)

__all__ = ["ADAPTERS", "Layout", "adapter_sql", "append_table", "bronze", "overwrite_table",
           "read_source", "read_table"]
