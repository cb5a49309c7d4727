"""Bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import within_share


def held_out(id_col, folds: int, fold: int):
    """Whether the CRC-32 of the id as text falls into ``fold``; null ids don't."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == fold, F.lit(False))


def bounded(ids: DataFrame, rows: int, id_col: str = "doc_id") -> DataFrame:
    """About ``rows`` rows of ``ids`` at most, chosen by a hash of the id."""
    n = ids.count()
    if n <= rows:
        return ids
    return ids.filter(within_share(F.xxhash64(id_col, F.lit(17)), rows / n))
