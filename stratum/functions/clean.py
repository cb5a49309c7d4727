"""Cleaning building blocks (Column -> Column, plus ``require``).

All of these compile to plain Catalyst expressions, so they stay inside
whole-stage codegen and predicates like ``require`` reach the Parquet scan
as ``IsNotNull`` push-downs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def require(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop a row when any of ``cols`` is NULL (required columns)."""
    cols = list(dict.fromkeys(cols))
    return df.dropna(how="any", subset=cols) if cols else df


def fill_label(c: str | Column, label) -> Column:
    """NULL -> ``label``; other values unchanged."""
    return F.coalesce(col(c), F.lit(label))


def fill_or_trim(c: str | Column, label: str) -> Column:
    """NULL -> ``label``; other values trimmed of surrounding spaces."""
    return F.coalesce(F.trim(col(c)), F.lit(label))


def normalize(c: str | Column, trim: bool = True) -> Column:
    """Upper-case (and by default trim) a label."""
    c = col(c)
    return F.upper(F.trim(c)) if trim else F.upper(c)


def whitelist(c: str | Column, values: Iterable[str], default: str = "UNKNOWN") -> Column:
    """Keep listed values; anything else, NULL included, becomes ``default``."""
    c = col(c)
    return F.when(c.isin(list(values)), c).otherwise(F.lit(default))


def decode(c: str | Column, mapping: Mapping[str, str], default: str,
           case_insensitive: bool = True) -> Column:
    """Code -> label decode with a default for unmatched codes (and NULL)."""
    c = col(c)
    key = F.upper(c) if case_insensitive else c
    expr = None
    for code, label in mapping.items():
        cond = key == F.lit(code.upper() if case_insensitive else code)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))
