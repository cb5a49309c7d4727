"""Data-quality operators: flags, quarantine split, metrics, label census."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.clean import col
from stratum.functions.derive import flag


def any_null(cols: Iterable[str | Column]) -> Column:
    """OR of ``isNull`` over ``cols`` (never NULL itself)."""
    pred = None
    for c in cols:
        p = col(c).isNull()
        pred = p if pred is None else (pred | p)
    return pred if pred is not None else F.lit(False)


def null_flag(cols: Iterable[str | Column]) -> Column:
    """Boolean flag: any listed column is NULL."""
    return flag(any_null(cols))


def accept(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows where every flag column is false (a NULL flag is not false)."""
    pred = None
    for f in flags:
        p = F.col(f) == F.lit(False)
        pred = p if pred is None else (pred & p)
    return df if pred is None else df.filter(pred)


def reject_reason(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first rule whose predicate is true, else NULL.

    ``rules`` is an ordered list of ``(reason, predicate)``; a NULL predicate
    counts as not firing.
    """
    expr = None
    for name, pred in rules:
        expr = F.when(pred, F.lit(name)) if expr is None else expr.when(pred, F.lit(name))
    return expr if expr is not None else F.lit(None).cast("string")


def with_reject_reason(df: DataFrame, rules: Sequence[tuple[str, Column]],
                       name: str = "reject_reason") -> DataFrame:
    return df.withColumn(name, reject_reason(rules))


def split_rows(df: DataFrame, rules: Sequence[tuple[str, Column]],
               name: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """Accept/reject split of one plan: ``(accepted, rejected)``.

    Both sides derive from the same projection, so ``accepted`` and
    ``rejected`` partition the input exactly (every row lands on one side).
    Persist or write ``df`` first if both sides are consumed by separate jobs.
    """
    tagged = with_reject_reason(df, rules, name)
    ok = tagged.filter(F.col(name).isNull()).drop(name)
    bad = tagged.filter(F.col(name).isNotNull())
    return ok, bad


def dq_metrics(df: DataFrame, flags: Sequence[str], total: str = "total_rows",
               clean: str = "clean_rows", suffix: str = "_rows") -> DataFrame:
    """One-row data-quality summary: total rows, rows per flag, rows with no
    flag set.  One aggregate (one job) instead of an action per check."""
    return df.agg(*dq_aggregates(flags, total, clean, suffix))


def dq_aggregates(flags: Sequence[str], total: str = "total_rows", clean: str = "clean_rows", suffix: str = "_rows") -> list[Column]:
    """The summary's aggregates; ``DataFrame.observe`` takes them from a write
    on its way, without a scan of their own."""
    aggs = [F.count(F.lit(1)).alias(total)]
    aggs += [F.count_if(F.col(f)).alias(f"{f}{suffix}") for f in flags]
    none_set = None
    for f in flags:
        p = ~F.coalesce(F.col(f), F.lit(False))
        none_set = p if none_set is None else (none_set & p)
    aggs.append(F.count_if(none_set if none_set is not None else F.lit(True)).alias(clean))
    return aggs


def label_census(df: DataFrame, cols: Sequence[str], column_name: str = "column_name",
                 label: str = "label", count: str = "row_count") -> DataFrame:
    """Distinct values and their row counts for several label columns.

    One scan and one shuffle for all columns: each row is unpivoted into
    (column, value) pairs and counted with a partial (map-side) aggregate,
    so a hot label is pre-reduced before the exchange.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias(column_name), F.col(c).cast("string").alias(label))
                      for c in cols])
    return (df.select(F.inline(pairs))
              .groupBy(column_name, label)
              .agg(F.count(F.lit(1)).alias(count)))
