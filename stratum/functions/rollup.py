"""Aggregate measures used by the gold marts.

``count_where`` is a ``count_if`` (bigint, a declarative aggregate that the
hash aggregate evaluates partially on the map side).  Ratios go through
``try_divide`` so an empty denominator yields NULL under ANSI mode instead
of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratum.functions.clean import col


def count_where(pred: Column) -> Column:
    """Rows where ``pred`` is true (NULL counts as false)."""
    return F.count_if(pred)


def rate_pct(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """``round(num / den * 100, scale)``; NULL when ``den`` is 0 or NULL."""
    return F.round(F.try_divide(col(num), col(den)) * F.lit(100), scale)


def complement_pct(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """``round(100 - num / den * 100, scale)``."""
    return F.round(F.lit(100) - F.try_divide(col(num), col(den)) * F.lit(100), scale)


# Exact aggregation type for rounded means and sums.  A double sum depends
# on the order rows are added (partitioning, retries), which can move a
# value across a rounding tie (x.xx5); a decimal sum is exact, so the
# rounded result is the same on every run and every cluster size.
EXACT = "decimal(38,10)"


def _exact_or(exact, plain, c: Column, scale: int) -> Column:
    fits = c.try_cast(EXACT)
    return F.coalesce(F.round(F.when(F.count(fits) == F.count(c), exact(fits)), scale).cast("double"),
                      F.round(plain(c.cast("double")), scale))


def mean(c: str | Column, scale: int) -> Column:
    """``round(avg(c), scale)`` computed exactly, half-up, as double.

    If a value or the total does not fit the exact type (NaN, infinity, over
    28 digits before the point), the plain double average is used instead."""
    return _exact_or(F.try_avg, F.avg, col(c), scale)


def rmin(c: str | Column, scale: int) -> Column:
    return F.round(F.min(col(c)), scale)


def rmax(c: str | Column, scale: int) -> Column:
    return F.round(F.max(col(c)), scale)


def rsum(c: str | Column, scale: int) -> Column:
    """``round(sum(c), scale)`` computed exactly, half-up, as double; with the
    same way out as ``mean``."""
    return _exact_or(F.try_sum, F.sum, col(c), scale)
