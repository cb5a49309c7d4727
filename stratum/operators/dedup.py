"""Deduplication: keep the latest row per business key.

Implemented as one aggregate, ``max(struct(order..., rest...))`` per key,
rather than ``row_number()`` over a window.  The aggregate is evaluated
partially on the map side, so a hot key holding a large share of the rows
is reduced to one row per map task before the shuffle; a window would send
every row of that key to a single task and sort it there.

Ties on the order columns are broken by the remaining columns (greatest
value wins, NULL lowest), which makes the result deterministic.  Rows with
a NULL in any key column never match each other (equality semantics) and
are passed through unchanged: they go through the same pass under a number
of their own.  Without them (``keep_null_keys=False``: none can come, or none
is wanted) the exchange is on the keys alone, and a join on them needs no other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators.quality import any_null


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
                   keep_null_keys: bool = True, spread: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``spread`` lays out the rows, packed beside their keys, before they are grouped;
    columns that it adds are grouped by, too."""
    keys = list(keys)
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    fields = [F.col(c) for c in order + rest] or [F.lit(True).alias("__k")]
    by, row = keys, F.struct(*fields)
    columns = df.columns
    if spread is not None:
        df, row = spread(df.select(*keys, row.alias("__row"))), F.col("__row")
        by = [c for c in df.columns if c != "__row"]
    packed = F.max(row).alias("__latest")
    if keep_null_keys:
        own = F.when(any_null(keys), F.monotonically_increasing_id())
        latest = df.groupBy(*by, own.alias("__own")).agg(packed)
    else:
        latest = df.filter(~any_null(keys)).groupBy(*by).agg(packed)
    return latest.select(*keys, "__latest.*").select(*columns)
