"""Refresh of tables without a key, rewriting only the partitions that changed.

Rows without a key are compared as multisets: a partition has changed if some
row comes more or less often than before.  Repeated rows therefore stay
repeated, and a file delivered again as it was changes nothing.  A partition is
first judged by its digest, a sum over the hashes of its rows, which takes no
shuffle; only the rows of partitions with another digest are compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.changes import CHANGE_COL, DELETE, INSERT, ChangeLog, multiset_changes
from stratum.session import scratch_dir
from stratum.sources.tables import load_schema, path_exists, replace_batches, save_schema


def _hashes(cols: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row: of its values, and of its values backwards after the places of its NULLs, which a hash skips."""
    nulls = [reduce(Column.bitwiseOR, [F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(part)])
             for part in (cols[k:k + 60] for k in range(0, len(cols), 60))]
    return [F.xxhash64(*cols), F.xxhash64(F.lit(len(cols)), *nulls, *[F.col(c) for c in reversed(cols)])]


def _digests(df: DataFrame, partition: str, cols: Sequence[str]) -> dict:
    """By partition: number of rows and sums of their hashes, whatever order the rows have."""
    sums = [F.sum(h.cast("decimal(20,0)")) for h in _hashes(cols)]
    return {r[0]: tuple(r)[1:] for r in df.groupBy(partition).agg(F.count(F.lit(1)), *sums).collect()}


def _kind(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(CHANGE_COL, F.lit(name))


def _joined(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _row_changes(old: DataFrame, new: DataFrame, cols: Sequence[str], ignore: Sequence[str]) -> DataFrame:
    """``multiset_changes`` that shuffles hashes of rows first, and whole rows only if many changed and many did not.

    Rows are told apart by 128 bits.  A hash that one side alone has is a
    change, one that both have as often is none; either kind is looked up,
    whichever is less.  Rows that both have, but not as often, are compared.
    """
    spark, names, at = old.sparkSession, ["__h1", "__h2"], scratch_dir(old.sparkSession, "rows")
    old, new = (df.withColumns(dict(zip(names, _hashes(cols), strict=True))) for df in (old, new))
    sides = old.select(*names, F.lit(-1).alias("__side")).unionByName(new.select(*names, F.lit(1).alias("__side")))
    met = sides.repartition(*names).groupBy(*names).agg(F.sum("__side").alias("__balance"), (F.min("__side") != F.max("__side")).alias("__shared"))
    kind = F.when(~F.col("__shared"), "changed").when(F.col("__balance") == 0, "same").otherwise("counted")
    met.select(*names, kind.alias("kind")).write.partitionBy("kind").parquet(at)
    found = {k: spark.read.schema("__h1 long, __h2 long").parquet(f"{at}/kind={k}") for k in ("changed", "same", "counted")
             if path_exists(spark, f"{at}/kind={k}")}
    sizes = {k: df.count() for k, df in found.items()}
    plain = lambda df: df.drop(*names)

    def told_apart(df: DataFrame) -> DataFrame:
        if sizes.get("changed", 0) <= sizes.get("same", 0) + sizes.get("counted", 0):
            return df.join(found["changed"], names, "left_semi") if "changed" in found else df.limit(0)
        return reduce(lambda rows, k: rows.join(found[k], names, "left_anti"), [k for k in ("same", "counted") if k in found], df)

    parts = [_kind(plain(told_apart(old)), DELETE), _kind(plain(told_apart(new)), INSERT)]
    if "counted" in found:
        parts.append(multiset_changes(*[plain(df.join(found["counted"], names, "left_semi")) for df in (old, new)], CHANGE_COL, ignore))
    return _joined(*parts)


def _changes(old: DataFrame | None, rows: DataFrame, partition: str, ignore: Sequence[str]) -> tuple[DataFrame, dict | None]:
    """Change rows from ``old`` to ``rows``, and by partition how many rows ``rows`` has (None: all come new); a
    partition that only one of them has is not compared."""
    if old is None:
        return _kind(rows, INSERT), None
    cols = [c for c in dict.fromkeys([*rows.columns, *old.columns]) if c not in ignore]
    types = {f.name: f.dataType for df in (old, rows) for f in df.schema.fields}
    old, rows = (df.withColumns({c: F.lit(None).cast(types[c]) for c in types if c not in df.columns}) for df in (old, rows))
    was, now = (_digests(df, partition, cols) for df in (old, rows))
    here = F.col(partition)
    fresh, gone = [p for p in now if p not in was], [p for p in was if p not in now]
    both = [p for p in now if p in was and now[p] != was[p]]
    parts = [_kind(rows.filter(here.isin(fresh)), INSERT), _kind(old.filter(here.isin(gone)), DELETE)]
    if both:
        parts.append(_row_changes(old.filter(here.isin(both)), rows.filter(here.isin(both)), cols, ignore))
    return _joined(*parts), {p: now[p][0] for p in now}


def refresh_partitions(spark: SparkSession, path: str, rows: DataFrame, ids: Sequence[int], partition: str,
                       changes: str, version: int, ignore: Sequence[str] = ()) -> list[int]:
    """Make the partitions ``ids`` of the table at ``path`` hold ``rows``.

    ``rows`` carries ``partition``; it is the whole content of these
    partitions.  The change rows go to the log ``changes`` as delivery
    ``version``; columns in ``ignore`` (stamps) don't make a change.  Only
    partitions with a change are written, and their ids returned.  Replayed,
    a version writes the partitions again that it was about to write.
    ``rows`` is read several times (digests, changes, and the write of partitions
    of which some rows stayed; others are written from their change rows): stage
    it if it is expensive.
    """
    log = ChangeLog(spark, changes)
    if log.merged(version):
        return []
    store = f"{path.rstrip('/')}__schema"
    known = load_schema(spark, store)
    old = (spark.read.schema(known).parquet(path).filter(F.col(partition).isin(list(ids)))
           if known is not None and path_exists(spark, path) else None)
    counts: dict | None = {}
    if not log.written(version):
        changes_now, counts = _changes(old, rows, partition, ignore)
        log.write(changes_now, version)
    come = F.col(CHANGE_COL) == INSERT
    inserts = {r[0]: r[1] for r in log.read(version, version).groupBy(partition).agg(F.count_if(come)).collect()}
    changed = list(inserts)
    logged = [p for p, n in inserts.items() if n and (counts is None or counts.get(p) == n)]
    added = [f for f in rows.schema.fields if known is None or f.name not in known.fieldNames()]
    if added:
        schema = rows.schema if known is None else known
        for f in added if known is not None else []:
            schema = schema.add(f)
        save_schema(spark, store, schema, len(schema))
    if changed:
        here, rest = F.col(partition), [p for p in changed if p not in logged]
        typed = [F.col(f.name).cast(f.dataType) for f in rows.schema.fields]
        parts = [log.read(version, version).filter(come & here.isin(logged)).select(*typed)] if logged else []
        if rest:
            parts.append(rows.filter(here.isin(rest)))
        replace_batches(reduce(DataFrame.unionByName, parts), path, changed, partition)
    log.finish(version)
    return changed
