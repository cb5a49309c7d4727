"""Row-level changes: rows that were inserted, deleted or updated.

``change_rows``    between two keyed snapshots.
``merge_changes``  that a batch makes to the rows of a table it meets, without
                   comparing what it does not touch.
``ChangeLog``      change rows kept by the writer, one partition per delivery,
                   readable by a range of deliveries.

A change row carries the columns of the table and ``_change_type``: insert,
delete, update_preimage or update_postimage.  Values compare NULL-safely.
Rows with a NULL key match nothing by key; they are compared whole, as
multisets: what only one side has is an insert or a delete.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.quality import any_null
from stratum.sources.tables import load_schema, names_in, path_exists, remove, save_schema, touch

CHANGE_COL = "_change_type"
DELIVERY_COL = "__delivery"
INSERT, DELETE, PREIMAGE, POSTIMAGE = "insert", "delete", "update_preimage", "update_postimage"


def _columns(old: DataFrame, new: DataFrame) -> list[str]:
    return list(dict.fromkeys([*new.columns, *old.columns]))


def _row(df: DataFrame, cols: Sequence[str], types: dict[str, T.DataType]) -> Column:
    """The row as a struct of ``cols``; a column that ``df`` lacks is NULL."""
    return F.struct(*[(F.col(c) if c in df.columns else F.lit(None).cast(types[c])).alias(c) for c in cols])


def _types(*dfs: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for df in dfs for f in df.schema.fields}


def _differs(cols: Sequence[str]) -> Column:
    differs = F.lit(False)
    for c in cols:
        differs = differs | ~F.col("__o")[c].eqNullSafe(F.col("__n")[c])
    return differs


def _image(kind: str, side: str, cols: Sequence[str], change_col: str) -> Column:
    return F.struct(F.lit(kind).alias(change_col), *[F.col(side)[c].alias(c) for c in cols])


def _copies(balance: Column, row: str, cols: Sequence[str], change_col: str) -> Column:
    """``balance`` inserts of a row, or as many deletes if it is negative."""
    kind = F.when(balance > 0, INSERT).otherwise(DELETE)
    return F.array_repeat(F.struct(kind.alias(change_col), *[F.col(row)[c].alias(c) for c in cols]), F.abs(balance).cast("int"))


def change_rows(old: DataFrame, new: DataFrame, keys: Sequence[str], change_col: str = CHANGE_COL,
                ignore: Sequence[str] = ()) -> DataFrame:
    """Row-level changes from keyed snapshot ``old`` to keyed snapshot ``new``.

    Both snapshots are read once, into one aggregation: by key, or by the
    whole row where the key has a NULL.  Unchanged rows are dropped; columns
    in ``ignore`` (stamps) don't count as changes.
    """
    keys = list(keys)
    cols, types = _columns(old, new), _types(old, new)
    compared = [c for c in cols if c not in ignore and c not in keys]

    def tagged(df: DataFrame, side: int) -> DataFrame:
        return df.select(*keys, _row(df, cols, types).alias("__r"), F.lit(side).alias("__side"))

    both = tagged(old, -1).unionByName(tagged(new, 1))
    whole = F.when(any_null(keys), F.struct(*[F.col("__r")[c].alias(c) for c in cols if c not in ignore]))
    met = both.groupBy(*keys, whole.alias("__whole")).agg(
        F.max(F.when(F.col("__side") < 0, F.col("__r"))).alias("__o"), F.max(F.when(F.col("__side") > 0, F.col("__r"))).alias("__n"),
        F.sum("__side").cast("int").alias("__balance"))
    met = met.withColumn("__any", F.coalesce("__n", "__o"))
    events = (F.when(F.col("__whole").isNotNull(), _copies(F.col("__balance"), "__any", cols, change_col))
               .when(F.col("__o").isNull(), F.array(_image(INSERT, "__n", cols, change_col)))
               .when(F.col("__n").isNull(), F.array(_image(DELETE, "__o", cols, change_col)))
               .when(_differs(compared), F.array(_image(PREIMAGE, "__o", cols, change_col), _image(POSTIMAGE, "__n", cols, change_col))))
    return met.select(F.inline(events))


def multiset_changes(old: DataFrame, new: DataFrame, change_col: str = CHANGE_COL, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows that ``new`` has more often than ``old`` (inserts) or less often (deletes), as often as that."""
    cols, types = _columns(old, new), _types(old, new)
    stamps = [c for c in cols if c in ignore]
    compared = [c for c in cols if c not in ignore]

    def tagged(df: DataFrame, side: int) -> DataFrame:
        own = [(F.col(c) if c in df.columns else F.lit(None).cast(types[c])).alias(c) for c in compared]
        rest = [_row(df, stamps, types).alias("__rest")] if stamps else []
        return df.select(*own, *rest, F.lit(side).alias("__side"))

    # Spread first and counted where they lie: counting before would sort or hash
    # each task's input whole, and rows seldom repeat.
    both = tagged(old, -1).unionByName(tagged(new, 1)).repartition(*compared)
    rest = [F.max("__rest").alias("__rest")] if stamps else []
    met = both.groupBy(*compared).agg(F.sum("__side").cast("int").alias("__balance"), *rest)
    row = F.struct(*[(F.col("__rest")[c] if c in stamps else F.col(c)).alias(c) for c in cols])
    met = met.filter("__balance <> 0").select("__balance", row.alias("__any"))
    return met.select(F.inline(_copies(F.col("__balance"), "__any", cols, change_col)))


def merge_changes(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
                  replaced: DataFrame | None = None, change_col: str = CHANGE_COL, ignore: Sequence[str] = ()) -> DataFrame:
    """Changes that upserting ``source`` (one row per key) makes to ``target``.

    ``source`` looks up its keys in ``target``; other rows are not looked at.
    With ``order``, a source row older than the target's changes nothing.
    Source rows with a NULL key are inserts; ``replaced`` are the target's
    NULL-key rows that they take the place of.
    """
    keys = list(keys)
    cols, types = _columns(target, source), _types(target, source)
    compared = [c for c in cols if c not in ignore and c not in keys]
    keyed, unkeyed = source.filter(~any_null(keys)), source.filter(any_null(keys))
    s = keyed.select(*keys, _row(keyed, cols, types).alias("__n"))
    t = target.select(*keys, _row(target, cols, types).alias("__o"))
    met = s.join(t, keys, "left")
    change = _differs(compared)
    if order:
        version = [F.struct(*[F.col(side)[c] for c in order]) for side in ("__n", "__o")]
        change = change & (version[0] >= version[1])
    events = (F.when(F.col("__o").isNull(), F.array(_image(INSERT, "__n", cols, change_col)))
               .when(change, F.array(_image(PREIMAGE, "__o", cols, change_col), _image(POSTIMAGE, "__n", cols, change_col))))
    by_key = met.select(F.inline(events))
    if replaced is None:
        replaced = target.limit(0)
    return by_key.unionByName(multiset_changes(replaced, unkeyed, change_col, ignore).select(change_col, *cols))


def merge_events(both: DataFrame, keys: Sequence[str], order: Sequence[str], new: str, change_col: str = CHANGE_COL,
                 kept: str = "__kept", ignore: Sequence[str] = (), spread: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """What ``merge_changes`` finds and what ``upsert`` keeps, of target and source rows together in one aggregation.

    ``new`` marks source rows; no key is NULL.  A row comes out once for its
    change (``change_col``, NULL: none) and for the table (``kept``).
    ``spread`` lays out the rows, packed beside their keys, before they are
    grouped; columns that it adds are grouped by, too.
    """
    keys = list(keys)
    cols = [c for c in both.columns if c not in keys and c != new]
    order = [c for c in order if c in cols]
    compared = [c for c in cols if c not in ignore]
    row = F.struct(*[F.col(c) for c in [*order, *[c for c in cols if c not in order]]] or [F.lit(True).alias("__k")])
    packed = both.select(*keys, new, row.alias("__row"))
    if spread is not None:
        packed = spread(packed)
    by, row = [c for c in packed.columns if c not in (new, "__row")], F.col("__row")
    met = packed.groupBy(*by).agg(F.max(F.when(~F.col(new), row)).alias("__o"), F.max(F.when(F.col(new), row)).alias("__n"))

    def image(kind: str | None, keep: bool, side: str) -> Column:
        return F.struct(F.lit(kind).cast("string").alias(change_col), F.lit(keep).alias(kept), *[F.col(side)[c].alias(c) for c in cols])

    newer = F.lit(True)
    if order:
        version = [F.struct(*[F.col(side)[c] for c in order]) for side in ("__n", "__o")]
        newer = version[0] >= version[1]
    events = (F.when(F.col("__o").isNull(), F.array(image(INSERT, True, "__n")))
               .when(F.col("__n").isNull() | ~newer, F.array(image(None, True, "__o")))
               .when(_differs(compared), F.array(image(PREIMAGE, False, "__o"), image(POSTIMAGE, True, "__n")))
               .otherwise(F.array(image(None, True, "__n"))))
    return met.select(*keys, F.inline(events))


@dataclass(frozen=True)
class ChangeLog:
    """Change rows of a table at ``path``, in partitions ``__delivery=<n>``.

    A delivery's rows are written before the table is, and marked as written,
    then as merged once the table has them.  A writer that died in between
    finds its change rows and only writes the table again; one that finishes
    twice changes nothing.  Rows of a merge that don't change are held beside
    them, in partition ``-1 - n``, until the table has them.
    """

    spark: SparkSession
    path: str

    def _mark(self, delivery: int, step: str) -> str:
        return f"{self.path.rstrip('/')}__log/{delivery}.{step}"

    def written(self, delivery: int) -> bool:
        return path_exists(self.spark, self._mark(delivery, "written"))

    def merged(self, delivery: int) -> bool:
        return path_exists(self.spark, self._mark(delivery, "merged"))

    def _unchanged(self, delivery: int) -> str:
        return f"{self.path.rstrip('/')}/{DELIVERY_COL}={-1 - delivery}"

    def write(self, rows: DataFrame, delivery: int) -> None:
        """The change rows of a delivery; those without a change type are held for ``after`` alone."""
        _widen(self.spark, self.path, rows.schema)
        remove(self.spark, self._unchanged(delivery))
        at = F.when(F.col(CHANGE_COL).isNull(), F.lit(-1 - delivery)).otherwise(F.lit(delivery)).cast("long")
        (rows.withColumn(DELIVERY_COL, at).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(DELIVERY_COL).parquet(self.path))
        touch(self.spark, self._mark(delivery, "written"))

    def finish(self, delivery: int) -> None:
        remove(self.spark, self._unchanged(delivery))
        touch(self.spark, self._mark(delivery, "merged"))

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(load_schema(self.spark, f"{self.path}__schema")).parquet(self.path)

    def read(self, first: int | None = None, last: int | None = None) -> DataFrame:
        """Change rows of the deliveries ``first`` to ``last``; other partitions are not read."""
        d = F.col(DELIVERY_COL)
        rows = self._rows().filter(d >= (0 if first is None else first))
        return rows if last is None else rows.filter(d <= last)

    def after(self, delivery: int) -> DataFrame:
        """What a delivery that was written, but not merged, leaves in the table: rows that come, that
        changed, as they are now, and that did not."""
        kind = F.col(CHANGE_COL)
        return self._rows().filter(F.col(DELIVERY_COL).isin(delivery, -1 - delivery)).filter(kind.isNull() | kind.isin(INSERT, POSTIMAGE))

    def last(self) -> int | None:
        """The newest delivery that the table has."""
        done = [int(n.split(".")[0]) for n in names_in(self.spark, f"{self.path.rstrip('/')}__log") if n.endswith(".merged")]
        return max(done, default=None)

    def claim(self, owner: str) -> None:
        """Refuse a log that another stream numbers: its deliveries would be taken for replays."""
        beside = f"{self.path.rstrip('/')}__owner"
        if not path_exists(self.spark, beside):
            self.spark.createDataFrame([(owner,)], "owner string").coalesce(1).write.parquet(beside)
        elif (was := self.spark.read.parquet(beside).first()["owner"]) != owner:
            raise ValueError(f"the change rows at {self.path} are numbered by stream {was}, not by {owner}")


def _widen(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Remember the columns of the change rows; columns are only ever added."""
    store = f"{path}__schema"
    known = load_schema(spark, store)
    fields = {f.name: T.StructField(f.name, f.dataType, True) for s in (known, schema) if s is not None for f in s.fields}
    fields.setdefault(DELIVERY_COL, T.StructField(DELIVERY_COL, T.LongType(), True))
    merged = T.StructType([f for n, f in fields.items() if n != DELIVERY_COL] + [fields[DELIVERY_COL]])
    if known != merged:
        save_schema(spark, store, merged, len(merged))
