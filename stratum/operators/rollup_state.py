"""Marts kept up to date from change rows.

A ``Rollup`` names what a mart aggregates; its state keeps one row of partial
results per group: counts and exact decimal sums, which a change row adds to
or takes from, least and greatest values and bitmaps of distinct ids, which
only take more.  A delivery of change rows is reduced to one row per group it
touches (on the map side first, so a hot group costs one row per task) and
added to the state.  Groups that lost rows and have values that can't be
taken back are aggregated again from the base table, those groups alone.

State is written as one partition per delivery that holds the groups it
touched; readers take the newest row of a group.  A group that no delivery
touches is never written again.  A delivery is marked once its partition is
complete: what a writer left unfinished is not seen and is cleared away, and a
delivery that was applied before changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.rollup import EXACT
from stratum.operators.bitmaps import bitmaps, count_bitmaps
from stratum.operators.changes import CHANGE_COL, DELETE, DELIVERY_COL, PREIMAGE
from stratum.session import scratch_dir
from stratum.sources.tables import load_schema, names_in, path_exists, remove, save_schema, touch

SIGN = "__sign"
ITEM, WEIGHT = "decimal(28,10)", "decimal(9,0)"


def signed(changes: DataFrame) -> DataFrame:
    """Change rows as rows that come (1) or go (-1)."""
    gone = F.col(CHANGE_COL).isin(DELETE, PREIMAGE)
    dropped = [c for c in (CHANGE_COL, DELIVERY_COL) if c in changes.columns]
    return changes.withColumn(SIGN, F.when(gone, F.lit(-1)).otherwise(F.lit(1)).cast("long")).drop(*dropped)


@dataclass(frozen=True)
class Rollup:
    """What a mart aggregates, by output name.

    ``counts``: rows where the condition holds.  ``means`` and ``totals``: a
    number and the digits to round to, half-up.  ``lows`` and ``highs``: least
    and greatest value.  ``distinct``: an integer column whose distinct values
    are counted.  ``finish`` derives the mart's other columns.
    """

    keys: Sequence[str]
    counts: Mapping[str, Column] = field(default_factory=dict)
    means: Mapping[str, tuple[Column, int]] = field(default_factory=dict)
    totals: Mapping[str, tuple[Column, int]] = field(default_factory=dict)
    lows: Mapping[str, Column] = field(default_factory=dict)
    highs: Mapping[str, Column] = field(default_factory=dict)
    distinct: Mapping[str, str] = field(default_factory=dict)
    finish: Callable[[DataFrame], DataFrame] = lambda df: df

    @property
    def numbers(self) -> dict[str, tuple[Column, int]]:
        return {**self.means, **self.totals}

    @property
    def outputs(self) -> list[str]:
        return [*self.counts, *self.numbers, *self.lows, *self.highs, *self.distinct]

    @property
    def additive(self) -> list[str]:
        """Partial columns that rows add to and take from."""
        return ["__rows", "__lost", *self.counts, *[f"__{p}_{n}" for n in self.numbers for p in ("sum", "n", "odd")]]

    def partial(self, rows: DataFrame) -> DataFrame:
        """One row of partial results per group of signed rows; ``__sign`` may be a weight."""
        w = F.col(SIGN)

        def total(pred: Column) -> Column:
            return F.coalesce(F.sum(F.when(pred, w)), F.lit(0)).cast("long")

        aggs = [total(F.lit(True)).alias("__rows"), F.count_if(w < 0).alias("__lost")]
        aggs += [total(pred).alias(name) for name, pred in self.counts.items()]
        for name, (x, _) in self.numbers.items():
            weighted = x.try_cast(ITEM) * w.try_cast(WEIGHT)
            aggs += [F.try_sum(weighted).cast(EXACT).alias(f"__sum_{name}"), total(x.isNotNull()).alias(f"__n_{name}"),
                     total(x.isNotNull() & weighted.isNull()).alias(f"__odd_{name}"),
                     F.sum(x.cast("double") * w).alias(f"__plain_{name}")]
        aggs += [F.min(F.when(w > 0, x)).alias(n) for n, x in self.lows.items()]
        aggs += [F.max(F.when(w > 0, x)).alias(n) for n, x in self.highs.items()]
        return rows.groupBy(*self.keys).agg(*aggs)

    def merge(self, parts: DataFrame, *more: Column) -> DataFrame:
        """Partial results of each group, added up."""
        aggs = [(F.try_sum(c).cast(EXACT) if c.startswith("__sum_") else F.sum(c).cast("long")).alias(c) for c in self.additive]
        # a plain sum is only used for a group aggregated anew, which has no other part
        aggs += [F.sum(f"__plain_{n}").alias(f"__plain_{n}") for n in self.numbers]
        aggs += [F.min(n).alias(n) for n in self.lows] + [F.max(n).alias(n) for n in self.highs]
        return parts.groupBy(*self.keys).agg(*aggs, *more)

    def mart(self, state: DataFrame) -> DataFrame:
        """The mart's rows; ``state`` has a row of partial results and the distinct counts of every group."""
        df = state.filter("__rows > 0")
        out: dict[str, Column] = {}
        for name, (_, scale) in self.means.items():
            total, n = F.col(f"__sum_{name}"), F.col(f"__n_{name}")
            exact = F.coalesce(total.try_cast(ITEM) / n.try_cast("decimal(10,0)"), total / n)
            out[name] = _rounded(name, exact, F.col(f"__plain_{name}") / n, scale)
        for name, (_, scale) in self.totals.items():
            out[name] = _rounded(name, F.col(f"__sum_{name}"), F.col(f"__plain_{name}"), scale)
        return self.finish(df.withColumns(out).select(*self.keys, *self.outputs)) if out else self.finish(df.select(*self.keys, *self.outputs))


def _rounded(name: str, exact: Column, plain: Column, scale: int) -> Column:
    n, odd = F.col(f"__n_{name}"), F.col(f"__odd_{name}")
    good = (odd == 0) & F.col(f"__sum_{name}").isNotNull()
    return F.when(n > 0, F.when(good, F.round(exact, scale).cast("double")).otherwise(F.round(plain, scale)))


def net(rows: DataFrame) -> DataFrame:
    """Signed rows, those that come and go alike taken out."""
    cols = [c for c in rows.columns if c != SIGN]
    return rows.groupBy(*cols).agg(F.sum(SIGN).cast("long").alias(SIGN)).filter(F.col(SIGN) != 0)


def same_group(df: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` in (or not in) ``groups``; NULL keys are a group like any other."""
    g = groups.select(*[F.col(k).alias(f"__g_{k}") for k in keys])
    return df.join(g, reduce(lambda a, b: a & b, [df[k].eqNullSafe(g[f"__g_{k}"]) for k in keys]), how)


@dataclass(frozen=True)
class RollupState:
    """State of a rollup at ``path``: ``groups`` and ``ids`` (bitmaps), partitioned by delivery."""

    spark: SparkSession
    path: str
    rollup: Rollup

    def applied(self) -> int:
        """The last delivery in the state (-1: none)."""
        return max((int(n) for n in names_in(self.spark, f"{self.path}/applied")), default=-1)

    def _clear(self, applied: int) -> None:
        """Remove what deliveries left that were not finished."""
        for name in ["groups", *[f"ids_{n}" for n in self.rollup.distinct]]:
            for part in names_in(self.spark, f"{self.path}/{name}"):
                if part.startswith(DELIVERY_COL) and int(part.split("=")[1]) > applied:
                    remove(self.spark, f"{self.path}/{name}/{part}")

    def _read(self, name: str, last: int) -> DataFrame | None:
        path = f"{self.path}/{name}"
        if not path_exists(self.spark, path):
            return None
        rows = self.spark.read.schema(load_schema(self.spark, f"{path}__schema")).parquet(path)
        return rows.filter(F.col(DELIVERY_COL) <= last)

    def _write(self, name: str, rows: DataFrame, delivery: int) -> None:
        path = f"{self.path}/{name}"
        rows = rows.withColumn(DELIVERY_COL, F.lit(delivery).cast("long"))
        if load_schema(self.spark, f"{path}__schema") is None:
            save_schema(self.spark, f"{path}__schema", rows.schema, 0)
        rows.write.mode("overwrite").partitionBy(DELIVERY_COL).option("partitionOverwriteMode", "dynamic").parquet(path)

    def groups(self) -> DataFrame | None:
        """The newest row of every group."""
        rows = self._read("groups", self.applied())
        if rows is None:
            return None
        keys = list(self.rollup.keys)
        rest = [c for c in rows.columns if c not in keys]
        newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), DELIVERY_COL).alias("__s"))
        return newest.select(*keys, "__s.*")

    def touched(self, after: int) -> DataFrame:
        """Keys of the groups that deliveries after ``after`` touched."""
        return self._read("groups", self.applied()).filter(F.col(DELIVERY_COL) > after).select(*self.rollup.keys).distinct()

    def mart(self) -> DataFrame:
        return self.rollup.mart(self.groups())

    def apply(self, rows: DataFrame, delivery: int, base: DataFrame, weight: str | None = None) -> None:
        """Add a delivery of signed rows; ``base`` is the table as it is after them
        (``weight``: the column that says how often each of its rows counts)."""
        r, keys = self.rollup, list(self.rollup.keys)
        if delivery <= (applied := self.applied()):
            return
        self._clear(applied)
        delta = r.partial(rows)
        old = self.groups()
        parts = delta.withColumn("__new", F.lit(1))
        if old is not None:
            # what a row lost counts for its own delivery alone
            parts = parts.unionByName(old.withColumn("__lost", F.lit(0).cast("long")).withColumn("__new", F.lit(0)).drop(DELIVERY_COL),
                                      allowMissingColumns=True)
        else:
            parts = parts.withColumn("__epoch", F.lit(None).cast("long"))
        merged = r.merge(parts, F.max("__new").alias("__new"), F.max("__epoch").alias("__epoch")).filter("__new = 1").drop("__new")
        again = F.lit(False)
        if r.lows or r.highs or r.distinct:
            again = again | (F.col("__lost") > 0)
        for n in r.numbers:
            again = again | (F.col(f"__odd_{n}") != 0) | (F.col(f"__n_{n}") > 0) & F.col(f"__sum_{n}").isNull()
        merged = merged.withColumn("__again", again).withColumn("__epoch", F.coalesce("__epoch", F.lit(delivery).cast("long")))
        merged = self._stage(merged)
        redo = merged.filter("__again")
        base_rows = same_group(base, redo, keys).withColumn(SIGN, F.col(weight).cast("long") if weight else F.lit(1).cast("long"))
        if r.distinct:
            base_rows = self._stage(base_rows)  # read once more for each bitmap
        # a group without rows left stays as an empty one
        nothing = redo.select(*keys, *[F.lit(None if c.startswith("__sum_") else 0).cast(merged.schema[c].dataType).alias(c) for c in r.additive],
                              *[F.lit(None).cast("double").alias(f"__plain_{n}") for n in r.numbers],
                              *[F.lit(None).cast(merged.schema[n].dataType).alias(n) for n in (*r.lows, *r.highs)])
        anew = r.merge(r.partial(base_rows).unionByName(nothing)).withColumn("__epoch", F.lit(delivery).cast("long"))
        done = merged.filter("not __again").drop("__again").unionByName(anew)
        if r.distinct:
            done = self._stage(done)
        counts = []
        for name, col in r.distinct.items():
            own = same_group(rows.filter(F.col(SIGN) > 0), redo, keys, "left_anti")
            ids = bitmaps(own, keys, col).withColumn("__new", F.lit(1))
            before = self._read(f"ids_{name}", applied)
            if before is not None:
                valid = self._valid(before, old).withColumn("__new", F.lit(0))
                ids = ids.unionByName(valid)
            ids = ids.groupBy(*keys, "bucket").agg(F.bit_or("bits").alias("bits"), F.max("__new").alias("__new")).filter("__new = 1").drop("__new")
            self._write(f"ids_{name}", ids.unionByName(bitmaps(base_rows, keys, col)), delivery)
            now = same_group(self._valid(self._read(f"ids_{name}", delivery), done), merged, keys)
            counts.append(count_bitmaps(now, keys, name))
        if counts:
            both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [done, *counts])
            rest = [c for c in done.columns if c not in keys]
            done = both.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in rest],
                                           *[F.coalesce(F.max(n), F.lit(0).cast("long")).alias(n) for n in r.distinct])
        self._write("groups", done, delivery)
        touch(self.spark, f"{self.path}/applied/{delivery}")

    def _stage(self, df: DataFrame) -> DataFrame:
        """``df`` written to the shared scratch folder, as it is used several times."""
        path = scratch_dir(self.spark, "rollup")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _valid(self, ids: DataFrame, groups: DataFrame) -> DataFrame:
        """Newest bitmaps ``(keys, bucket, bits)`` of each group, those before it was last aggregated anew left out."""
        keys = list(self.rollup.keys)
        newest = ids.groupBy(*keys, "bucket").agg(F.max_by("bits", DELIVERY_COL).alias("bits"), F.max(DELIVERY_COL).alias("__at"))
        g = groups.select(*[F.col(k).alias(f"__g_{k}") for k in keys], "__epoch")
        met = newest.join(g, reduce(lambda a, b: a & b, [newest[k].eqNullSafe(g[f"__g_{k}"]) for k in keys]))
        return met.filter("__at >= __epoch").select(*keys, "bucket", "bits")
