"""Maintained aggregates, mergeable distinct counts and partition refresh."""

import os
import random
from datetime import date

from pyspark.sql import functions as F

from stratum.functions.rollup import mean, rsum
from stratum.operators.bitmaps import LabelIds, bitmaps, count_bitmaps, dense_numbers, merge_bitmaps
from stratum.operators.changes import CHANGE_COL, ChangeLog, multiset_changes
from stratum.operators.refresh import _hashes, refresh_partitions
from stratum.operators.rollup_state import SIGN, Rollup, RollupState, signed
from stratum.operators.upsert import upsert_table
from stratum.plans.gold import gold_capa
from stratum.plans.gold_state import _weight_changes, maintain
from stratum.plans.silver import silver_deviation
from stratum.sources.tables import Layout

SCHEMA = "g string, h int, x double, id long"


def _rollup():
    return Rollup(["g", "h"], {"n": F.lit(True), "pos": F.col("x") > 0}, means={"avg_x": (F.col("x"), 2)}, totals={"sum_x": (F.col("x"), 1)},
                  lows={"lo": F.col("x")}, highs={"hi": F.col("x")}, distinct={"ids": "id"})


def _rebuilt(df):
    return df.groupBy("g", "h").agg(F.count("*").alias("n"), F.count_if(F.col("x") > 0).alias("pos"), mean("x", 2).alias("avg_x"),
                                    rsum("x", 1).alias("sum_x"), F.min("x").alias("lo"), F.max("x").alias("hi"),
                                    F.count_distinct("id").alias("ids"))


def _rows(df):
    return sorted((repr(tuple(r)) for r in df.select("g", "h", "n", "pos", "avg_x", "sum_x", "lo", "hi", "ids").collect()))


def test_state_equals_rebuild(spark, tmpdir_path):
    rng = random.Random(7)

    def row():
        return (rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice([1.005, -2.5, 0.125, 7.0, None, 1e30, float("nan")]),
                rng.choice([1, 2, 40000, -5, None]))

    state = RollupState(spark, f"{tmpdir_path}/s", _rollup())
    table = []
    for version in range(3):
        before = spark.createDataFrame(table, SCHEMA)
        table = [r for r in table if rng.random() < 0.7 and not (version == 2 and r[0] == "b")] + [row() for _ in range(25 if version < 2 else 0)]
        now = spark.createDataFrame(table, SCHEMA)
        changes = signed(multiset_changes(before, now))
        state.apply(changes, version, now)
        assert _rows(state.mart()) == _rows(_rebuilt(now))
        state.apply(changes, version, now)  # a replay
        assert _rows(state.mart()) == _rows(_rebuilt(now))


def test_untouched_groups_are_not_written(spark, tmpdir_path):
    state = RollupState(spark, f"{tmpdir_path}/s", _rollup())
    first = spark.createDataFrame([("a", 1, 1.0, 1), ("b", 1, 2.0, 2)], SCHEMA)
    state.apply(first.withColumn("__sign", F.lit(1).cast("long")), 0, first)
    files = set(spark.read.parquet(f"{tmpdir_path}/s/groups").inputFiles())
    more = spark.createDataFrame([("a", 1, 5.0, 3)], SCHEMA)
    state.apply(more.withColumn("__sign", F.lit(1).cast("long")), 1, first.unionByName(more))
    assert [r["g"] for r in state.touched(0).collect()] == ["a"]
    assert files <= set(spark.read.parquet(f"{tmpdir_path}/s/groups").inputFiles())
    # a delivery that was not finished is not seen, and cleared by the next
    os.remove(f"{tmpdir_path}/s/applied/1")
    assert {r["g"]: r["n"] for r in state.mart().collect()} == {"a": 1, "b": 1}
    state.apply(more.withColumn("__sign", F.lit(1).cast("long")), 2, first.unionByName(more))
    assert {r["g"]: (r["n"], r["ids"], r["hi"]) for r in state.mart().collect()} == {"a": (2, 2, 5.0), "b": (1, 1, 2.0)}
    assert not os.path.exists(f"{tmpdir_path}/s/groups/__delivery=1")


def test_distinct_counts_merge(spark):
    ids = [0, 1, -1, 32767, 32768, 32769, -32768, -32769, 10**12, None]
    a = spark.createDataFrame([("g", i) for i in ids] * 2 + [(None, 5)], "k string, i long")
    b = spark.createDataFrame([("g", i) for i in (1, 2, 10**12)] + [("h", 1), (None, 6), ("empty", None)], "k string, i long")
    parts = bitmaps(a, ["k"], "i").unionByName(bitmaps(b, ["k"], "i"))
    got = {r["k"]: r["n"] for r in count_bitmaps(merge_bitmaps(parts, ["k"]), ["k"], "n").collect()}
    assert got == {"g": 10, "h": 1, None: 2}


def test_label_ids_stay(spark, tmpdir_path):
    ids = LabelIds(spark, f"{tmpdir_path}/l")
    ids.extend(spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "t string"))
    first = {r["label"]: r["id"] for r in ids.table().collect()}
    assert first == {"a": 1, "b": 2}
    ids.extend(spark.createDataFrame([("a",), ("0",)], "t string"))
    assert {r["label"]: r["id"] for r in ids.table().collect()} == {**first, "0": 3}
    out = ids.encode(spark.createDataFrame([("a", 1), (None, 2), ("?", 3)], "t string, n int"), "t", "no")
    assert sorted((r["n"], r["no"]) for r in out.collect() if r["no"]) == [(1, 1)] and out.count() == 3


def test_dense_numbers(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    assert all(r["v"] + 5 == r["n"] for r in dense_numbers(df, ["v"], "n", 5).collect())


def test_only_changed_partitions_are_written(spark, tmpdir_path):
    path, changes = f"{tmpdir_path}/t", f"{tmpdir_path}/c"
    frame = lambda rows: spark.createDataFrame(rows, "v string, stamp int, p long")
    first = [("a", 0, 0), ("a", 0, 0), ("b", 0, 0), ("c", 0, 1)]
    assert sorted(refresh_partitions(spark, path, frame(first), [0, 1], "p", changes, 0, ["stamp"])) == [0, 1]
    second = lambda: {f for f in spark.read.parquet(path).inputFiles() if "/p=1/" in f}
    files = second()
    again = [("a", 9, 0), ("a", 9, 0), ("a", 9, 0), ("c", 9, 1)]
    assert refresh_partitions(spark, path, frame(again), [0, 1], "p", changes, 1, ["stamp"]) == [0]
    assert sorted((r[CHANGE_COL], r["v"]) for r in ChangeLog(spark, changes).read(1).collect()) == [("delete", "b"), ("insert", "a")]
    table = spark.read.parquet(path)
    assert sorted((r["v"], r["p"]) for r in table.collect()) == [("a", 0)] * 3 + [("c", 1)]
    assert files == second()
    assert refresh_partitions(spark, path, frame([]), [0], "p", changes, 2, ["stamp"]) == [0]
    assert [r["v"] for r in spark.read.parquet(path).collect()] == ["c"]
    assert refresh_partitions(spark, path, frame(first), [0, 1], "p", changes, 2, ["stamp"]) == []  # a replay


def test_rows_are_told_apart_by_hash(spark, tmpdir_path):
    """All rows of a batch changed, few did, and copies came or went: change rows are as those of a whole comparison,
    and what did not change, or is new, is not shuffled whole."""
    frame = lambda rows: spark.createDataFrame(rows, "v string, n double, stamp int, p long")
    old = [(f"r{i}", float(i), 0, 0) for i in range(40)] + [("twin", None, 0, 0)] * 3 + [("gone", 1.0, 0, 1)] + [("all", float(i), 0, 2) for i in range(9)]
    few = [(f"r{i}", float(i), 5, 0) for i in range(38)] + [("twin", None, 5, 0)] * 2 + [("new", 0.5, 5, 0)] * 2
    new = few + [("other", float(i), 5, 2) for i in range(9)] + [("first", 0.0, 5, 3)] * 2
    path, changes = f"{tmpdir_path}/t", f"{tmpdir_path}/c"
    refresh_partitions(spark, path, frame(old), [0, 1, 2], "p", changes, 0, ["stamp"])
    assert sorted(refresh_partitions(spark, path, frame(new), [0, 1, 2, 3], "p", changes, 1, ["stamp"])) == [0, 1, 2, 3]
    kept = lambda df: sorted(repr((r[CHANGE_COL], r["v"], r["n"], r["p"])) for r in df.collect())
    assert kept(ChangeLog(spark, changes).read(1)) == kept(multiset_changes(frame(old), frame(new), CHANGE_COL, ["stamp"]))
    assert sorted(map(repr, spark.read.parquet(path).select("v", "n", "stamp", "p").collect())) == sorted(map(repr, frame(new).collect()))
    plan = str(multiset_changes(frame(old), frame(new))._jdf.queryExecution().executedPlan())
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Aggregate") < plan.index("Exchange")


def test_distinct_ids_take_words_not_blocks(spark):
    df = spark.range(2000).selectExpr("id % 500 AS k", "id % 5 AS i")
    parts = bitmaps(df, ["k"], "i")
    assert dict(parts.dtypes)["bits"] == "bigint" and parts.count() == 500
    assert "SortAggregate" not in str(parts._jdf.queryExecution().executedPlan())


def test_partitions_that_changed_whole_are_written_from_their_change_rows(spark, tmpdir_path):
    """Rows are not built once more for a partition that is new or of which no row stayed."""
    path, changes = f"{tmpdir_path}/t", f"{tmpdir_path}/c"
    frame = lambda rows: spark.createDataFrame(rows, "v string, n double, p long").withColumn("stamp", F.current_timestamp())
    stamps = lambda df, p: {r["v"]: r["stamp"] for r in df.filter(F.col("p") == p).collect()}
    inserts = lambda n: ChangeLog(spark, changes).read(n, n).filter(F.col(CHANGE_COL) == "insert")
    assert sorted(refresh_partitions(spark, path, frame([("a", 1.0, 0), ("b", None, 0), ("c", 1.0, 1)]), [0, 1], "p", changes, 0, ["stamp"])) == [0, 1]
    assert all(stamps(inserts(0), p) == stamps(spark.read.parquet(path), p) for p in (0, 1))
    new = [("a", 1.0, 0), ("b", 2.0, 0), ("C", None, 1), ("d", 1.0, 1), ("e", 1.0, 2)]
    assert sorted(refresh_partitions(spark, path, frame(new), [0, 1, 2], "p", changes, 1, ["stamp"])) == [0, 1, 2]
    table = spark.read.parquet(path)
    assert sorted((r["v"], r["n"] or 0, r["p"]) for r in table.collect()) == sorted((v, n or 0, p) for v, n, p in new)
    assert all(stamps(inserts(1), p) == stamps(table, p) for p in (1, 2))
    assert sorted(r["v"] for r in inserts(1).collect()) == ["C", "b", "d", "e"]


def test_nulls_in_other_places_are_other_rows(spark):
    rows = spark.createDataFrame([("a", None, "b"), (None, "a", "b"), ("a", "b", None), (None, None, None)], "x string, y string, z string")
    assert rows.select(*[h.alias(f"h{i}") for i, h in enumerate(_hashes(rows.columns))]).distinct().count() == 4


def test_capa_follows_lots_and_deviations(spark, tmpdir_path):
    """Deviations and lots that change together, batches that gain or lose their last lots: the kept mart is the rebuilt
    one, and only what changed is added to it."""
    lay, rng = Layout(tmpdir_path), random.Random(5)
    dev, lot = {}, []
    kept = lambda df: sorted(repr(tuple(r)) for r in df.select(sorted(df.columns)).collect())

    def deviation(k):
        return (k, rng.randrange(8), rng.choice(["E1", "E2", " E3"]), rng.choice(["PROCESS", "EQUIPMENT"]), rng.choice(["CRITICAL", "MAJOR"]), "d", "r", "c", "by",
                date(2024, rng.choice([1, 2]), 3), date(2024, 3, rng.randrange(1, 28)), rng.choice(["OPEN", "CLOSED"]))

    dev_schema = ("deviation_id long, batch_id long, equipment_id string, deviation_type string, severity string, description string, root_cause string, "
                  "corrective_action string, reported_by string, reported_date date, closure_date date, status string")
    lot_schema = "batch_id long, plant_id string, drug_code string, manufacture_month string, yield_class string, __batch long"

    def deliver(n, devs, lots):
        if devs:
            dev.update({d[0]: d for d in devs})
            upsert_table(spark, lay.silver("mfg_deviation"), silver_deviation(spark.createDataFrame(devs, dev_schema)), ["deviation_id"],
                         buckets=2, changes=lay.changes("mfg_deviation"), version=n)
        if lots is not None:
            lot[:] = lots
            refresh_partitions(spark, lay.silver("mfg_lot"), spark.createDataFrame([(*r, 0) for r in lots], lot_schema), [0], "__batch",
                               lay.changes("mfg_lot"), n)
        got = maintain(spark, lay, "gold_capa")
        want = gold_capa(silver_deviation(spark.createDataFrame(list(dev.values()), dev_schema)),
                         spark.createDataFrame([(*r, 0) for r in lot], lot_schema))
        assert kept(got) == kept(want)

    def some_lots(batches):
        return [(b, rng.choice(["P1", "P2"]), rng.choice(["D1", "D2"]), rng.choice(["m1", "m2"]), rng.choice(["High", "Low"])) for b in batches for _ in range(3)]

    deliver(0, [deviation(k) for k in range(12)], some_lots([0, 1, 2, 3, 9]))
    deliver(1, [deviation(k) for k in range(6, 16)], None)
    deliver(2, [], some_lots([1, 2, 4, 9]))
    deliver(3, [deviation(k) for k in range(3, 20, 2)], some_lots([0, 4, 5, 6]))
    # one batch gets a lot row more: its deviations alone come again
    lots, more = spark.createDataFrame([(*r, 0) for r in [*lot, (5, "P9", "D1", "m1", "Low"), (7, "P1", "D1", "m1", "Low")]], lot_schema), \
        spark.createDataFrame([(5, "P9", "D1", "m1", "Low", 1), (7, "P1", "D1", "m1", "Low", 1)], lot_schema.replace("__batch", SIGN))
    moved = _weight_changes(lots, more, spark.createDataFrame([(5,), (7,)], "batch_id long"))
    assert sorted(map(repr, moved.collect())) == sorted(["Row(batch_id=5, plant_id='P9', drug_code='D1', __w=1)", "Row(batch_id=7, plant_id='P1', drug_code='D1', __w=1)",
                                                         "Row(batch_id=7, plant_id=None, drug_code=None, __w=-1)"])
