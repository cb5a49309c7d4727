"""Streaming ingest: new files only, evolution, lineage, rescue, replay."""

import json
import os

import pytest
from pyspark.sql import functions as F

from stratum.plans import silver as S
from stratum.sources.tables import append_table, write_batch
from stratum.streaming.incremental import append_available
from stratum.streaming.ingest import _resolve, column_types, ingest_available, load_schema, read_bronze, rescued_rows, widened


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_ingest_evolution_and_rerun(spark, tmpdir_path):
    src, table, ckpt = (os.path.join(tmpdir_path, n) for n in ("src", "bronze", "ckpt"))
    os.makedirs(src)
    _write(f"{src}/a.csv", "id,v,d\n1,x,2024-01-01\n2,y,2024-01-02\n")
    _write(f"{src}/ignored.txt", "not,a,csv\n")
    ingest_available(spark, src, table, ckpt)
    assert read_bronze(spark, table).count() == 2
    ingest_available(spark, src, table, ckpt)          # nothing new
    assert read_bronze(spark, table).count() == 2
    # a new column in the middle: read by header, not by position
    _write(f"{src}/b.csv", "id,extra,v,d\n3,e,z,2024-01-03\n")
    ingest_available(spark, src, table, ckpt)
    df = read_bronze(spark, table)
    rows = {r.id: r.asDict() for r in df.collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[3]["v"] == "z" and rows[3]["extra"] == "e"
    assert rows[1]["extra"] is None
    assert rows[1]["__file"] == "a.csv" and rows[3]["__file"] == "b.csv"
    assert [f.name for f in load_schema(spark, ckpt + "_schema").fields] == ["id", "v", "d", "extra"]


def test_type_conflict_is_rescued(spark, tmpdir_path):
    src, table, ckpt = (os.path.join(tmpdir_path, n) for n in ("src", "bronze", "ckpt"))
    os.makedirs(src)
    _write(f"{src}/a.csv", "id,n\n1,10\n")
    ingest_available(spark, src, table, ckpt)
    _write(f"{src}/b.csv", "id,n\n2,abc\n3,1.5\n")
    ingest_available(spark, src, table, ckpt)
    rows = {r.id: r for r in read_bronze(spark, table).collect()}
    assert rows[1].n == 10 and rows[1]["__rescued"] is None
    assert rows[2].n is None and "abc" in rows[2]["__rescued"]
    assert rows[3].n is None and rows[3]["__rescued"] == '{"n":"1.5"}'
    # a file that also brings a new column is type-inferred; its values of
    # known columns are cast, and what does not fit is rescued per field
    _write(f"{src}/c.csv", "id,n,extra\n4,x,1\n5,7,2\n")
    ingest_available(spark, src, table, ckpt)
    rows = {r.id: r for r in read_bronze(spark, table).collect()}
    assert rows[4].n is None and rows[4]["__rescued"] == '{"n":"x"}'
    assert rows[5].n == 7 and rows[5].extra == 2 and rows[5]["__rescued"] is None


def test_lossy_values_are_rescued_beside_a_new_column(spark, tmpdir_path):
    src, table, ckpt = (os.path.join(tmpdir_path, n) for n in ("src", "bronze", "ckpt"))
    os.makedirs(src)
    _write(f"{src}/a.csv", "id,n,d\n1,10,2024-01-01\n")
    ingest_available(spark, src, table, ckpt)
    _write(f"{src}/b.csv", "id,n,d,extra\n2,7.5,2024-01-02,1\n3,8,2024-01-03,2\n")
    _write(f"{src}/c.csv", "id,n,d\n4,9,2024-01-04 10:30:00\n")
    ingest_available(spark, src, table, ckpt)
    rows = {r.id: r for r in read_bronze(spark, table).collect()}
    assert rows[2].n is None and rows[2]["__rescued"] == '{"n":"7.5"}'
    assert rows[3].n == 8 and rows[3]["__rescued"] is None
    assert rows[4].d is None and "10:30" in rows[4]["__rescued"]
    assert rescued_rows(read_bronze(spark, table)).first() == (4, 2)


def test_new_checkpoint_on_a_filled_table_is_refused(spark, tmpdir_path):
    src, table, ckpt = (os.path.join(tmpdir_path, n) for n in ("src", "bronze", "ckpt"))
    os.makedirs(src)
    _write(f"{src}/a.csv", "id\n1\n")
    ingest_available(spark, src, table, ckpt)
    with pytest.raises(ValueError, match="checkpoint"):
        ingest_available(spark, src, table, ckpt + "2")
    assert read_bronze(spark, table).count() == 1


@pytest.mark.parametrize("path, uri, inner", [
    ("s3a://bucket/a/b.csv", "s3://bucket/a/b.csv", "bucket/a/b.csv"),
    ("gs://bucket/a/b.csv", "gs://bucket/a/b.csv", "bucket/a/b.csv"),
    ("abfss://box@acct.dfs.core.windows.net/a/b.csv", "abfss://box@acct.dfs.core.windows.net/a/b.csv", "box/a/b.csv"),
    ("hdfs://host:8020/a/b.csv", "hdfs://host:8020/a/b.csv", "/a/b.csv")])
def test_paths_of_stores(path, uri, inner):
    opened = []

    class Arrow:
        class FileSystem:
            @staticmethod
            def from_uri(u):
                opened.append(u)
                return "fs", None

    cache = {}
    assert _resolve(Arrow, path, cache) == _resolve(Arrow, path, cache) == ("fs", inner)
    assert opened == [uri]
    with pytest.raises(ValueError, match="dbfs"):
        _resolve(Arrow, "dbfs://x/y.csv", cache)


def test_replayed_batch_is_idempotent(spark, tmpdir_path):
    from stratum.streaming.ingest import ingest_batch

    src, table = os.path.join(tmpdir_path, "src"), os.path.join(tmpdir_path, "bronze")
    os.makedirs(src)
    _write(f"{src}/a.csv", "id,v\n1,x\n2,y\n")
    paths = spark.createDataFrame([(f"file:{src}/a.csv",)], "path string")
    ingest_batch(spark, paths, 0, table, table + "_schema")
    ingest_batch(spark, paths, 0, table, table + "_schema")   # same batch id again
    assert read_bronze(spark, table).count() == 2


def test_vs_incremental_append(spark, tmpdir_path):
    bronze_dir, silver_dir, ckpt = (os.path.join(tmpdir_path, n) for n in ("b", "s", "c"))
    row = ("ST_0", 1, None, 70.0, 110.0, 70.0, 36.5, 14.0)
    schema = ("study_id string, subject_id long, visit_date date, heart_rate double, systolic_bp double, "
              "diastolic_bp double, temperature double, respiratory_rate double")
    first = spark.createDataFrame([row], schema).withColumn("visit_date", F.current_date())
    append_table(first, bronze_dir)
    append_available(spark, bronze_dir, silver_dir, ckpt, S.silver_vs)
    append_available(spark, bronze_dir, silver_dir, ckpt, S.silver_vs)
    assert spark.read.parquet(silver_dir).count() == 1
    append_table(first, bronze_dir)
    append_available(spark, bronze_dir, silver_dir, ckpt, S.silver_vs)
    assert spark.read.parquet(silver_dir).count() == 2


def test_rewritten_bronze_batch_leaves_no_duplicate(spark, tmpdir_path):
    from stratum.sources.tables import write_batch
    from stratum.streaming.incremental import upsert_available

    src, added, merged = (os.path.join(tmpdir_path, n) for n in ("b", "s", "m"))
    rows = spark.createDataFrame([(1, "a"), (None, "n"), (None, "n")], "k long, v string")
    for batch in (0, 1, 0):
        write_batch(rows, src, batch)
        append_available(spark, src, added, added + "_c", lambda d: d.select("k", "v"))
        upsert_available(spark, src, merged, merged + "_c", lambda d: d, ["k"], order=["__batch"], buckets=4)
    assert spark.read.parquet(added).count() == 6
    got = sorted((r.k or 0, r["__batch"]) for r in spark.read.parquet(merged).collect())
    assert got == [(0, 0), (0, 0), (0, 1), (0, 1), (1, 1)]


def test_upsert_incremental_merges_only_new_bronze(spark, tmpdir_path):
    from stratum.sources.tables import write_batch
    from stratum.streaming.incremental import upsert_available

    bronze_dir, silver_dir, ckpt = (os.path.join(tmpdir_path, n) for n in ("b", "s", "c"))
    schema = "k long, v string"
    write_batch(spark.createDataFrame([(1, "a"), (2, "b"), (2, "b0")], schema), bronze_dir, 0)
    run = lambda: upsert_available(spark, bronze_dir, silver_dir, ckpt, lambda d: d, ["k"],
                                   order=["__batch"], buckets=4)
    run()
    write_batch(spark.createDataFrame([(2, "B"), (3, "c")], schema), bronze_dir, 1)
    run()
    run()                                                     # nothing new
    got = {r.k: (r.v, r["__batch"]) for r in spark.read.parquet(silver_dir).collect()}
    assert got == {1: ("a", 0), 2: ("B", 1), 3: ("c", 1)}


def test_completed_batches_are_read_once(spark, tmpdir_path):
    """A batch of more files than a trigger takes is built once, whole, when it is complete."""
    src, dst = f"{tmpdir_path}/b", f"{tmpdir_path}/s"
    calls = []

    def build(df):
        calls.append(sorted(r[0] for r in df.select("__batch").distinct().collect()))
        return df.select("k", "__batch")

    run = lambda: append_available(spark, src, dst, dst + "_c", build, max_files_per_trigger=2)
    write_batch(spark.range(200).select(F.col("id").alias("k")).repartition(20), src, 0)
    run()
    assert calls == [[0]] and spark.read.parquet(dst).count() == 200
    for b in (1, 2):
        write_batch(spark.range(10).select(F.col("id").alias("k")).repartition(5), src, b)
    # written, but not complete: not seen
    (spark.range(3).select(F.col("id").alias("k"), F.lit(3).cast("long").alias("__batch")).write.mode("append").partitionBy("__batch").parquet(src))
    run()
    assert calls[1:] == [[1, 2]] and spark.read.parquet(dst).count() == 220
    write_batch(spark.range(7).select(F.col("id").alias("k")), src, 1)
    write_batch(spark.range(0).select(F.col("id").alias("k")), src, 2)  # written again, empty
    run()
    assert calls[2:] == [[1]] or calls[2:] == [[1], []]
    assert {r[0]: r[1] for r in spark.read.parquet(dst).groupBy("__batch").count().collect()} == {0: 200, 1: 7}
    run()
    assert len(calls) == 3


def test_lines_of_unlike_files_in_one_batch(spark, tmpdir_path):
    """Widths, order, quotes and broken lines of several headers, read in one pass."""
    src, table = f"{tmpdir_path}/a dir%", f"{tmpdir_path}/bronze"
    os.makedirs(src)
    _write(f"{src}/one é.csv", 'id,v\n1,x\n"2","a,b"\n3\n4,y,z\n\n5,"open\n')
    _write(f"{src}/two#.csv", "v,W,id,id,\nx,7,6,60,e\ny,,7,,\nz,8,8,80,e,more\nq,9,9\n")
    _write(f"{src}/head only.csv", "id,other\n")
    _write(f"{src}/empty.csv", "")
    ingest_available(spark, src, table, f"{tmpdir_path}/c")
    rows = {r.id: r.asDict() for r in read_bronze(spark, table, f"{tmpdir_path}/c_schema").collect()}
    assert set(rows) == set(range(1, 10))
    assert rows[2]["v"] == "a,b" and rows[2]["__rescued"] is None and rows[2]["__file"] == "one é.csv"
    assert rows[6] | {"__rescued": None} == rows[6] and (rows[6]["v"], rows[6]["W"], rows[6]["id3"], rows[6]["_c4"]) == ("x", 7, 60, "e")
    assert rows[7]["W"] is None and rows[7]["__rescued"] is None and rows[7]["other"] is None
    for bad, line in ((3, "3"), (4, "4,y,z"), (5, '5,"open'), (8, "z,8,8,80,e,more"), (9, "q,9,9")):
        assert json.loads(rows[bad]["__rescued"]) == {"_line": line}


def test_jobs_do_not_grow_with_headers(spark, tmpdir_path):
    from stratum.streaming.ingest import ingest_batch

    def jobs(n):
        src, table = f"{tmpdir_path}/s{n}", f"{tmpdir_path}/t{n}"
        os.makedirs(src)
        for k in range(n):
            _write(f"{src}/{k}.csv", f"id,own{k}\n{k},{k}\n")
        paths = spark.createDataFrame([(f"file:{src}/{k}.csv",) for k in range(n)], "path string")
        spark.sparkContext.setJobGroup(f"headers{n}", "")
        ingest_batch(spark, paths, 0, table, table + "_schema")
        assert read_bronze(spark, table).count() == n
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"headers{n}"))

    assert jobs(40) <= jobs(2) + 1


@pytest.mark.parametrize("known, values, want", [
    ("int", ["1"], "int"), ("int", ["3000000000"], "bigint"), ("int", ["1.5", "2"], "double"), ("bigint", ["1.25"], "decimal(38,10)"),
    ("bigint", ["1e3"], "string"), ("int", ["x"], "string"), ("double", ["7"], "double"), ("double", ["9007199254740993"], "string"),
    ("decimal(38,10)", ["5", "0.5"], "decimal(38,10)"), ("date", ["2024-01-01 10:00:00", "2024-01-02"], "timestamp"),
    ("timestamp", ["2024-01-02"], "timestamp"), ("boolean", ["1"], "string"), ("string", ["1"], "string"), ("date", ["soon"], "string")])
def test_widening(spark, known, values, want):
    pairs = spark.createDataFrame([(0, v) for v in values], "col int, value string")
    dtype = lambda name: spark.sql(f"SELECT CAST(NULL AS {name}) AS x").schema[0].dataType
    assert widened(dtype(known), column_types(pairs).first()) == dtype(want)


def test_widened_column_keeps_every_value(spark, tmpdir_path):
    src, table, ckpt = f"{tmpdir_path}/s", f"{tmpdir_path}/t", f"{tmpdir_path}/c"
    os.makedirs(src)
    drops = [("id,n,d\n1,1,2024-01-01\n", False), ("id,n,d\n2,2.5,x\n3,huge,2024-01-02\n", False), ("id,n,d\n4,3000000000,2024-01-03\n", True),
             ("id,n,e\n5,1.25,1\n", True), ("id,n\n6,text\n", True)]
    seen = []
    for k, (text, widen) in enumerate(drops):
        _write(f"{src}/{k}.csv", text)
        ingest_available(spark, src, table, ckpt, widen=widen)
        rows = read_bronze(spark, table, ckpt + "_schema")
        seen.append((rows.schema["n"].dataType.simpleString(), {r.id: (r.n if r.n is None else str(r.n), r["__rescued"]) for r in rows.collect()}))
    assert [t for t, _ in seen] == ["int", "int", "bigint", "decimal(38,10)", "string"]
    assert seen[1][1][2] == (None, '{"n":"2.5","d":"x"}')
    assert seen[3][1][2] == ("2.5000000000", '{"d":"x"}') and seen[3][1][3] == (None, '{"n":"huge"}')
    assert {k: v[0] for k, v in seen[4][1].items()} == {1: "1", 2: "2.5", 3: "huge", 4: "3000000000", 5: "1.2500000000", 6: "text"}
    assert seen[4][1][3][1] is None and seen[4][1][2][1] == '{"d":"x"}'
