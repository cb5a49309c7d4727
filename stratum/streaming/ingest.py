"""Incremental CSV ingest into an append-only bronze table.

Contract (per source folder):

* Only files not seen before are read (Structured Streaming file source
  with a checkpoint; ``availableNow`` drains what is there and stops).
* ``pathGlobFilter`` restricts the files (default ``*.csv``); the first line
  of every file is its header; column types are inferred.
* Every row carries its source file name in ``__file`` (lineage) and the
  micro-batch id in ``__batch``.
* The table schema is remembered between runs.  A file may add columns;
  they are appended to the schema as nullable and older rows read as NULL.
  A known column keeps its type: a value that does not fit it exactly reads
  as NULL and is kept, as text, under its column's name in the ``__rescued``
  JSON column instead of failing the batch (a line with too few or too many
  fields is kept whole, as ``_line``).
* With ``widen``, a column whose new values don't fit it gets a wider type
  instead (int, bigint or double, decimal, text): earlier batches are read as
  that type, and values rescued before the widening are put back at read.
* A checkpoint numbers its batches from 0, so a new one on a table that has
  batches already is refused: it would overwrite them.
* A replayed micro-batch (after a crash between write and commit) rewrites
  its own ``__batch`` partition, so the output has no duplicates.

How it runs: the stream itself only discovers paths (``binaryFile`` with
only ``path`` selected, so file contents are not read).  Each micro-batch
reads the headers inside tasks (one short read per file), and then all its
files in one CSV read, as text fields by position; each line finds the
positions of the table's columns by its file's header, so a column that moved
or appeared is never read into the wrong place.  The number of jobs does not
grow with the number of headers: one write, and one aggregation of the types
of new columns if there are any.  Only the batch's path list reaches the
driver; bound it with ``max_files_per_trigger``.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratum.sources.tables import load_schema, load_versions, path_exists, save_schema, write_batch

FILE_COL = "__file"
BATCH_COL = "__batch"
RESCUED_COL = "__rescued"
CORRUPT_COL = "__corrupt"
META_COLS = (FILE_COL, BATCH_COL, RESCUED_COL)
# Fixed schema of Spark's binaryFile source (streaming sources need it given).
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


# ---- schema memory ------------------------------------------------------------

def evolve_schema(known: T.StructType | None, incoming: T.StructType) -> T.StructType:
    """Known columns keep their position and type; new columns are appended
    (nullable) in the order they first appear."""
    if known is None:
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in incoming.fields])
    names = {f.name.lower() for f in known.fields}
    added = [T.StructField(f.name, f.dataType, True) for f in incoming.fields
             if f.name.lower() not in names]
    return T.StructType(list(known.fields) + added)


def _changed(src: Column, cast: Column, incoming: T.DataType, known: T.DataType) -> Column:
    """Whether ``cast`` to the known type alters ``src`` (1.5 into an int)."""
    if not isinstance(incoming, T.StringType):
        return cast.try_cast(incoming) != src
    # from text a cast fails rather than alters, but for a date's time of day
    # and a decimal's further digits
    if isinstance(known, T.DateType):
        return src.try_cast("timestamp") != cast.cast("timestamp")
    if isinstance(known, T.DecimalType):
        return src.try_cast("double") != cast.cast("double")
    return F.lit(False)


def conform(df: DataFrame, schema: T.StructType, lenient: Column | None = None) -> DataFrame:
    """Project ``df`` onto ``schema``: missing columns become NULL, values of
    a known column are ``try_cast`` to its type, and values that the cast
    would drop or change become NULL and are kept as text in ``__rescued``
    (JSON object, NULL when none).  Where ``lenient``, text such as 5.0 is a
    whole number."""
    present = {c.lower(): c for c in df.columns}
    cols, bad = [], []
    for f in schema.fields:
        src = present.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        incoming = df.schema[src].dataType
        if incoming == f.dataType:
            cols.append(F.col(src).alias(f.name))
            continue
        cast = F.col(src).try_cast(f.dataType)
        if lenient is not None and isinstance(f.dataType, (T.IntegerType, T.LongType)):
            number = F.col(src).try_cast("double")
            cast = F.coalesce(cast, F.when(lenient & (number == F.floor(number)), number.try_cast(f.dataType)))
        lossy = F.col(src).isNotNull() & F.coalesce(cast.isNull() | _changed(F.col(src), cast, incoming, f.dataType),
                                                    F.lit(True))
        cols.append(F.when(~lossy, cast).alias(f.name))
        bad.append(F.when(lossy, F.col(src).cast("string")).alias(f.name))
    if bad:
        js = F.to_json(F.struct(*bad))
        rescued = F.when(js != F.lit("{}"), js)
    else:
        rescued = F.lit(None).cast("string")
    if CORRUPT_COL in df.columns:
        line = F.when(F.col(CORRUPT_COL).isNotNull(),
                      F.to_json(F.struct(F.col(CORRUPT_COL).alias("_line"))))
        rescued = F.coalesce(rescued, line)
    keep = [F.col(c) for c in (FILE_COL,) if c in df.columns]
    return df.select(*cols, *keep, rescued.alias(RESCUED_COL))


# ---- header discovery (inside tasks) ----------------------------------------------

# Hadoop scheme -> (Arrow's scheme, whether the path inside starts with the bucket or container).
ARROW_SCHEMES = {"s3": ("s3", True), "s3a": ("s3", True), "s3n": ("s3", True), "gs": ("gs", True), "gcs": ("gcs", True),
                 "abfs": ("abfs", True), "abfss": ("abfss", True), "hdfs": ("hdfs", False), "viewfs": ("viewfs", False)}


def _first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs as pafs

    cache: dict[str, tuple] = {}
    for pdf in batches:
        heads = []
        for p in pdf["path"]:
            filesystem, inner = _resolve(pafs, p, cache)
            with filesystem.open_input_stream(inner) as fh:
                buf = b""
                while b"\n" not in buf:
                    chunk = fh.read(65536)
                    if not chunk:
                        break
                    buf += chunk
            heads.append(buf.split(b"\n", 1)[0].decode("utf-8-sig").rstrip("\r"))
        yield pd.DataFrame({"path": pdf["path"], "header": heads})


def _resolve(pafs, path: str, cache: dict):
    """(filesystem, path inside it) for a Hadoop-style path.

    Hadoop's ``s3a`` / ``s3n`` are the store that Arrow calls ``s3``.  The
    file system of a store is opened once; the path inside it follows the
    store: with its bucket or container, without a host.
    """
    if path.startswith("file:"):
        local = path[len("file:"):]
        while local.startswith("//"):
            local = local[1:]
        return pafs.LocalFileSystem(), local
    scheme, rest = path.split("://", 1)
    netloc = rest.split("/", 1)[0]
    if scheme == "dbfs" or (scheme not in ARROW_SCHEMES):
        raise ValueError(f"file headers can't be read from {scheme}: use one of {sorted(ARROW_SCHEMES)}")
    scheme, with_bucket = ARROW_SCHEMES[scheme]
    key = f"{scheme}://{netloc}"
    if key not in cache:
        cache[key] = pafs.FileSystem.from_uri(f"{scheme}://{rest}")[0]
    inside = rest.split("/", 1)[1]
    return cache[key], f"{netloc.split('@')[0]}/{inside}" if with_bucket else f"/{inside}"


def headers_of(paths: DataFrame) -> DataFrame:
    """(path, header) for a DataFrame of file paths, read in tasks."""
    return paths.select("path").mapInPandas(_first_lines, "path string, header string")


# Ship the task-side functions of this module with the task (by value), so
# Python workers need not be able to import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# ---- the micro-batch ----------------------------------------------------------------

def header_names(header: str) -> list[str]:
    """Column names of a CSV header line (quoted names allowed)."""
    return next(csv.reader([header])) if header else []


def column_names(header: str) -> list[str]:
    """Names of a file's columns; one without a name, or named like one before it, gets its position's."""
    names: list[str] = []
    for i, name in enumerate(header_names(header)):
        taken = {n.lower() for n in names}
        name = name or f"_c{i}"
        names.append(f"{name}{i}" if name.lower() in taken else name)
    return names


#: Closes a line to count its fields; not a text that a field holds.
END = "\x01end\x01"


def read_csv_files(spark: SparkSession, names: dict[str, list[str]]) -> DataFrame:
    """All lines of CSV files (path -> its column names) in one read.

    Returns ``__fields`` (the line's fields as text, by position), ``__uri``
    of its file, ``__corrupt``: the line where it can't be split
    as the widest file's are, and ``__count``: its number of fields.
    """
    width = max(map(len, names.values()))
    cols = [f"c{i}" for i in range(width)]
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in (*cols, CORRUPT_COL)])
    lines = (spark.read.option("header", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COL)
             .option("columnPruning", "false").schema(schema).csv(sorted(names)))
    # A line of another width than the widest file's comes with its text: the
    # place of a closing field in it tells how many fields it has.
    ended = F.from_csv(F.concat(CORRUPT_COL, F.lit(f",{END}")), F.lit(", ".join(f"t{i} string" for i in range(width + 1))))
    lines = lines.select(F.array(*cols).alias("__fields"), CORRUPT_COL, F.col("_metadata.file_path").alias("__uri"), ended.alias("__ended"))
    place = F.array_position(F.array(*[F.col("__ended")[f"t{i}"] for i in range(width + 1)]), F.lit(END)) - 1
    return lines.select("__fields", CORRUPT_COL, "__uri",
                        F.when(F.col(CORRUPT_COL).isNull(), F.lit(width)).otherwise(place).alias("__count"))


def _layouts(spark: SparkSession, names: dict[str, list[str]], columns: list[str], fresh: set[str]) -> DataFrame:
    """For every file its name and where its lines have the table's ``columns``: ``(__uri, __file, __width, __at, __lenient)``."""
    jvm = spark.sparkContext._jvm
    layouts = list(dict.fromkeys(map(tuple, names.values())))
    heads = []
    for k, own in enumerate(layouts):
        at = {n.lower(): i for i, n in enumerate(own)}
        heads.append((k, len(own), [at.get(c.lower(), -1) for c in columns], any(n.lower() in fresh for n in own)))
    number = {own: k for k, own in enumerate(layouts)}
    files = [(jvm.org.apache.hadoop.fs.Path(p).toUri().toString(), p.rsplit("/", 1)[-1], number[tuple(own)]) for p, own in names.items()]
    return spark.createDataFrame(files, f"__uri string, {FILE_COL} string, __head int").join(
        spark.createDataFrame(heads, "__head int, __width int, __at array<int>, __lenient boolean"), "__head").drop("__head")


# Types that a text column can be read as, by what all its values are.
WHOLE, PLAIN = r"^[+-]?[0-9]{1,19}$", r"^[+-]?[0-9]{1,28}(\.[0-9]{0,10})?$"
DAY, MOMENT = r"^\d{4}-\d{2}-\d{2}$", r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}.*)?$"
PLAIN_TYPE = T.DecimalType(38, 10)


def column_types(pairs: DataFrame) -> DataFrame:
    """``(col, value)`` texts -> for each column, of which kinds all its values are."""
    v = F.col("value")

    def all_are(fits: Column) -> Column:
        return F.coalesce(F.every(fits), F.lit(False))

    return pairs.filter(v.isNotNull()).groupBy("col").agg(
        all_are(v.rlike(WHOLE) & v.try_cast("int").isNotNull()).alias("int"), all_are(v.rlike(WHOLE) & v.try_cast("long").isNotNull()).alias("long"),
        all_are(v.rlike(PLAIN)).alias("plain"), all_are(v.try_cast("double").isNotNull() & ~v.rlike(r"\s")).alias("double"),
        all_are(v.rlike(DAY) & v.try_cast("date").isNotNull()).alias("date"),
        all_are(v.rlike(MOMENT) & v.try_cast("timestamp").isNotNull()).alias("timestamp"), all_are(F.lower(v).isin("true", "false")).alias("boolean"))


def inferred(kinds) -> T.DataType:
    """The narrowest type of a column's values (a row of ``column_types``)."""
    for kind, dtype in (("int", T.IntegerType()), ("long", T.LongType()), ("double", T.DoubleType()), ("date", T.DateType()),
                        ("timestamp", T.TimestampType()), ("boolean", T.BooleanType())):
        if kinds[kind]:
            return dtype
    return T.StringType()


def widened(known: T.DataType, kinds) -> T.DataType:
    """The narrowest type that holds, unchanged, all values of type ``known`` and those of ``kinds``."""
    new = inferred(kinds)
    if isinstance(known, T.StringType) or new == known:
        return known
    if isinstance(known, (T.IntegerType, T.LongType)) and isinstance(new, (T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(known, T.IntegerType) and isinstance(new, T.DoubleType) or isinstance(known, T.DoubleType) and isinstance(new, T.IntegerType):
        return T.DoubleType()
    if isinstance(known, (T.IntegerType, T.LongType)) and kinds["plain"] or known == PLAIN_TYPE and kinds["plain"]:
        return PLAIN_TYPE
    if isinstance(known, T.TimestampType) and isinstance(new, T.DateType) or isinstance(known, T.DateType) and isinstance(new, T.TimestampType):
        return T.TimestampType()
    return T.StringType()


def ingest_batch(spark: SparkSession, batch: DataFrame, batch_id: int, table: str,
                 schema_store: str, infer: bool = True, widen: bool = False) -> None:
    """Process one micro-batch of discovered paths (``foreachBatch`` body)."""
    names = {r["path"]: column_names(r["header"]) for r in headers_of(batch).collect()}
    names = {p: n for p, n in names.items() if n}
    if not names:
        return
    known = load_schema(spark, schema_store)
    have = {f.name.lower() for f in known.fields} if known is not None else set()
    fresh: dict[str, str] = {}
    for own in sorted(names.values()):
        for n in own:
            if n.lower() not in have:
                fresh.setdefault(n.lower(), n)
    fields = [*(known.fields if known is not None else []), *[T.StructField(n, T.StringType(), True) for n in fresh.values()]]
    columns = [f.name for f in fields]
    lines = read_csv_files(spark, names).join(_layouts(spark, names, columns, set(fresh)), "__uri")
    asked = [i for i, f in enumerate(fields) if infer and f.name.lower() in fresh or widen and not isinstance(f.dataType, T.StringType)]
    if asked:
        pairs = F.transform(F.array(*[F.lit(i) for i in asked]), lambda i: F.struct(i.alias("col"), F.get("__fields", F.get("__at", i)).alias("value")))
        whole = lines.filter(F.col("__count") == F.col("__width"))
        for kinds in column_types(whole.select(F.inline(F.filter(pairs, lambda p: p["value"].isNotNull())))).collect():
            i = kinds["col"]
            dtype = inferred(kinds) if fields[i].name.lower() in fresh else widened(fields[i].dataType, kinds)
            fields[i] = T.StructField(fields[i].name, dtype, True)
    schema = T.StructType(fields)
    if known is None or schema != known:
        save_schema(spark, schema_store, schema, batch_id)
    texts = [F.get("__fields", F.get("__at", F.lit(i))).alias(c) for i, c in enumerate(columns)]
    line = F.to_csv(F.struct(*[F.get("__fields", F.lit(i)).alias(f"c{i}") for i in range(max(map(len, names.values())))]))
    odd = F.when(F.col("__count") != F.col("__width"), F.coalesce(F.col(CORRUPT_COL), line))
    rows = conform(lines.select(*texts, FILE_COL, odd.alias(CORRUPT_COL), "__lenient"), schema, F.col("__lenient"))
    write_batch(rows, table, batch_id, BATCH_COL)


def ingest_csv_stream(spark: SparkSession, src_dir: str, table: str, checkpoint: str,
                      schema_store: str | None = None, glob: str = "*.csv",
                      max_files_per_trigger: int | None = 1000, infer: bool = True,
                      available_now: bool = True, widen: bool = False) -> StreamingQuery:
    """Start the incremental ingest of ``src_dir`` into the Parquet ``table``.

    ``schema_store`` defaults to ``<checkpoint>_schema`` (beside, not inside,
    the stream checkpoint).  With ``available_now`` the query drains the
    files present and stops; call ``awaitTermination()``.
    """
    store = schema_store or checkpoint.rstrip("/") + "_schema"
    if path_exists(spark, table) and not path_exists(spark, checkpoint):
        raise ValueError(f"{table} holds batches that the new checkpoint {checkpoint} did not write and would "
                         "overwrite; go on with the table's own checkpoint, or ingest into another table")
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("pathGlobFilter", glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    paths = reader.load(src_dir).select("path")
    writer = (paths.writeStream
              .option("checkpointLocation", checkpoint)
              .foreachBatch(lambda b, i: ingest_batch(b.sparkSession, b, i, table, store, infer, widen)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def ingest_available(spark: SparkSession, src_dir: str, table: str, checkpoint: str,
                     **kwargs) -> None:
    """Run the ingest until every present file is processed."""
    q = ingest_csv_stream(spark, src_dir, table, checkpoint, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def read_bronze(spark: SparkSession, table: str, schema_store: str | None = None) -> DataFrame:
    """Read the bronze table across schema versions.

    With its ``schema_store``, batches written before a column was widened
    are read by the schema they were written with and cast to the newest one,
    and values that were rescued because the column was too narrow are put
    back.  Without it the files' schemas are merged, which fails where types differ.
    """
    versions = load_versions(spark, schema_store) if schema_store else []
    if not versions:
        return spark.read.option("mergeSchema", "true").parquet(table)
    newest = versions[-1][1]
    # Versions that only add columns read alike; a new reader starts where a type changes.
    spans: list[list] = []
    for v, schema in versions:
        types = {f.name: f.dataType for f in schema.fields}
        if spans and all(types.get(f.name) == f.dataType for f in spans[-1][1].fields):
            spans[-1][1] = schema
        else:
            spans.append([v, schema])
    parts = []
    for k, (first, schema) in enumerate(spans):
        meta = [T.StructField(FILE_COL, T.StringType()), T.StructField(RESCUED_COL, T.StringType()), T.StructField(BATCH_COL, T.LongType())]
        rows = spark.read.schema(T.StructType([*schema.fields, *meta])).parquet(table)
        if k > 0:
            rows = rows.filter(F.col(BATCH_COL) >= first)
        if k + 1 < len(spans):
            rows = rows.filter(F.col(BATCH_COL) < spans[k + 1][0])
        parts.append(_promote(rows, schema, newest))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _promote(rows: DataFrame, old: T.StructType, new: T.StructType) -> DataFrame:
    """Rows of an earlier schema version as the newest has them."""
    was = {f.name: f.dataType for f in old.fields}
    wider = [f.name for f in new.fields if f.name in was and was[f.name] != f.dataType]
    kept = F.from_json(RESCUED_COL, F.lit("map<string,string>"))
    cols = []
    for f in new.fields:
        if f.name not in was:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.name in wider:
            back = kept[F.lit(f.name)]
            cols.append(F.coalesce(F.col(f.name).cast(f.dataType), back.try_cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    if not wider:
        return rows.select(*cols, FILE_COL, RESCUED_COL, BATCH_COL)
    types = {f.name: f.dataType for f in new.fields}
    fits = F.struct(*[kept[F.lit(c)].try_cast(types[c]).isNotNull().alias(c) for c in wider])
    left = F.map_filter(kept, lambda k, v: ~_any([(k == c) & fits[c] for c in wider]))
    rescued = F.when(kept.isNotNull() & (F.size(left) > 0), F.to_json(left))
    return rows.select(*cols, FILE_COL, F.when(F.col(RESCUED_COL).isNotNull(), rescued).alias(RESCUED_COL), BATCH_COL)


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | F.coalesce(c, F.lit(False))
    return out


def rescued_rows(bronze: DataFrame) -> DataFrame:
    """One row: ``total_rows`` and ``rescued_rows``, those with a rescued value."""
    return bronze.agg(F.count("*").alias("total_rows"),
                      F.count_if(F.col(RESCUED_COL).isNotNull()).alias("rescued_rows"))
