"""Reversible line dedup: exact reference counts behind sharded cuckoo filters.

An index is a folder of Parquet tables, one generation per insertion or deletion of
documents; a generation holds what it changed, and readers take the newest entry.

* ``references``: line key (128-bit hash), document, live or not.  The truth.
* ``counts``: line key, the number of documents that hold it, the largest of them.
* ``filters``: per shard of the keys, a cuckoo filter of the keys that enough
  documents hold.  A key enters when its exact count reaches the threshold and leaves
  when it falls below, so that a fingerprint is only removed if it was entered.
* ``log``: the generation's name; written last, so that an unfinished one is not seen
  and the next try takes a new folder.

To find the lines to drop, references are looked up in the filters (two bytes a key);
only those found go to the exact counts, which settle them.  Filters are sent to every
task as long as they take ``FILTER_BYTES`` in all; beyond it references and filters
meet by shard and salt.  A filter is rebuilt with more buckets when it gets full, and
a fingerprint whose buckets are full all the same goes to a list beside them.

Counting combines on the map side and a line's documents are never gathered, however
many hold it.  What is gathered is the set of lines that one document loses.

Results: every row is returned, with its text less the dropped lines.  A null text is
empty and has one empty line.  Rows of one id are one document where lines are
counted; each row loses its own lines.  Rows with a null id hold no counted lines and
lose none.  An inserted document that the index already has changes nothing unless it
brings new lines; deleting unknown documents changes nothing.  Empty tables are
allowed everywhere.  Extra columns pass through; ``text``, ``n_lines`` and
``n_dropped`` replace columns of that name.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import materialize, text_of, unused

MIN_CHARS = 20
MIN_DOCS = 3
#: Shards of an index are at least this many, and so many that its first documents put no more keys into a filter.
SHARDS = 64
SHARD_KEYS = 1 << 20
SLOTS = 4
LOAD = 0.9
KICKS = 500
#: Bytes of all filters up to which every task gets them.
FILTER_BYTES = 32 << 20
SALTS = 32
SPACE = b" \t\n\x0b\x0c\r"

_REFERENCES = "key binary, doc_id long, live boolean"
_COUNTS = "key binary, n long, last long, was long"
_LOG = "g int, name string, min_chars int, min_docs int, shards int"
_FILTERS = "shard int, held long, slots binary, extra binary"


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The line's key, if it is long enough to count."""
    line = line.strip(SPACE).lower()
    if len(line) < min_chars or len(line) < 4 * min_chars and len(line.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(line)


class Cuckoo:
    """A cuckoo filter: 16-bit fingerprints, four to a bucket, either of two buckets each."""

    def __init__(self, buckets: int, slots: bytes | None = None, extra: bytes = b""):
        self.table = np.zeros((buckets, SLOTS), "<u2") if slots is None else np.frombuffer(slots, "<u2").reshape(-1, SLOTS).copy()
        self.mask = len(self.table) - 1
        self.extra = [tuple(x) for x in np.frombuffer(extra, "<u4").reshape(-1, 2).tolist()]

    @staticmethod
    def sized(keys: int) -> "Cuckoo":
        return Cuckoo(1 << max(2, int(np.ceil(np.log2(max(keys, 1) / (SLOTS * LOAD))))))

    @property
    def room(self) -> float:
        return self.table.size * LOAD

    def _spots(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of every key."""
        h = np.frombuffer(b"".join(keys), "<u4").reshape(-1, 4).astype("i8")
        prints = np.maximum(h[:, 1] & 0xFFFF, 1)
        first = h[:, 2] & self.mask
        return prints, first, first ^ self._step(prints)

    def _step(self, prints):
        """What leads from one bucket of a fingerprint (or of many) to the other."""
        return (prints * 0x5BD1E995 & 0xFFFFFFFF) >> 7 & self.mask

    def has(self, keys: list[bytes]) -> np.ndarray:
        if not keys:
            return np.zeros(0, bool)
        prints, a, b = self._spots(keys)
        found = ((self.table[a] == prints[:, None]) | (self.table[b] == prints[:, None])).any(axis=1)
        if self.extra:
            listed = set(self.extra)
            found |= np.array([(f, x) in listed or (f, y) in listed for f, x, y in zip(prints.tolist(), a.tolist(), b.tolist(), strict=True)])
        return found

    def add(self, keys: list[bytes]) -> None:
        if not keys:
            return
        for f, a, b in zip(*(x.tolist() for x in self._spots(keys)), strict=True):
            self._put(f, a, b)

    def _put(self, f: int, a: int, b: int) -> None:
        table = self.table
        for spot in (a, b):
            free = np.flatnonzero(table[spot] == 0)
            if len(free):
                table[spot, free[0]] = f
                return
        spot = a
        for kick in range(KICKS):
            at = kick % SLOTS
            f, table[spot, at] = int(table[spot, at]), f
            spot ^= self._step(f)
            free = np.flatnonzero(table[spot] == 0)
            if len(free):
                table[spot, free[0]] = f
                return
        self.extra.append((f, spot))

    def remove(self, keys: list[bytes]) -> None:
        """Take out keys that were added; a listed fingerprint counts for both of its buckets."""
        if not keys:
            return
        for f, a, b in zip(*(x.tolist() for x in self._spots(keys)), strict=True):
            for spot in (a, b):
                at = np.flatnonzero(self.table[spot] == f)
                if len(at):
                    self.table[spot, at[0]] = 0
                    break
            else:
                self.extra.remove((f, a) if (f, a) in self.extra else (f, b))

    def row(self) -> tuple[bytes, bytes]:
        return self.table.tobytes(), np.array(self.extra, "<u4").tobytes()


@dataclass(frozen=True)
class LineIndex:
    """State of an index after the generations named; changing it gives another."""

    spark: SparkSession
    path: str
    generations: tuple[str, ...] = ()
    min_chars: int = MIN_CHARS
    min_docs: int = MIN_DOCS
    shards: int = 0

    def read(self, name: str, schema: str) -> DataFrame:
        """All generations' rows of a table, with the generation's number ``g``."""
        parts = [self.spark.read.schema(schema).parquet(f"{self.path}/{g}/{name}").withColumn("g", F.lit(k))
                 for k, g in enumerate(self.generations)]
        return reduce(DataFrame.unionAll, parts) if parts else self.spark.createDataFrame([], f"{schema}, g int")

    def newest(self, name: str, schema: str, keys: list[str]) -> DataFrame:
        """The last generation's row of each key."""
        rows = self.read(name, schema)
        if len(self.generations) < 2:
            return rows.drop("g")
        rest = [c for c in rows.columns if c not in keys and c != "g"]
        last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "g").alias("r"))
        return last.select(*keys, *[F.col("r")[c].alias(c) for c in rest])

    def references(self) -> DataFrame:
        """``(key, doc_id)`` of the documents in the index."""
        return self.newest("references", _REFERENCES, ["key", "doc_id"]).filter("live").drop("live")

    def counts(self) -> DataFrame:
        """``(key, n, last)``: exact counts of documents and the largest."""
        return self.newest("counts", _COUNTS, ["key"]).drop("was")

    def filters(self) -> DataFrame:
        return self.newest("filters", _FILTERS, ["shard"])

    def shard(self) -> Column:
        return F.pmod(F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long"), F.lit(self.shards)).cast("int")


def open_index(spark: SparkSession, path: str) -> LineIndex:
    """An index written before, with all finished generations."""
    log = spark.read.schema(_LOG).parquet(f"{path}/log").orderBy("g").collect()
    return LineIndex(spark, path, tuple(r["name"] for r in log), *log[0][2:])


def lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``(key, doc_id)``: the distinct countable lines of every document."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = [], []
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = {line_key(x, min_chars) for x in t.encode().split(b"\n")} - {None}
                keys.extend(own)
                ids.extend([doc] * len(own))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], ["key", "doc_id"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text).alias("text")).filter("doc_id is not null")
    return rows.mapInArrow(cut, "key binary, doc_id long").distinct()


def insert(index: LineIndex, docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> LineIndex:
    """The index with these documents' lines."""
    new = lines(docs, id_col, text, index.min_chars)
    if index.generations:
        new = new.join(index.references(), ["key", "doc_id"], "left_anti")
    name = _generation(index)
    new = _write(index, name, "references", new.withColumn("live", F.lit(True)), _REFERENCES)
    delta = new.groupBy("key").agg(F.count("*").alias("more"), F.max("doc_id").alias("top"))
    old = index.counts()
    counts = delta.join(old, "key", "left") if index.generations else delta.select("*", F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("last"))
    was = F.coalesce("n", F.lit(0)).cast("long")
    counts = _write(index, name, "counts", counts.select("key", (was + F.col("more")).alias("n"), F.greatest("last", "top").alias("last"),
                                                         was.alias("was")), _COUNTS)
    return _finish(index, name, counts)


def delete(index: LineIndex, doc_ids: DataFrame, id_col: str = "doc_id") -> LineIndex:
    """The index without these documents, as if they had never been inserted."""
    ids = doc_ids.select(F.col(id_col).cast("long").alias("doc_id")).filter("doc_id is not null").distinct()
    live = index.references()
    name = _generation(index)
    gone = _write(index, name, "references", live.join(ids, "doc_id", "left_semi").select("key", "doc_id", F.lit(False).alias("live")), _REFERENCES)
    delta = gone.groupBy("key").agg(F.count("*").alias("less"), F.max("doc_id").alias("top"))
    touched = materialize(delta.join(index.counts(), "key"), "touched")
    moved = touched.filter("last = top and n > less").select("key")
    rest = live.join(moved, "key", "left_semi").join(gone.select("key", "doc_id"), ["key", "doc_id"], "left_anti")
    rest = rest.groupBy("key").agg(F.max("doc_id").alias("next"))
    counts = touched.join(rest, "key", "left").select("key", (F.col("n") - F.col("less")).alias("n"), F.coalesce("next", "last").alias("last"),
                                                      F.col("n").alias("was"))
    return _finish(index, name, _write(index, name, "counts", counts, _COUNTS))


def _generation(index: LineIndex) -> str:
    return f"g{len(index.generations):05d}-{uuid.uuid4().hex[:8]}"


def _write(index: LineIndex, generation: str, name: str, rows: DataFrame, schema: str) -> DataFrame:
    path = f"{index.path}/{generation}/{name}"
    rows.write.parquet(path)
    return index.spark.read.schema(schema).parquet(path)


def _finish(index: LineIndex, name: str, counts: DataFrame) -> LineIndex:
    """Bring the filters up to the counts just written, then log the generation."""
    enough = index.min_docs
    if not index.shards:
        repeated = counts.filter(F.col("n") >= enough).count()
        index = replace(index, shards=max(SHARDS, -(-repeated // SHARD_KEYS)))
    after = replace(index, generations=(*index.generations, name))
    keyed = counts.withColumn("shard", index.shard())
    enters, leaves = F.col("was") < enough, F.col("n") < enough
    changes = keyed.filter(enters != leaves).select("shard", "key", leaves.alias("leaves"))
    per = changes.groupBy("shard").agg(F.sum(F.when(F.col("leaves"), -1).otherwise(1)).alias("more"))
    old = index.filters()
    sizes = per.join(old.select("shard", "held", F.octet_length("slots").alias("bytes")), "shard", "left").withColumn(
        "full", F.coalesce(F.col("held"), F.lit(0)) + F.col("more") > F.coalesce(F.col("bytes"), F.lit(0)) / 2 * LOAD)
    full = [r["shard"] for r in sizes.filter("full and held is not null").select("shard").collect()]
    if full:
        again = after.counts().filter(F.col("n") >= enough).withColumn("shard", index.shard()).filter(F.col("shard").isin(full))
        changes = changes.filter(~F.col("shard").isin(full)).unionByName(again.select("shard", "key", F.lit(False).alias("leaves")))
        old = old.filter(~F.col("shard").isin(full))

    def update(key, filters: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
        if not len(changes):
            return pd.DataFrame({"shard": [], "held": [], "slots": [], "extra": []}).astype({"shard": "int32", "held": "int64"})
        held, leaves = 0, changes.leaves.astype(bool)
        enter, leave = changes.key[~leaves].tolist(), changes.key[leaves].tolist()
        if len(filters):
            held, f = int(filters.held[0]), Cuckoo(0, filters.slots[0], filters.extra[0])
        else:
            f = Cuckoo.sized(len(enter))
        f.remove(leave)
        f.add(enter)
        slots, extra = f.row()
        return pd.DataFrame({"shard": [int(key[0])], "held": [held + len(enter) - len(leave)], "slots": [slots], "extra": [extra]})

    _write(index, name, "filters", old.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(update, _FILTERS), _FILTERS)
    log = index.spark.createDataFrame([(len(index.generations), name, index.min_chars, enough, index.shards)], _LOG)
    log.coalesce(1).write.mode("append").parquet(f"{index.path}/log")
    return after


def dropped(index: LineIndex, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``(doc_id, key)``: the lines that documents of the index lose."""
    filters = index.filters()
    size = filters.agg(F.sum(F.octet_length("slots") + F.octet_length("extra"))).first()[0] or 0
    refs = index.references().withColumn("shard", index.shard())
    found = _probe_everywhere(refs, filters) if size <= filter_bytes else _probe_by_shard(refs, filters)
    counts = index.counts().filter(F.col("n") >= index.min_docs)
    return found.join(counts, "key").filter("doc_id < last").select("doc_id", "key")


def _probe_everywhere(refs: DataFrame, filters: DataFrame) -> DataFrame:
    """References that a filter holds; the filters' size is checked by the caller."""
    shipped = refs.sparkSession.sparkContext.broadcast({r["shard"]: (bytes(r["slots"]), bytes(r["extra"])) for r in filters.collect()})

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {s: Cuckoo(0, *row) for s, row in shipped.value.items()}
        for batch in batches:
            keys, shards = np.array(batch.column(0).to_pylist(), object), batch.column(2).to_numpy()
            hit = np.zeros(len(keys), bool)
            for s in np.unique(shards).tolist():
                if s in known:
                    at = np.flatnonzero(shards == s)
                    hit[at] = known[s].has(keys[at].tolist())
            yield batch.filter(pa.array(hit)).select(["key", "doc_id"])

    return refs.select("key", "doc_id", "shard").mapInArrow(probe, "key binary, doc_id long")


def _probe_by_shard(refs: DataFrame, filters: DataFrame) -> DataFrame:
    """The same without sending all filters to a task: rows and filters meet by shard and salt, in a sorted stream."""
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    rows = refs.select("shard", salt.alias("salt"), F.lit(1).alias("kind"), "key", "doc_id", F.lit(None).cast("binary").alias("extra"))
    tops = filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(0).alias("kind"),
                          F.col("slots").alias("key"), F.lit(None).cast("long").alias("doc_id"), "extra")
    together = rows.unionByName(tops).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, now = None, None
        for batch in batches:
            shards, kinds = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            keys = np.array(batch.column(3).to_pylist() + [None], object)[:-1]
            hit = np.zeros(len(keys), bool)
            cuts = np.flatnonzero((np.diff(shards, prepend=-1) != 0) | (kinds == 0)).tolist() + [len(keys)]
            starts = cuts if cuts[0] == 0 else [0, *cuts]
            for lo, hi in zip(starts, starts[1:], strict=False):
                if kinds[lo] == 0:
                    shard, now, lo = shards[lo], Cuckoo(0, keys[lo], batch.column(5)[lo].as_py()), lo + 1
                if now is not None and lo < hi and shards[lo] == shard:
                    hit[lo:hi] = now.has(keys[lo:hi].tolist())
            yield batch.filter(pa.array(hit)).select(["key", "doc_id"])

    return together.mapInArrow(probe, "key binary, doc_id long")


def drop_lines(docs: DataFrame, lost: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the lines ``lost (doc_id, key)``, with ``n_lines`` (before) and ``n_dropped``."""
    @F.pandas_udf("text string, n_lines long, n_dropped long")
    def rewrite(texts: pd.Series, keys: pd.Series) -> pd.DataFrame:
        out = []
        for t, gone in zip(texts, keys, strict=True):
            if gone is None or not len(gone):
                out.append((t, t.count("\n") + 1, 0))
                continue
            gone, own = set(gone), t.encode().split(b"\n")
            stay = [x for x in own if line_key(x, min_chars) not in gone]
            out.append((b"\n".join(stay).decode(), len(own), len(own) - len(stay)))
        return pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])

    own, keys, kept = (unused(c, docs.columns) for c in ("__lost_id", "__lost_keys", "__kept"))
    sets = lost.groupBy(F.col("doc_id").alias(own)).agg(F.collect_list("key").alias(keys))
    rows = docs.join(sets, F.col(id_col).cast("long") == F.col(own), "left").withColumn(kept, rewrite(text_of(text), F.col(keys)))
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (text, "n_lines", "n_dropped")]
    return rows.select(*rest, F.col(kept)["text"].alias(text), *[F.col(kept)[c].alias(c) for c in ("n_lines", "n_dropped")])


def digests(docs: DataFrame, path: str) -> DataFrame:
    """An index of all documents at ``path``, and what each loses by it."""
    docs = docs.select("doc_id", "text")
    index = insert(LineIndex(docs.sparkSession, path), docs)
    kept = drop_lines(docs, dropped(index))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""WITH l AS (SELECT row_id, doc_id, unnest(xs) AS x, unnest(range(1, len(xs) + 1)) AS pos FROM (
  SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS xs FROM documents)),
k AS (SELECT *, translate(trim(x, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 AND doc_id IS NOT NULL GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
d AS (SELECT k.*, c.key IS NOT NULL AND doc_id < last AS gone FROM k LEFT JOIN c ON c.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (coalesce(gone, false)) AS n_dropped,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY pos) FILTER (NOT coalesce(gone, false)), '')) AS kept_sha256
FROM d GROUP BY row_id, doc_id"""
