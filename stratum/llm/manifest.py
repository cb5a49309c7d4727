"""Merkle manifest of a table: subtrees by group, placed by rank queries on bitmaps.

A leaf is the SHA-256 of a row's fields.  Where it stands in its group follows from a
compressed bitmap of the group's ids, not from sorting the rows.  Ids are cut into
words of 64 and blocks of 64 words; partial bitmaps are merged by ``bit_or``.  A block
keeps the mask of its words that are not empty, those words, and a popcount directory:
the rows before each word, and before the block in its group.  The rank of an id is
the block's count, plus the word's, plus the set bits below its own.  The blocks'
counts come from a running sum over range partitions of blocks, whose totals are
summed in their turn, so no group has to fit one task however hot it is.

Nodes are reduced by keyed slot arrays: position ``p`` goes to slot ``p mod 256`` of
array ``p div 256`` of its group, and an array settles two levels of sixteen children
at once.  The next pass has 256 times fewer nodes.  Proofs run back down: an array's
siblings above it are joined to it once, and its slots are unfolded in place, so that
no path is ever shuffled.  Subroots are reduced by the same passes over the ranks of
the groups.  Everything is JVM expressions; what reaches the driver is one row (the
greatest group's size; the root).

Results: one row per input row, repeated rows included.  Null ids and null groups come
first.  Rows of one group and id follow each other in the order of their leaves; they are
counted in the words beside the bitmaps, identical ones taken together before they are
placed.  An empty table gives no rows.  Only the five named fields are read; extra
columns, whatever their names, are neither part of a leaf nor returned.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 16
SLOTS = FAN * FAN
#: Block of null ids: before that of the least long.
NULL_BLOCK = -(1 << 51) - 1
#: Identical rows laid out by one generated row.
COPIES = 1 << 16


@dataclass
class Manifest:
    """``index``: bitmap blocks; ``passes``: slot arrays of the groups' trees; ``top``: of the tree of subroots."""

    index: DataFrame
    passes: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame
    root: str


def encoded(value: Column) -> Column:
    """A field as text that can't be confused with its neighbours."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded, fields)), 256)


def running(df: DataFrame, group: list[str], order: list[str], value: str, name: str = "before") -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before it in its group.

    (group, order) must be unique and not null.  Range partitions are summed apart; a group's partitions are
    then summed in order, one row each.
    """
    ranged = materialize(df.repartitionByRange(*group, *order).withColumn("part", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy(*group, "part").agg(F.sum(value).alias("t"))
    sums = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*group, "part", F.coalesce(F.sum("t").over(sums), F.lit(0)).alias("parts_before"))
    within = Window.partitionBy("part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumn("rows_before", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return rows.join(totals, [*group, "part"]).withColumn(name, F.col("parts_before") + F.col("rows_before")).drop(
        "part", "parts_before", "rows_before")


def _coordinates(id_col: str = "id") -> list[Column]:
    return [F.expr(f"coalesce({id_col} >> 12, {NULL_BLOCK}L)").alias("block"), F.expr(f"cast(coalesce({id_col} >> 6 & 63, 0) as int)").alias("word"),
            F.expr(f"cast(coalesce({id_col} & 63, 0) as int)").alias("bit")]


def bitmap_index(ids: DataFrame) -> DataFrame:
    """Bitmap blocks of ``ids (key, id)``: ``(key, block, mask, words, counts, copies, n, before, total)``.

    ``words`` are the words that ``mask`` names, ``counts`` the rows before each in the block, ``copies`` the
    bits whose id comes more than once, with the further rows; ``before`` counts the key's rows before the
    block and ``total`` all its rows.
    """
    once = ids.groupBy("key", "id").agg(F.count("*").alias("n"))
    more = F.when(F.col("n") > 1, F.struct("bit", (F.col("n") - 1).alias("more")))
    words = once.select("key", *_coordinates(), "n").groupBy("key", "block", "word").agg(
        F.expr("bit_or(shiftleft(1L, bit))").alias("bits"), F.sum("n").alias("n"), F.collect_list(more).alias("copies"))
    blocks = words.groupBy("key", "block").agg(F.sort_array(F.collect_list(F.struct("word", "bits", "n", "copies"))).alias("w"),
                                               F.sum("n").alias("n"))
    blocks = blocks.selectExpr(
        "key", "block", "aggregate(w, 0L, (m, x) -> m | shiftleft(1L, x.word)) AS mask", "transform(w, x -> x.bits) AS words",
        "transform(w, (x, i) -> aggregate(slice(w, 1, i), 0L, (s, y) -> s + y.n)) AS counts", "transform(w, x -> x.copies) AS copies", "n")
    blocks = materialize(running(blocks, ["key"], ["block"], "n"), "bitmaps")
    return blocks.join(blocks.groupBy("key").agg(F.sum("n").alias("total")), "key")


def rank(ids: DataFrame, index: DataFrame) -> DataFrame:
    """``ids (key, id, ...)`` that the index holds, with ``pos`` (rows of the key before the id), ``times``, ``total``."""
    names = [c for c in ids.columns if c not in ("key", "id")]
    near = ids.select("*", *_coordinates()).join(index, ["key", "block"]).selectExpr(
        "key", "id", *names, "bit", "total", "before", "bit_count(mask & ~shiftleft(-1L, word)) AS k", "shiftright(mask, word) & 1 = 1 AS held",
        "words", "counts", "copies").filter("held")
    near = near.selectExpr("key", "id", *names, "total", "bit", "before + counts[k] AS before", "words[k] AS bits", "copies[k] AS copies")
    return near.filter("shiftright(bits, bit) & 1 = 1").selectExpr(
        "key", "id", *names, "total",
        "before + bit_count(bits & ~shiftleft(-1L, bit)) + aggregate(copies, 0L, (s, c) -> s + if(c.bit < bit, c.more, 0L)) AS pos",
        "aggregate(copies, 1L, (s, c) -> s + if(c.bit = bit, c.more, 0L)) AS times")


def _placed(leaves: DataFrame, index: DataFrame) -> DataFrame:
    """Leaves with their positions; the rows of a repeated id are laid out in the order of their leaves."""
    near = materialize(rank(leaves, index), "ranks")
    alone = near.filter("times = 1").drop("times")
    same = near.filter("times > 1").groupBy("key", "id", "leaf", "claim", "total", "pos").agg(F.count("*").alias("n"))
    same = same.withColumn("id_text", F.coalesce(F.col("id").cast("string"), F.lit("-")))
    same = running(same, ["key", "id_text"], ["leaf", "claim"], "n")
    same = same.withColumn("lot", F.explode(F.expr(f"sequence(0L, (n - 1) div {COPIES})")))
    copy = F.explode(F.expr(f"sequence(lot * {COPIES}, least(n, (lot + 1) * {COPIES}) - 1)"))
    same = same.withColumn("copy", copy).withColumn("pos", F.expr("pos + before + copy"))
    return alone.unionByName(same.select(alone.columns))


_RUNS = f"transform(sequence(0, (size(slots) - 1) div {FAN}), i -> sha2(array_join(transform(slice(slots, i * {FAN} + 1, {FAN}), s -> s.digest), ''), 256))"
_NODE = f"CASE WHEN total = 1 THEN slots[0].digest WHEN total <= {FAN} THEN runs[0] ELSE sha2(array_join(runs, ''), 256) END"


def reduce_nodes(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Slot arrays of every pass over ``nodes (key, pos, total, digest, row)``, the leaves' first."""
    passes = []
    most = nodes.agg(F.max("total")).first()[0]
    while most:
        slot = F.struct((F.col("pos") % SLOTS).alias("slot"), "digest", "row")
        arrays = nodes.groupBy("key", F.expr(f"pos div {SLOTS}").alias("place"), "total").agg(F.array_sort(F.collect_list(slot)).alias("slots"))
        arrays = arrays.withColumn("runs", F.expr(_RUNS)).withColumn("node", F.expr(_NODE))
        passes.append(materialize(arrays, name))
        nodes = passes[-1].filter(f"total > {SLOTS}").select(
            "key", F.col("place").alias("pos"), F.expr(f"(total + {SLOTS - 1}) div {SLOTS}").alias("total"), F.col("node").alias("digest"),
            F.lit(None).cast("boolean").alias("row"))
        most = (most + SLOTS - 1) // SLOTS if most > SLOTS else 0
    return passes


def roots(passes: list[DataFrame]) -> DataFrame:
    """``(key, node)``: the last node of every key's tree."""
    ended = [p.filter(f"total <= {SLOTS}").select("key", "node") for p in passes]
    return ended[0] if len(ended) == 1 else ended[0].unionByName(roots(passes[1:]))


#: Siblings left and right of a slot, by level, in an array.
_PATH = f"""slice(array(
  named_struct('l', array_join(transform(slice(slots, run * {FAN} + 1, slot - run * {FAN}), s -> s.digest), ''),
               'r', array_join(transform(slice(slots, slot + 2, (run + 1) * {FAN} - slot - 1), s -> s.digest), '')),
  named_struct('l', array_join(slice(runs, 1, run), ''), 'r', array_join(slice(runs, run + 2, {FAN}), ''))),
  1, CASE WHEN total = 1 THEN 0 WHEN total <= {FAN} THEN 1 ELSE 2 END)"""


def unfold(passes: list[DataFrame], above: DataFrame | None = None) -> DataFrame:
    """``(key, pos, digest, row, path, ...)`` of every leaf: its siblings by level, up through ``above (key, path, ...)``."""
    more = [c for c in above.columns if c not in ("key", "path")] if above is not None else []
    down = None
    for arrays in reversed(passes):
        met = arrays.filter(f"total <= {SLOTS}")
        met = met.withColumn("path", F.expr("cast(array() AS array<struct<l: string, r: string>>)")) if above is None else met.join(above, "key")
        if down is not None:
            met = met.unionByName(arrays.filter(f"total > {SLOTS}").join(down.select("key", F.col("pos").alias("place"), "path", *more), ["key", "place"]))
        each = met.select("*", F.explode("slots").alias("s")).selectExpr(
            "key", "place", "total", "slots", "runs", "path", *more, "cast(s.slot AS int) AS slot", f"cast(s.slot div {FAN} AS int) AS run", "s.digest AS digest",
            "s.row AS row")
        down = each.selectExpr("key", f"place * {SLOTS} + slot AS pos", "digest", "row", f"concat({_PATH}, path) AS path", *more)
    return down


def build(rows: DataFrame, id_col: str, group: str, leaf: str, claim: str) -> Manifest | None:
    """Manifest of ``rows``: ``leaf`` is the digest to enter, ``claim`` another that travels with it for checking."""
    leaves = rows.select(encoded(F.col(group)).alias("key"), F.col(group).alias("group"), F.col(id_col).cast("long").alias("id"),
                         F.col(leaf).alias("leaf"), F.col(claim).alias("claim"))
    leaves = materialize(leaves, "leaves")
    index = bitmap_index(leaves.select("key", "id"))
    placed = _placed(leaves.drop("group"), index)
    passes = reduce_nodes(placed.select("key", "pos", "total", F.col("leaf").alias("digest"), F.struct("id", "claim").alias("row")), "arrays")
    if not passes:
        return None
    named = leaves.groupBy("key").agg(F.max("group").alias("group")).join(roots(passes), "key")
    named = named.select(F.lit("").alias("all"), F.expr("cast(`group` IS NOT NULL AS int)").alias("named"), F.coalesce("group", F.lit("")).alias("group"),
                         "key", "node", F.lit(1).cast("long").alias("n"))
    ranked = running(named, ["all"], ["named", "group"], "n")
    subroots = materialize(ranked.select("key", "node", F.col("before").alias("pos")), "subroots")
    total = subroots.count()
    top = reduce_nodes(subroots.select(F.lit("").alias("key"), "pos", F.lit(total).cast("long").alias("total"), F.col("node").alias("digest"),
                                       F.struct("key").alias("row")), "top")
    return Manifest(index, passes, top, subroots, roots(top).first()["node"])


def proofs(manifest: Manifest) -> DataFrame:
    """``(id, leaf, claim, subroot, path)`` of every row; ``path`` holds the siblings' digests, left and right, by level."""
    above = unfold(manifest.top).select(F.col("row.key").alias("key"), F.col("digest").alias("subroot"), "path")
    above = materialize(above, "above")
    return unfold(manifest.passes, above).select("row.id", F.col("digest").alias("leaf"), "row.claim", "subroot", "path")


def folded(claim: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings give."""
    return F.aggregate(path, claim, lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))


def digests(docs: DataFrame) -> DataFrame:
    """Manifest of the documents with a proof per row, and its check against texts of which one in five is altered."""
    fields = [F.col(c) for c in FIELDS]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    altered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    leaf = leaf_digest(fields)
    rows = docs.select("doc_id", "source", leaf.alias("leaf"), F.when(altered, leaf_digest([*fields[:-1], lowered])).otherwise(leaf).alias("claim"))
    manifest = build(rows, "doc_id", "source", "leaf", "claim")
    if manifest is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                                                     "folded_root string, verified boolean")
    out = proofs(manifest).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", F.lit(manifest.root).alias("root"),
        F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), ""), 256).alias("proof_sha256"),
        folded(F.col("claim"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
