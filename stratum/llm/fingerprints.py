"""SimHash document fingerprints, their likeness, and search within a Hamming radius.

Only DataFrame functions are used.  A text's terms are its pairs of neighbouring
lower-case words (and the last word alone); a term's weight is its length, at
most ``MAX_WEIGHT``.  Two 64-bit hashes of each occurrence vote with that weight
on 128 bits, and a bit is set if the votes for it are over half.

Votes are counted four bits to a long: bit j of each 16-bit lane is shifted down
and summed, for runs of ``RUN`` terms (so no lane can overflow), and the lanes of
a text's runs are then added up.  All of it is one partial aggregation in the
task that holds the text; no group is larger than a document.

Search: the bits are cut into ``blocks``; fingerprints within ``radius`` agree on
some ``blocks - radius`` of them, so there is a table for each such choice, keyed
by those blocks.  Candidates are checked by their full distance.  Each distinct
fingerprint is stored once, so copies don't multiply candidates.

Results: null is read as the empty text.  A repeated row (same id and text) is
one document.  Null ids come last in the order of the documents.  In a table of
one document, its next document is itself.  An empty table gives an empty table.
Only the id and text columns are read, so other columns can't clash.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import materialize, text_of

MAX_WEIGHT = 15
RUN = 2048  # RUN * MAX_WEIGHT < 2 ** 15: the sum of the top lane keeps its sign
LANES = 0x0001000100010001
BITS = 128
RADIUS = 3
BLOCKS = 5


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row ``(*keys, fp_hi, fp_lo)`` per row of ``df``; ``keys`` must be unique.

    If ``df`` is partitioned by some of its keys already, nothing is shuffled.
    """
    words = df.select(*keys, F.split(F.lower(F.trim(F.col(text))), r"\s+").alias("__w"))
    terms = words.select(*keys, F.posexplode(F.arrays_zip(
        F.col("__w").alias("w"), F.expr("slice(__w, 2, size(__w))").alias("x"))).alias("__pos", "__t"))
    terms = terms.select(
        *keys, F.expr(f"__pos div {RUN}").alias("__run"),
        F.xxhash64("__t.w", "__t.x").alias("h0"), F.xxhash64(F.lit(1), "__t.w", "__t.x").alias("h1"),
        F.least(F.lit(MAX_WEIGHT), F.greatest(F.lit(1), F.length("__t.w") + F.coalesce(F.length("__t.x"), F.lit(0))))
        .cast("long").alias("v"))
    lanes = [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(LANES) * F.col("v")).alias(f"{h}_{j}")
             for h in ("h0", "h1") for j in range(16)]
    runs = terms.groupBy(*keys, "__run").agg(*lanes, F.sum("v").alias("v"))
    bit = lambda h, b: F.shiftrightunsigned(f"{h}_{b % 16}", b // 16 * 16).bitwiseAND(0xFFFF)
    votes = runs.groupBy(*keys).agg(F.sum("v").alias("v"), *[
        F.sum(bit(h, b)).alias(f"{h}b{b}") for h in ("h0", "h1") for b in range(64)])

    def half(h):
        out = F.lit(0).cast("long")
        for b in range(64):
            out = out.bitwiseOR(F.when(2 * F.col(f"{h}b{b}") > F.col("v"), F.lit(_signed(1 << b)))
                                .otherwise(F.lit(0).cast("long")))
        return out

    return votes.select(*keys, half("h0").alias("fp_hi"), half("h1").alias("fp_lo"))


def distance(hi_a, lo_a, hi_b, lo_b):
    """Differing bits of two fingerprints, each given as two columns."""
    return F.bit_count(hi_a.bitwiseXOR(hi_b)) + F.bit_count(lo_a.bitwiseXOR(lo_b))


def likeness(bits):
    """The cosine that so many differing bits stand for, from 0 to 1."""
    return F.greatest(F.lit(0.0), F.cos(bits * F.lit(3.141592653589793 / BITS)))


def hex_of(hi, lo):
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def within(queries: DataFrame, stored: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Pairs of a distinct query and a distinct stored fingerprint within ``radius``.

    Both sides have ``fp_hi, fp_lo``; the result has ``q_hi, q_lo, fp_hi, fp_lo, bits``.
    Takes any radius below ``blocks``; more blocks mean longer keys and more tables.
    """
    if not 0 <= radius < blocks:
        raise ValueError("need more blocks than differing bits")
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    masks = [sum(((1 << edges[k + 1] - edges[k]) - 1) << edges[k] for k in chosen)
             for chosen in combinations(range(blocks), blocks - radius)]
    tables = lambda: F.explode(F.array(*[F.struct(
        F.lit(n).alias("n"), F.lit(_signed(m >> 64)).bitwiseAND(F.col("fp_hi")).alias("hi"),
        F.lit(_signed(m & (1 << 64) - 1)).bitwiseAND(F.col("fp_lo")).alias("lo")) for n, m in enumerate(masks)])).alias("t")
    split = lambda df: df.select("fp_hi", "fp_lo").distinct().select("fp_hi", "fp_lo", tables()).select(
        "fp_hi", "fp_lo", "t.n", "t.hi", "t.lo")
    probes = split(queries).withColumnsRenamed({"fp_hi": "q_hi", "fp_lo": "q_lo"})
    # (estimates miss that the tables multiply rows, so a broadcast is ruled out)
    found = probes.join(split(stored).hint("merge"), ["n", "hi", "lo"])
    found = found.withColumn("bits", distance(F.col("q_hi"), F.col("q_lo"), F.col("fp_hi"), F.col("fp_lo")))
    return found.filter(F.col("bits") <= radius).select("q_hi", "q_lo", "fp_hi", "fp_lo", "bits").distinct()


def following(keys: DataFrame, order: list[str]) -> DataFrame:
    """Add ``next``: the struct of ``order`` of the row that comes next when all are
    sorted descending by ``order`` (after the last: the first).

    Rows are range-partitioned and each partition finds its own successors; only
    the first row of each partition goes to the driver.
    """
    row = F.struct(*[F.col(c) for c in order])
    ranged = keys.repartitionByRange(*[F.desc(c) for c in order]).withColumn("__p", F.spark_partition_id())
    ranged = materialize(ranged, "order")
    firsts = sorted((r["__p"], r["first"]) for r in ranged.groupBy("__p").agg(F.max(row).alias("first")).collect())
    wrap = [(p, firsts[(k + 1) % len(firsts)][1]) for k, (p, _) in enumerate(firsts)]
    kind = ranged.select(F.col("__p"), row.alias("first")).schema
    heads = keys.sparkSession.createDataFrame(wrap, kind)
    own = Window.partitionBy("__p").orderBy(*[F.desc(c) for c in order])
    found = ranged.withColumn("next", F.lead(row).over(own)).join(F.broadcast(heads), "__p", "left")
    return found.select(*keys.columns, F.coalesce("next", "first").alias("next"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """Fingerprints of the documents and of their edited texts, with likenesses.

    An edited text has its last half replaced by the start of the next document.
    ``n_near`` counts, for ids divisible by 50, the other documents within ``radius``.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col(id_col), F.lit(_signed(1 << 63))).cast("long").alias("dk"),
                       text_of(text).alias("text")).withColumn("th", F.xxhash64("text"))
    keys = materialize(docs.groupBy("dk", "th").agg(F.max(F.char_length("text")).cast("long").alias("n"),
                                                    F.count("*").alias("rows")), "keys")
    if keys.filter("rows > 1").limit(1).count():
        docs = docs.dropDuplicates(["dk", "th"])
    order = materialize(following(keys.select("dk", "th", "n"), ["dk", "th"]).select(
        "dk", "th", "n", F.col("next.dk").alias("next_dk"), F.col("next.th").alias("next_th")), "following")
    # the documents are shuffled once for both joins; only the heads are shuffled again
    held = docs.join(order.select("dk", "th", "n").hint("merge"), ["dk", "th"])
    takes = order.select(F.col("dk").alias("to_dk"), F.col("th").alias("to_th"), F.expr("n div 2").cast("int").alias("k"),
                         F.col("next_dk").alias("dk"), F.col("next_th").alias("th"))
    heads = docs.join(takes.hint("merge"), ["dk", "th"]).select(
        F.col("to_dk").alias("dk"), F.col("to_th").alias("th"), F.expr("left(text, k)").alias("head"))
    both = held.join(heads.hint("merge"), ["dk", "th"]).withColumn(
        "edited", F.concat(F.expr("left(text, cast(n - n div 2 as int))"), F.col("head")))
    both = both.withColumn("sha", F.sha2(F.encode("edited", "UTF-8"), 256))
    forms = both.select("dk", "th", "n", "sha", F.explode(F.array(
        F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("t")),
        F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("t")))).alias("f"))
    forms = forms.select("dk", "th", "n", "sha", "f.is_edited", "f.t")
    fps = fingerprints(forms, ["dk", "th", "n", "sha", "is_edited"], "t")
    one = lambda c, edited: F.max(F.when(F.col("is_edited") == edited, F.col(c)))
    fps = materialize(fps.groupBy("dk", "th", "n", "sha").agg(
        one("fp_hi", False).alias("fp_hi"), one("fp_lo", False).alias("fp_lo"),
        one("fp_hi", True).alias("e_hi"), one("fp_lo", True).alias("e_lo")), "fingerprints")
    nexts = order.select("dk", "th", "next_dk", "next_th").join(
        fps.select(F.col("dk").alias("next_dk"), F.col("th").alias("next_th"), F.col("fp_hi").alias("n_hi"),
                   F.col("fp_lo").alias("n_lo")), ["next_dk", "next_th"])
    counts = materialize(fps.groupBy("fp_hi", "fp_lo").agg(F.count("*").alias("c")), "fingerprint-counts")
    near = within(fps.filter("dk % 50 = 0"), counts, radius).join(counts, ["fp_hi", "fp_lo"]).groupBy("q_hi", "q_lo").agg(
        (F.sum("c") - 1).alias("near"))
    near = near.withColumnsRenamed({"q_hi": "fp_hi", "q_lo": "fp_lo"})
    out = fps.join(nexts, ["dk", "th"]).join(near, ["fp_hi", "fp_lo"], "left")
    col = F.col
    return out.select(
        F.nullif(col("dk"), F.lit(_signed(1 << 63))).alias(id_col), col("n").alias("n_chars"),
        col("sha").alias("edited_sha256"), hex_of(col("fp_hi"), col("fp_lo")).alias("fingerprint"),
        hex_of(col("e_hi"), col("e_lo")).alias("edited_fingerprint"),
        likeness(distance(col("fp_hi"), col("fp_lo"), col("e_hi"), col("e_lo"))).alias("near_edited"),
        likeness(distance(col("fp_hi"), col("fp_lo"), col("n_hi"), col("n_lo"))).alias("near_next"),
        F.when(col("dk") % 50 == 0, col("near")).alias("n_near"))
