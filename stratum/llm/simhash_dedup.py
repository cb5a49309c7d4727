"""SimHash near-duplicates by the Pigeonring filter.

Fingerprints are 64-bit: each word shingle's XXH64 votes on every bit, and a
bit is set if more than half of the shingles set it.  Texts whose fingerprints
differ in at most ``MAX_BITS`` bits are linked, and links join components.

The Pigeonring principle: cut the 64 bits into ``SEGMENTS`` segments in a ring.
If two fingerprints differ in at most t bits in all, there is a start from which
every run of k consecutive segments differs in at most ``k * t / SEGMENTS`` bits.
With 4 segments and t = 3 the budgets are 0, 1, 2 and 3 bits: the first segment
must be equal and the second may differ in one bit.  Both go into the join key
(the probing side also tries the second segment with each one bit flipped), the
longer chains are checked before the full distance.  So a key covers 32 bits: of
N unlike fingerprints about 68 N^2 / 2^32 pairs meet by chance.  That is fewer than
N up to 6 * 10^7 fingerprints and 16 a fingerprint at 10^9; there is no cap on them.

Copies cost nothing: the search runs over distinct fingerprints, and each
document joins its fingerprint's component afterwards.

Results: null and empty texts have fingerprint zero and are linked like others.
Repeated rows are rows like others; null ids never name a component (it is null
if all its ids are).  An empty table gives an empty table.  Only the id and text
columns are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import connected_components, materialize, text_of, unused

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SEGMENTS = 4
WIDTH = 64 // SEGMENTS
#: Shingles whose bits are counted at a time, so that a long text takes bounded memory.
BLOCK = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The text's fingerprint as a signed 64-bit integer."""
    words = text.encode("utf-8").lower().split()  # bytes: A-Z only, and exactly \x20 \x09-\x0D
    if not words:
        return 0
    shingles = [b" ".join(w) for w in zip(*(words[k:] for k in range(shingle)), strict=False)] or [b" ".join(words)]
    votes = np.zeros(64, np.int64)
    for k in range(0, len(shingles), BLOCK):
        h = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles[k:k + BLOCK]], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(shingles), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row ``(id_col, fp)`` per row of ``docs``."""

    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.select(F.col(id_col).alias(id_col), text_of(text).alias("__t")).select(id_col, fp("__t").alias("fp"))


def _segment(col: str, k: int):
    return F.shiftrightunsigned(F.col(col), WIDTH * (k % SEGMENTS)).bitwiseAND((1 << WIDTH) - 1)


def _mask(k: int) -> int:
    """The bits of three segments of the ring from segment k, as a signed 64-bit integer."""
    bits = sum(((1 << WIDTH) - 1) << WIDTH * (j % SEGMENTS) for j in range(k, k + 3))
    return bits - (1 << 64) if bits >> 63 else bits


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of the distinct values of ``fps.fp`` within ``max_bits``."""
    if not 0 <= max_bits < SEGMENTS:
        raise ValueError("the segment budgets are laid out for at most 3 differing bits")
    distinct = fps.select("fp").distinct()
    key = lambda k, second: (F.lit(k << (2 * WIDTH)).bitwiseOR(F.shiftleft(_segment("fp", k), WIDTH))
                             .bitwiseOR(second))
    stored = distinct.select(F.col("fp").alias("b"), F.explode(F.array(
        *[key(k, _segment("fp", k + 1)) for k in range(SEGMENTS)])).alias("key"))
    near = F.array(F.lit(0), *[F.lit(1 << j) for j in range(WIDTH)]).cast("array<bigint>")
    probes = distinct.select(F.col("fp").alias("a"), F.explode(F.array(
        *[key(k, _segment("fp", k + 1)) for k in range(SEGMENTS)])).alias("base"))
    probes = probes.withColumn("flip", F.explode(near)).select("a", F.col("base").bitwiseXOR(F.col("flip")).alias("key"))
    # (estimates miss that flips multiply rows, so a broadcast is ruled out)
    pairs = probes.join(stored.hint("merge"), "key").filter("a < b")
    pairs = pairs.select("a", "b", F.shiftright("key", 2 * WIDTH).alias("k"), F.col("a").bitwiseXOR(F.col("b")).alias("x"))
    # the chain of three segments from start k may use 3 * max_bits / SEGMENTS bits
    chains = F.array(*[F.lit(_mask(k)) for k in range(SEGMENTS)])
    chain = F.bit_count(F.col("x").bitwiseAND(F.get(chains, F.col("k").cast("int")))) <= 3 * max_bits // SEGMENTS
    return pairs.filter(chain).filter(F.bit_count("x") <= max_bits).select("a", "b").distinct()


def components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
               max_bits: int = MAX_BITS) -> DataFrame:
    """``(id_col, fp, component)`` per row; component: the smallest id reachable by links."""
    fps = materialize(fingerprints(docs, id_col, text, shingle), "simhash")
    groups = materialize(fps.groupBy("fp").agg(F.min(id_col).alias("low")), "simhash-groups")
    linked = connected_components(links(groups, max_bits))
    labels = groups.join(linked, groups.fp == linked.node, "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("label"))
    lows = labels.groupBy("label").agg(F.min("low").alias("component"))
    named = labels.join(lows, "label").select("fp", "component")
    return fps.join(named, "fp").select(id_col, "fp", "component")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component: that of the smallest id.

    Rows with one id are one document, of which one row stays; rows without an
    id are kept.
    """
    found = materialize(components(docs, id_col, text), "simhash-components").filter(F.col(id_col).isNotNull())
    name = unused("__gone", docs.columns)
    gone = found.filter(F.col("component") != F.col(id_col)).select(F.col(id_col).alias(name)).distinct()
    kept = docs.join(gone, docs[id_col] == gone[name], "left_anti")
    if found.groupBy(id_col).count().filter("count > 1").limit(1).count():
        kept = kept.filter(F.col(id_col).isNull()).unionByName(
            kept.filter(F.col(id_col).isNotNull()).dropDuplicates([id_col]))
    return kept


def digests(docs: DataFrame) -> DataFrame:
    found = components(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))
