"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power of an exponent from 0
(all alike) to 1 (as they are), normalised.  The exponent is bisected to the
flattest mix that repeats no source more than ``max_repeats`` times, or to a given
entropy of the weights (nats).

The mix is realised in blocks.  Each document belongs to one of ``BLOCKS`` blocks
of its source by a hash; each epoch of a source is a permutation of its blocks,
and of the documents in a block, by hashes of the epoch.  A source takes whole
epochs, then whole blocks of the next, then documents of one last block, until its
share of the budget is met (it may miss by less than one document and the rows that
repeat it, which are taken together).  Which
documents that takes follows from three numbers per source, so the documents
themselves are never shuffled: one aggregation sums the blocks, one window orders
the ``BLOCKS`` sums of each source, one more the documents of its last block.

The number of sources is taken to be moderate: a row per source goes to the driver.

Results: a null source is a source of its own.  Null and empty texts have no
tokens and follow their block; if no row has a token, each is read once.  Repeated rows are taken together.  Null ids are
hashed like others.  An empty table gives an empty table; extra columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import materialize, text_of

BLOCKS = 4096
SEED = 20
MAX_REPEATS = 2.0


def temperature_weights(shares: dict, exponent: float) -> dict:
    powered = {s: p ** exponent for s, p in shares.items()}
    total = sum(powered.values())
    return {s: p / total for s, p in powered.items()}


def _bisect(fits: Callable[[float], bool]) -> float:
    """The least exponent from 0 to 1 that fits, where all greater ones fit too."""
    if fits(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if fits(mid) else (mid, high)
    return high


def repeats(shares: dict, weights: dict, budget: float | None) -> dict:
    """How often each source is read; ``budget`` is in multiples of all tokens.

    Without a budget, the least one that reads every source at least once.
    """
    ratio = {s: weights[s] / shares[s] for s in shares}
    return {s: r * (budget if budget is not None else 1 / min(ratio.values())) for s, r in ratio.items()}


def solve(shares: dict, max_repeats: float | None = None, entropy: float | None = None,
          budget: float | None = 1.0) -> tuple[float, dict, dict]:
    """Exponent, weights and repeats of the flattest mix within the limit."""
    def fits(x: float) -> bool:
        w = temperature_weights(shares, x)
        if entropy is not None:
            return -sum(p * math.log(p) for p in w.values()) <= entropy
        return max(repeats(shares, w, budget).values()) <= max_repeats

    exponent = _bisect(fits)
    weights = temperature_weights(shares, exponent)
    return exponent, weights, repeats(shares, weights, budget)


def mix(docs: DataFrame, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None,
        budget: float | None = 1.0, source: str = "source", id_col: str = "doc_id", text: str = "text",
        seed: int = SEED, added: bool = True) -> DataFrame:
    """The mixed rows: those of ``docs`` once per epoch in which they are taken.

    Adds ``mix_tokens, mix_epoch, mix_block, mix_at`` unless ``added`` is false, when any column names are allowed; sorted by ``mix_at`` (0 to 1),
    the sources alternate in proportion to their weights.
    """
    if (max_repeats is None) == (entropy is None):
        raise ValueError("give max_repeats or entropy")
    spark = docs.sparkSession
    names, new = docs.columns, ["mix_tokens", "mix_epoch", "mix_block", "mix_at"]
    if clash := [c for c in names if added and c in new]:
        raise ValueError(f"rename the columns {clash} first")
    # the caller's columns have names of their own meanwhile
    own = [f"c{k}" for k in range(len(names))]
    source, id_col, text = (own[names.index(c)] for c in (source, id_col, text))
    docs = docs.toDF(*own)
    result = [F.col(c).alias(name) for c, name in zip(own, names, strict=True)]
    word = F.size(F.split(F.trim(text_of(text)), r"\s+"))
    tokens = F.when(F.length(F.trim(text_of(text))) > 0, word).otherwise(0).cast("long")
    key = F.xxhash64(F.col(id_col), F.xxhash64(text_of(text)), F.lit(seed))
    held = docs.withColumns({"mix_tokens": tokens, "mix_key": key}).withColumn(
        "mix_block", F.pmod("mix_key", F.lit(BLOCKS)).cast("int"))
    sums = materialize(held.groupBy(F.col(source).alias("s"), "mix_block").agg(F.sum("mix_tokens").alias("t")), "blocks")
    totals = {r["s"]: r["t"] for r in sums.groupBy("s").agg(F.sum("t").alias("t")).collect()}
    whole = sum(totals.values())
    if not whole:  # no row has a token: each is read once
        at = F.xxhash64("mix_block", F.lit(seed), F.lit(0)) / F.lit(2.0 ** 64) + F.lit(0.5)
        return held.select(*result, *(["mix_tokens", F.lit(0).alias("mix_epoch"), "mix_block", at.alias("mix_at")] if added else []))
    shares = {s: t / whole for s, t in totals.items() if t}
    _, _, times = solve(shares, max_repeats, entropy, budget)
    times = {s: times.get(s, 1.0) for s in totals}  # sources without a token are read once
    epochs = {s: int(r + 1e-9) for s, r in times.items()}
    rest = {s: max(0.0, (times[s] - epochs[s]) * totals[s]) for s in totals}

    plan = spark.createDataFrame([(s, epochs[s], float(rest[s]), times[s]) for s in totals],
                                 f"s {dict(docs.dtypes)[source]}, epochs int, rest double, times double")
    place = lambda epoch: F.xxhash64("mix_block", F.lit(seed), epoch)
    turn = lambda epoch: F.xxhash64("mix_key", epoch)
    # the block in which the budget of the last, partial epoch runs out
    order = Window.partitionBy("s").orderBy("o", "mix_block")
    ranked = sums.join(F.broadcast(plan), sums.s.eqNullSafe(plan.s)).select(sums.s, "mix_block", "t", "epochs", "rest")
    ranked = ranked.withColumn("o", place(F.col("epochs"))).withColumn("upto", F.sum("t").over(order))
    last = ranked.filter("upto >= rest").groupBy("s").agg(
        F.min(F.struct("upto", "o", "mix_block", "t", "rest", "epochs")).alias("x")).collect()
    ends = {r["s"]: r["x"] for r in last}
    cut = spark.createDataFrame(
        [(s, epochs[s], times[s], x["o"] if x else None, x["mix_block"] if x else None,
          float(rest[s] - (x["upto"] - x["t"])) if x else 0.0) for s in totals for x in [ends.get(s)]],
        f"c_source {dict(docs.dtypes)[source]}, epochs int, times double, c_order long, c_block int, c_rest double")
    there = held.join(F.broadcast(cut), held[source].eqNullSafe(cut.c_source))
    inner = Window.partitionBy("c_source").orderBy("o", "mix_key").rowsBetween(Window.unboundedPreceding, 0)
    inside = there.filter("mix_block = c_block").select(
        "c_source", "mix_key", "mix_tokens", "c_rest", turn(F.col("epochs")).alias("o"))
    inside = inside.withColumn("upto", F.sum("mix_tokens").over(inner)).filter("upto <= c_rest")
    stops = {r["c_source"]: r["o"] for r in inside.groupBy("c_source").agg(F.max("o").alias("o")).collect()}
    stop = spark.createDataFrame([(s, stops.get(s)) for s in totals],
                                 f"d_source {dict(docs.dtypes)[source]}, d_stop long")
    there = there.join(F.broadcast(stop), there[source].eqNullSafe(stop.d_source))
    o = place(F.col("epochs"))
    partly = F.coalesce((o < F.col("c_order")) | ((o == F.col("c_order")) & (F.col("mix_block") < F.col("c_block"))),
                        F.lit(False)) | F.coalesce((F.col("mix_block") == F.col("c_block")) &
                                                   (turn(F.col("epochs")) <= F.col("d_stop")), F.lit(False))
    n = F.col("epochs") + partly.cast("int")
    taken = there.withColumn("mix_epoch", F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(
        F.array().cast("array<int>"))))
    unit = (place(F.col("mix_epoch")) / F.lit(2.0 ** 64)) + F.lit(0.5)
    at = (F.col("mix_epoch") + unit) / F.greatest(F.col("times"), F.col("mix_epoch") + 1.0)
    return taken.select(*result, *(["mix_tokens", "mix_epoch", "mix_block", at.alias("mix_at")] if added else []))


def schedule(docs: DataFrame) -> DataFrame:
    """The mix as ids and places, without the texts."""
    return mix(docs.select("doc_id", "source", "text")).select(
        "doc_id", "source", F.col("mix_tokens").alias("n_tokens"), F.col("mix_epoch").alias("epoch"),
        F.col("mix_block").alias("block"), F.col("mix_at").alias("at"))
