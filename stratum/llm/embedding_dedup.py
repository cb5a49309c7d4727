"""Near-duplicate vectors by cross-polytope hashing.

Each table rotates a vector pseudo-randomly: three rounds of random signs and a
fast Hadamard transform (over the next power of two).  The hash is the coordinate
of largest magnitude with its sign; ``PARTS`` rotations make one bucket.  Every
vector is stored in its best bucket of each of ``TABLES`` tables and also looks into
the buckets where one part takes its next best coordinate (``PROBES`` of them, the
least costly first).  Candidates count as linked if their cosine in double precision
reaches the threshold, so no pair below it is linked; recall is measured by the tests.

Equal vectors are taken together before hashing.  The vectors stored in a bucket and
those that look into it are cut into blocks of about ``BLOCK``, and a task compares
one block with one other at a time, so that no bucket has to fit anywhere and a
crowded one is spread over many tasks.  No pair leaves a task: a block comparison
returns, for each of its vectors, how many links it settled and the smallest id that
it reaches there, so a group of M near copies gives rows in proportion to M for each
block it meets, not M * M.  A pair that meets several times is counted where it meets
first: every vector carries its buckets in all tables, by which a task knows of the
other meetings.

Results: a vector that is null, empty, zero, or has null or non-finite components
links with nothing and is its own component.  Vectors of unlike length are never
linked.  A repeated row (same id and vector) is one vector; an id with several vectors
has the sum of their links and the smallest of their components.  Rows with null
ids stay without links (their component is null).  An empty table gives an empty table.
Only the id and vector columns are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import connected_components, materialize

COSINE = 0.9
TABLES = 6
PARTS = 2
PROBES = 4
BLOCK = 512
SEED = 11


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of the rows, scaled to keep lengths."""
    n = x.shape[1]
    h = 1
    while h < n:
        x = x.reshape(len(x), -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    n = 1 << max(0, x.shape[1] - 1).bit_length()
    out = np.zeros((len(x), n))
    out[:, :x.shape[1]] = x
    rng = np.random.default_rng(seed)
    for _ in range(3):
        out = hadamard(out * rng.choice([-1.0, 1.0], n))
    return out


def buckets(x: np.ndarray, table: int, probes: int = PROBES) -> np.ndarray:
    """The buckets of each row in a table, the best first, then the probes."""
    ranked, costs = [], []
    for part in range(PARTS):
        r = rotate(x, (SEED * 1000 + table) * 10 + part)
        k = min(probes + 1, r.shape[1])
        top = np.argsort(-np.abs(r), axis=1, kind="stable")[:, :k]
        value = np.take_along_axis(r, top, 1)
        ranked.append(top * 2 + (value < 0))
        costs.append(np.abs(value[:, :1]) - np.abs(value))
    size = 2 * r.shape[1]
    best = [p[:, 0] for p in ranked]
    code = lambda parts: sum(p.astype(np.int64) * size ** j for j, p in enumerate(parts))
    tries = [(costs[j][:, k], code([ranked[j][:, k] if i == j else best[i] for i in range(PARTS)]))
             for j in range(PARTS) for k in range(1, ranked[j].shape[1])]
    if not tries:
        return code(best)[:, None]
    cost, codes = np.stack([t[0] for t in tries], 1), np.stack([t[1] for t in tries], 1)
    order = np.argsort(cost, axis=1, kind="stable")[:, :probes]
    return np.concatenate([code(best)[:, None], np.take_along_axis(codes, order, 1)], 1)


def _kind(wide: bool) -> str:
    return "<f8" if wide else "<f4"


def _hashed(wide: bool):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """For each vector and table the row that stores it, and rows that look into other buckets."""
        for batch in batches:
            for dim, group in batch.groupby(batch.v.map(len)):
                for lo in range(0, len(group), 2048):
                    part = group.iloc[lo:lo + 2048]
                    x = np.frombuffer(b"".join(part.v), _kind(wide)).reshape(len(part), -1).astype(float)
                    x = unit(x)
                    all_buckets = np.stack([buckets(x, t) for t in range(TABLES)], 1)
                    codes = [row.tobytes() for row in all_buckets.astype("<i8")]
                    for t in range(TABLES):
                        for k in range(all_buckets.shape[2]):
                            yield pd.DataFrame({"id": part.id.array, "v": part.v.array, "n": part.n.array, "codes": codes, "dim": dim,
                                                "tab": t, "bucket": all_buckets[:, t, k], "stored": k == 0})

    return rows


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, without overflow on the way."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _compare(wide: bool, cosine: float):
    key = ["dim", "tab", "bucket", "s", "l"]

    def links_of(group: pd.DataFrame) -> pd.DataFrame:
        x = unit(np.frombuffer(b"".join(group.v), _kind(wide)).reshape(len(group), -1).astype(float))
        codes = np.frombuffer(b"".join(group.codes), "<i8").reshape(len(group), TABLES, -1)
        ids, sizes, table = group.id.to_numpy(), group.n.to_numpy(), int(group.tab.iloc[0])
        left, right = np.flatnonzero(group.holds.to_numpy()), np.flatnonzero(group.looks.to_numpy())
        i, j = np.nonzero(x[left] @ x[right].T >= cosine)
        a, b = left[i], right[j]
        a, b = a[ids[a] != ids[b]], b[ids[a] != ids[b]]
        finds = lambda holder, looker, t: (codes[holder, t, :1] == codes[looker, t]).any(1)
        # of the meetings of a pair the one in the first table counts, and there the one in the smaller id's bucket
        met = (ids[a] > ids[b]) & finds(b, a, table)
        for t in range(table):
            met |= finds(a, b, t) | finds(b, a, t)
        others = np.zeros(len(group), np.int64)
        np.add.at(others, a[~met], sizes[b[~met]])
        np.add.at(others, b[~met], sizes[a[~met]])
        low, was = ids.copy(), None
        while was is None or (low != was).any():
            was = low.copy()
            np.minimum.at(low, a, was[b])
            np.minimum.at(low, b, was[a])
        out = (others > 0) | (low != ids)
        return pd.DataFrame({"id": ids[out], "others": others[out], "low": low[out]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The rows come sorted by key; the last group of a batch may go on in the next."""
        open_rows: list[pd.DataFrame] = []
        for batch in batches:
            codes = batch[key].to_numpy()
            starts = [0, *(np.flatnonzero((codes[1:] != codes[:-1]).any(1)) + 1).tolist(), len(batch)]
            if open_rows and (open_rows[-1][key].to_numpy()[-1] != codes[0]).any():
                yield links_of(pd.concat(open_rows))
                open_rows = []
            for a, b in zip(starts, starts[1:], strict=False):
                if b < len(batch):
                    if open_rows or b - a > 1:
                        yield links_of(pd.concat([*open_rows, batch.iloc[a:b]]))
                    open_rows = []
                else:
                    open_rows.append(batch.iloc[a:b])
        if open_rows:
            yield links_of(pd.concat(open_rows))

    return run


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Usable vectors as ``(id, v)``, v their components in bytes (4 each, 8 for doubles)."""
    wide = dict(df.dtypes)[vec_col] == "array<double>"
    good = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).filter(
        F.col("id").isNotNull() & (F.size(F.coalesce("v", F.array().cast(dict(df.dtypes)[vec_col]))) > 0))
    good = good.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                       & F.exists("v", lambda x: x != 0))
    packed = F.pandas_udf(lambda v: v.map(lambda x: np.asarray(x, _kind(wide)).tobytes()), "binary")
    return good.select("id", packed("v").alias("v")).distinct()


def meetings(distinct: DataFrame, cosine: float = COSINE, wide: bool = False) -> DataFrame:
    """What the vectors ``(id, v, n)`` find in the blocks they are compared in: ``(id, others, low)``.

    ``others`` adds the ``n`` of vectors linked with at least ``cosine``, each counted in one block only; ``low``
    is the smallest id that the block's links lead to.
    """
    key = ["dim", "tab", "bucket"]
    rows = distinct.select("id", "v", "n").mapInPandas(
        _hashed(wide), "id long, v binary, n long, codes binary, dim int, tab int, bucket long, stored boolean")
    # buckets of more than one block; the others are compared whole
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / BLOCK)).cast("int")
    crowded = rows.groupBy(*key).agg(blocks(F.count("*")).alias("ls"), blocks(F.sum(F.col("stored").cast("int"))).alias("ss"))
    rows = rows.join(crowded.filter("ls > 1").hint("merge"), key, "left").withColumns(
        {"ls": F.coalesce("ls", F.lit(1)), "ss": F.coalesce("ss", F.lit(1))})
    own = lambda n: F.pmod(F.xxhash64("id", "tab"), F.col(n).cast("long")).cast("int")
    line = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    # a stored vector meets the lookers of every block, a looker the stored of every block
    places = F.concat(
        F.transform(line("ss"), lambda s: F.struct(s.alias("s"), own("ls").alias("l"),
                                                   (F.col("stored") & (s == own("ss"))).alias("holds"), F.lit(True).alias("looks"))),
        F.when(F.col("stored"), F.transform(F.filter(line("ls"), lambda x: x != own("ls")), lambda x: F.struct(
            own("ss").alias("s"), x.alias("l"), F.lit(True).alias("holds"), F.lit(False).alias("looks"))))
        .otherwise(F.array().cast("array<struct<s int, l int, holds boolean, looks boolean>>")))
    spread = rows.select("id", "v", "n", "codes", *key, F.inline(places))
    spread = spread.repartition(*key, "s", "l").sortWithinPartitions(*key, "s", "l")
    return spread.mapInPandas(_compare(wide, cosine), "id long, others long, low long")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` per distinct id, and per row with a null id."""
    wide = dict(df.dtypes)[vec_col] == "array<double>"
    good = materialize(vectors(df, id_col, vec_col), "vectors")
    classes = good.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    members = good.join(classes.select("v", F.col("id").alias("rep"), "n"), "v").select("id", "rep", "n")
    members = materialize(members, "members")
    met = materialize(meetings(classes, cosine, wide), "meetings")
    around = met.groupBy(F.col("id").alias("a")).agg(F.sum("others").alias("others"))
    found = connected_components(met.select(F.col("id").alias("a"), F.col("low").alias("b")))
    per = members.join(around, members.rep == around.a, "left").join(found, members.rep == found.node, "left").select(
        "id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("c"))
    # an id with several vectors is one node: its links add up, its component is the smallest
    per = per.groupBy("id").agg(F.sum("n_links").alias("n_links"), F.min("c").alias("c"))
    ids = df.select(F.col(id_col).cast("long").alias("key"))
    ids = ids.filter("key is not null").distinct().unionByName(ids.filter("key is null"))
    return ids.join(per, ids.key == per.id, "left").select(
        F.col("key").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("c", "key").alias("component_id"), F.coalesce(F.col("c") == F.col("key"), F.lit(True)).alias("kept"))
