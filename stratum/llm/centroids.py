"""Lloyd's centroid clustering of integer vectors, in JVM expressions alone.

A vector's components become integers ``floor(scale * x)``.  A squared distance to a
literal centroid array is the sum of both squares less twice their product, which is
``aggregate(zip_with(vector, centroid, product), sum)``: one product a component.
``array_min`` over the structs (distance, number) chooses the nearest centroid, the
smaller number on ties; the vector's own square is the same for all and added last.  A round is one pass over the table:
the assignment and one sum per component run in the same stage, so that a task
sends one row of sums per centroid, whatever a cluster's size.  What reaches the
driver are these ``k`` rows of sums and the first centroids, k times the dimension
integers at most; new centroids are exact floors of sum by count.

The table is read once per round instead of being kept: a pass computes ``k``
distances a vector, beside which reading it costs little.  Only ids, clusters and
distances of the last pass are written, as sums over them are part of the result.

Results: one row per kept vector.  Vectors that are null, of another length, or that
hold a null or non-finite component are not kept.  Components are clamped to plus or
minus ``LIMIT`` after scaling, so that a distance fits a long whatever the input.  A
repeated row counts as often as it comes; rows of one id are ordered by their
components where the first centroids are chosen.  Rows with a null id are assigned and
counted, but start no centroid.  With fewer kept vectors than ``k``, each starts one;
if none has an id, one centroid of zeros starts.  Without kept vectors the result is empty.  Extra columns are not read, whatever their names.
An inertia that exceeds a long is null.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import materialize

K = 16
ROUNDS = 3
DIMENSION = 64
SCALE = 64
#: 64 squares of a difference of twice this sum to 2**62.
LIMIT = 1 << 27


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", dimension: int = DIMENSION,
                    scale: int = SCALE) -> DataFrame:
    """``(id, v)``: the kept vectors as arrays of longs."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    kept = vectors.select(F.col(id_col).alias("id"), x.alias("x")).filter((F.size("x") == dimension) & finite)
    whole = F.transform("x", lambda e: F.floor(F.least(F.greatest(e * float(scale), F.lit(-float(LIMIT))), F.lit(float(LIMIT)))))
    return kept.select("id", whole.alias("v"))


def first_centroids(vectors: DataFrame, k: int = K, seed: int = 1) -> list[list[int]]:
    """The ``k`` vectors with the smallest SHA-256 of ``<seed>:<id>``, in that order."""
    hashed = vectors.filter("id is not null").select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("h"), "v")
    return [list(r["v"]) for r in hashed.orderBy("h", "v").limit(k).collect()]


def nearest(v: Column, centroids: list[list[int]]) -> Column:
    """Struct ``(d, c)``: the least squared distance, less the vector's own square, and the number of its centroid."""
    def to(c: list[int]) -> Column:
        literal = F.expr(f"array({', '.join(f'{x}L' for x in c)})")
        product = F.aggregate(F.zip_with(v, literal, lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
        return F.lit(sum(x * x for x in c)).cast("long") - 2 * product

    return F.array_min(F.array([F.struct(to(c).alias("d"), F.lit(i).alias("c")) for i, c in enumerate(centroids)]))


def updated(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: floors of the means of their vectors, exact; those without vectors stay."""
    width = len(centroids[0])
    near = vectors.select(nearest(F.col("v"), centroids)["c"].alias("c"), "v")
    columns = near.selectExpr("c", *[f"v[{i}] AS x{i}" for i in range(width)])
    sums = columns.groupBy("c").agg(F.count("*").alias("n"), F.expr(f"array({', '.join(f'sum(x{i})' for i in range(width))})").alias("s"))
    new = [list(c) for c in centroids]
    for r in sums.collect():
        new[r["c"]] = [x // r["n"] for x in r["s"]]
    return new


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS,
            dimension: int = DIMENSION, scale: int = SCALE, seed: int = 1) -> tuple[DataFrame, list[list[int]]]:
    """``(id_col, cluster, distance)`` of every kept vector, and the final centroids."""
    whole = integer_vectors(vectors, id_col, vector, dimension, scale)
    centroids = first_centroids(whole, k, seed)
    if not centroids:
        centroids = [[0] * dimension]
    for _ in range(rounds):
        centroids = updated(whole, centroids)
    own = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x)
    last = whole.select(F.col("id").alias(id_col), nearest(F.col("v"), centroids).alias("near"), own.alias("own"))
    return last.select(id_col, F.col("near.c").alias("cluster"), (F.col("near.d") + F.col("own")).alias("distance")), centroids


def digests(vectors: DataFrame) -> DataFrame:
    """Clusters with their inertias and the hashes of their centroids."""
    assigned, centroids = cluster(vectors)
    assigned = materialize(assigned, "clusters")
    sums = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    own = [int(sums.get(i) or 0) for i in range(len(centroids))]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def long(n: int) -> Column:
        return F.lit(n if n < 1 << 63 else None).cast("long")

    return assigned.select("vec_id", "cluster", "distance", F.get(F.array([long(n) for n in own]), "cluster").alias("cluster_inertia"),
                           long(sum(own)).alias("inertia"), F.get(F.array([F.lit(s) for s in shas]), "cluster").alias("centroid_sha256"))


#: The same in SQL; rounds written out.
def _sql(rounds: int = ROUNDS, k: int = K) -> str:
    def assign(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (SELECT row_id, vec_id, v, d, c FROM (
  SELECT w.row_id, w.vec_id, w.v, m.c, list_sum(list_transform(list_zip(w.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
  FROM w CROSS JOIN m{i} AS m) QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY d, c) = 1)"""

    def update(i: int) -> str:
        return f"""s{i} AS MATERIALIZED (SELECT c, j, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (
  SELECT c, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS j FROM a{i}) GROUP BY c, j),
u{i} AS MATERIALIZED (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS v FROM s{i} GROUP BY c),
m{i + 1} AS MATERIALIZED (SELECT m.c, coalesce(u.v, m.v) AS v FROM m{i} AS m LEFT JOIN u{i} AS u ON u.c = m.c)"""

    steps = ",\n".join(f"{assign(i)},\n{update(i)}" for i in range(rounds)) + ",\n" + assign(rounds)
    return f"""WITH w AS MATERIALIZED (SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = 64),
m0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h, v) - 1)::INTEGER AS c, v FROM (
  SELECT sha256('1:' || vec_id) AS h, v FROM w WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {k})),
{steps}
SELECT a.vec_id, a.c AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
       sum(a.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN m{rounds} AS m ON m.c = a.c"""


SQL = _sql()
