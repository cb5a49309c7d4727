"""Centroid clustering against a plain-Python version, on odd rows too."""

import hashlib
import math

import numpy as np

from stratum.llm import centroids


def brute(rows, k=16, rounds=3):
    """(id, cluster, distance) of the kept rows and the final centroids."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [max(-centroids.LIMIT, min(centroids.LIMIT, math.floor(64 * x))) for x in v]))
    starts = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    cents = [v for _, v in starts]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        parts = {}
        for _, v in kept:
            parts.setdefault(near(v)[1], []).append(v)
        cents = [[sum(x) // len(parts[n]) for x in zip(*parts[n])] if n in parts else c for n, c in enumerate(cents)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], cents


def check(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr("*", "1 as id", "2 as v", "3 as c", "4 as cluster")
    want, cents = brute([(r["vec_id"], r["embedding"]) for r in df.collect()])
    got = centroids.digests(df).collect()
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
        assert r["inertia"] == sum(d for *_, d in want)
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, cents[r["cluster"]])).encode()).hexdigest()


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    means = rng.normal(size=(20, 64))
    rows = [(int(i), [float(x) for x in np.float32(means[i % 20] + 0.2 * rng.normal(size=64))]) for i in range(300)]
    bad = [0.5] * 64
    rows += [(1000, None), (1001, []), (1002, [0.1] * 63), (1003, bad[:-1] + [None]), (1004, bad[:-1] + [float("nan")]),
             (1005, bad[:-1] + [float("-inf")]), (1006, [0.0] * 64), (1007, bad), (1007, bad), (1007, [-0.5] * 64), (None, bad)]
    check(spark, rows)


def test_ties_huge_components_and_few_vectors(spark):
    one = [1.0] * 64
    check(spark, [(1, one), (2, one), (3, [1.0] * 63 + [1e30]), (4, [-1e300] * 64), (5, [1e300] * 64)], "double")
    empty = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<float>")
    assert centroids.digests(empty).count() == 0 and centroids.digests(empty.limit(0)).count() == 0


def test_only_null_ids_leave_one_centroid_of_zeros(spark):
    rows = [(None, [float(i)] * 64) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = centroids.digests(df).collect()
    assert len(out) == 5 and {r["cluster"] for r in out} == {0}
