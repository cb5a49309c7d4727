"""The Merkle manifest against a plain-Python tree."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from stratum.llm import manifest


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def enc(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def siblings(tree, pos):
    """(left, right) of a position, by level."""
    path = []
    for nodes in tree[:-1]:
        run = pos // 16 * 16
        path.append(("".join(nodes[run:pos]), "".join(nodes[pos + 1:run + 16])))
        pos //= 16
    return path


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    groups = {}
    for r in rows:
        claim = r[4]
        if r[0] is not None and claim is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
            claim = claim.encode().lower().decode()
        leaf, claimed = (h("".join(map(enc, (*r[:4], t)))) for t in (r[4], claim))
        groups.setdefault(r[1], []).append((r[0], leaf, claimed))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        trees[s] = levels([x[1] for x in groups[s]])
    top = levels([trees[s][-1][0] for s in names]) if names else None
    out = []
    for k, s in enumerate(names):
        for pos, (i, leaf, claim) in enumerate(groups[s]):
            path = siblings(trees[s], pos) + siblings(top, k)
            f = claim
            for a, b in path:
                f = h(a + f + b)
            out.append((i, leaf, trees[s][-1][0], top[-1][0], h("".join(a + b for a, b in path)), f, f == top[-1][0]))
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as key", "2 as pos", "3 as leaf", "4 as total", "5 as part").repartition(5)
    got = manifest.digests(df).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows), key=repr)


def test_manifest_equals_brute_force(spark):
    rng = random.Random(4)
    ids = rng.sample(range(-3000, 9000), 5600)
    sources = ["src0"] * 6 + ["é", "z", "Z", "", None, "one"]
    rows = [(i, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, i]), rng.choice(["Some Text", "plain", None, "", "É A"]))
            for i in ids]
    rows += [(1 << 62, "far", "en", 1, "A"), (-(1 << 63), "far", "en", 1, "A"), ((1 << 63) - 1, "far", "en", 1, "b"), (20000, "lone", None, None, None)]
    assert sum(r[1] == "src0" for r in rows) > 256
    check(spark, rows)


def test_sizes_round_the_fan(spark):
    for n in (1, 2, 16, 17, 256, 257):
        check(spark, [(i * 977, "s", "en", 5, "Text") for i in range(n)])


def test_repeated_rows_null_ids_and_many_sources(spark):
    rows = [(5, "a", "en", 1, "T")] * 40 + [(5, "a", "en", 1, t) for t in "bcd"] + [(None, "a", None, None, t) for t in "xyxx"]
    rows += [(6, "a", "en", 1, "T"), (70, "a", "en", 1, "T"), (4, "a", "en", 1, "T"), (None, None, None, None, None)]
    rows += [(i, f"s{i}", "en", 1, "T") for i in range(300)]
    check(spark, rows)


def test_empty_table(spark):
    out = manifest.digests(spark.createDataFrame([], SCHEMA))
    assert out.columns == COLUMNS and out.count() == 0


def test_rank_queries(spark):
    rng = random.Random(9)
    ids = sorted({rng.randrange(-(1 << 40), 1 << 40) for _ in range(300)} | set(range(-70, 200, 3)) | {-(1 << 63), (1 << 63) - 1})
    df = spark.createDataFrame([("k", i) for i in ids] + [("k", ids[7])] * 4, "key string, id long")
    index = manifest.bitmap_index(df)
    ask = spark.createDataFrame([("k", i) for i in ids] + [("k", 1 << 50), ("other", ids[0]), ("k", ids[5] + 1)], "key string, id long")
    got = {r["id"]: (r["pos"], r["times"], r["total"]) for r in manifest.rank(ask, index).collect()}
    assert got == {i: (k + (4 if k > 7 else 0), 5 if k == 7 else 1, len(ids) + 4) for k, i in enumerate(ids)}
    assert index.filter(F.expr("size(words) <> bit_count(mask)")).count() == 0
