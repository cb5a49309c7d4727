"""Line dedup against brute force, and its index against one built anew."""

import hashlib
import random

from stratum.llm import line_dedup
from stratum.llm.line_dedup import Cuckoo, LineIndex, delete, drop_lines, dropped, insert, open_index

STRIP = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """(doc_id, n_lines, n_dropped, kept text) of each row"""
    held = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            k = x.strip(STRIP).translate(LOWER)
            if len(k) >= 20 and i is not None:
                held.setdefault(k, set()).add(i)
    out = []
    for i, t in rows:
        own = (t or "").split("\n")
        stay = [x for x in own if i is None or len(d := held.get(x.strip(STRIP).translate(LOWER), ())) < 3 or i == max(d)]
        out.append((i, len(own), len(own) - len(stay), "\n".join(stay)))
    return out


def corpus():
    rng = random.Random(12)
    common = [f"this line is common number {k}" for k in range(60)] + ["é" * 19, "é" * 20, "Ünïcödé line of twenty", "x" * 19, "İstanbul and some more"]
    rows = [(i, "\n".join(rng.choice([c, c.upper(), f" \t{c}\r", c + "\x0b", "short", "", f"own line of document {i}"])
                          for c in rng.choices(common, k=rng.randint(1, 12)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "\n"), (None, "this line is common number 1\nx"), (503, " this line is common number 2"),
             (7, rows[7][1]), (7, "this line is common number 3\nthis line is common number 3"), (900, "hot line held by very many documents")]
    rows += [(1000 + i, "Hot line held by very many documents") for i in range(300)] + [(504, ("long line " * 20 + "\n") * 3000)]
    return rows


def result(rows):
    return sorted([(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in rows], key=repr)


def test_lines_equal_brute_force(spark, tmp_path):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as n", "3 as last", "4 as n_lines").repartition(6)
    want = sorted([(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(rows)], key=repr)
    assert any(x[2] for x in want)
    assert result(line_dedup.digests(df, f"{tmp_path}/a").collect()) == want
    index = open_index(spark, f"{tmp_path}/a")
    small = dropped(index, filter_bytes=0)
    assert small.exceptAll(dropped(index)).count() == 0 and dropped(index).exceptAll(small).count() == 0
    kept = drop_lines(df, dropped(index))
    assert kept.columns == ["doc_id", "key", "n", "last", "text", "n_lines", "n_dropped"]
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in kept.collect()), key=repr) == sorted(brute(rows), key=repr)


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.digests(none, f"{tmp_path}/a").count() == 0
    index = open_index(spark, f"{tmp_path}/a")
    assert dropped(delete(insert(index, none), none)).count() == 0


def test_deleting_documents_restores_lines(spark, tmp_path):
    rows = corpus()
    frame = lambda some: spark.createDataFrame(some, "doc_id long, text string")
    first, second = [r for r in rows if (r[0] or 0) % 2 == 0], [r for r in rows if (r[0] or 0) % 2]
    index = insert(LineIndex(spark, f"{tmp_path}/a"), frame(first))
    alone = index
    index = insert(index, frame(second))
    index = insert(index, frame(second[:20]))  # a replay
    lost = {(r["doc_id"], bytes(r["key"])) for r in dropped(index).collect()}
    whole = insert(LineIndex(spark, f"{tmp_path}/b"), frame(rows))
    assert lost == {(r["doc_id"], bytes(r["key"])) for r in dropped(whole).collect()} and lost
    index = delete(index, frame(second + [(12345, "unknown")]))
    back = {(r["doc_id"], bytes(r["key"])) for r in dropped(open_index(spark, f"{tmp_path}/a")).collect()}
    assert back == {(r["doc_id"], bytes(r["key"])) for r in dropped(alone).collect()} and back != lost
    counts = lambda x: {(bytes(r["key"]), r["n"], r["last"]) for r in x.counts().filter("n > 0").collect()}
    assert counts(index) == counts(alone)


def test_filter_takes_and_returns_every_key():
    rng = random.Random(2)
    keys = [rng.randbytes(16) for _ in range(5000)]
    f = Cuckoo.sized(len(keys))
    f.add(keys)
    assert f.has(keys).all() and f.has([rng.randbytes(16) for _ in range(5000)]).mean() < 0.01
    f = Cuckoo(0, *f.row())
    f.remove(keys[:2500])
    assert f.has(keys[2500:]).all() and f.has(keys[:2500]).mean() < 0.01
    crowded = Cuckoo(4)  # far more keys than slots: the rest is listed
    crowded.add(keys[:100])
    assert crowded.extra and crowded.has(keys[:100]).all()
    crowded = Cuckoo(0, *crowded.row())
    crowded.remove(keys[:100])
    assert not crowded.extra and not crowded.table.any()


def test_full_filters_are_rebuilt(spark, tmp_path):
    def docs(a, b):
        return spark.createDataFrame([(d, "\n".join(f"line number {k} that three documents hold" for k in range(a, b))) for d in range(3)],
                                     "doc_id long, text string")

    index = insert(LineIndex(spark, f"{tmp_path}/a", shards=2), docs(0, 20))
    index = insert(index, docs(0, 900))
    assert index.filters().agg({"held": "sum"}).first()[0] == 900
    assert dropped(index).count() == 1800
    index = delete(index, spark.createDataFrame([(0,)], "doc_id long"))
    assert index.filters().agg({"held": "sum"}).first()[0] == 0 and dropped(index).count() == 0
