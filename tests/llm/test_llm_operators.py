"""The operators against brute force and reference libraries, on odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import bwt_intervals
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratum.llm import (chunk_dedup, embedding_dedup, fingerprints, labelled, mixing, quality, repeat_dedup, sentencepiece_codec,
                         simhash_dedup, token_store, toxicity)
from stratum.llm.common import connected_components, within_share
from stratum.llm.queries import tokenizer_file


def rows_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


def test_codec_equals_the_library(spark, odd_docs):
    file = tokenizer_file("piece_bpe_32k.model")
    sp, own = sentencepiece.SentencePieceProcessor(model_file=file), sentencepiece_codec.codec(file)
    rng = random.Random(3)
    parts = ["a", "th", " ", "  ", "▁", "\n", "é", "中", "\U0001d11e", "\x00", "!", "<s>", "<0x0A>", "the", "ing", "20", ","]
    for _ in range(400):
        s = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        want = sp.encode(s, add_bos=True, add_eos=True)
        assert np.frombuffer(own.encode(s), "<u4").tolist() == want
        assert own.decode(own.encode(s)) == sp.decode(want)
        ids = [rng.randrange(260) if rng.random() < 0.4 else rng.randrange(32000) for _ in range(6)]
        assert own.decode(np.array(ids, "<u4").tobytes()) == sp.decode(ids)
    out = sentencepiece_codec.encode_and_decode(odd_docs, file).collect()
    assert len(out) == odd_docs.count()
    for r in out:
        assert np.frombuffer(r["ids"], "<u4").tolist() == sp.encode(r["text"] or "", add_bos=True, add_eos=True)
    assert sentencepiece_codec.digests(sentencepiece_codec.encode_and_decode(odd_docs.limit(0), file)).count() == 0


def brute_fingerprint(text):
    w = text.encode().lower().split()
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def test_simhash_components(spark, odd_docs):
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash_dedup.digests(odd_docs).collect()}
    rows = [(i, brute_fingerprint(t)) for i, t in rows_of(odd_docs)]
    comp = {f: {f} for _, f in rows}
    for _, a in rows:
        for _, b in rows:
            if (a ^ b).bit_count() <= 3:
                comp[a] |= comp[b]
                for x in comp[a]:
                    comp[x] = comp[a]
    low = {f: min((i for i, g in rows if g in comp[f] and i is not None), default=None) for f in comp}
    assert got == {(i, f"{f:016x}", low[f]) for i, f in rows}
    kept = simhash_dedup.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(
        {v for v in low.values() if v is not None})


def test_simhash_links_within_three_bits(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(40)]
    vals = base + [b ^ sum(1 << k for k in rng.sample(range(64), n)) for b in base for n in (1, 2, 3, 4)]
    signed = [v - (1 << 64) if v >> 63 else v for v in vals]
    got = {(r["a"], r["b"]) for r in simhash_dedup.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert got == want


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 160)}}


def test_fingerprints(spark, odd_docs):
    out = {(r["doc_id"], r["n_chars"]): r for r in fingerprints.edited_fingerprints(odd_docs).collect()}
    assert len(out) == len(set(rows_of(odd_docs)))
    rows = sorted(set(rows_of(odd_docs)), key=lambda r: (r[0] is None, -(r[0] or 0)))
    for k, (i, t) in enumerate(rows):
        n, after = len(t), rows[(k + 1) % len(rows)][1]
        r = out[i, n]
        assert r["edited_sha256"] == hashlib.sha256((t[:n - n // 2] + after[:n // 2]).encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert out[5, out_len(rows, 5)]["fingerprint"] == out[6, out_len(rows, 6)]["fingerprint"]
    assert fingerprints.edited_fingerprints(odd_docs.limit(0)).count() == 0


def out_len(rows, i):
    return next(len(t) for j, t in rows if j == i)


def test_search_within_radius(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(128) for _ in range(15)]
    vals = base + [b ^ sum(1 << k for k in rng.sample(range(128), n)) for b in base for n in (1, 3, 4)]
    s = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(s(v >> 64), s(v & (1 << 64) - 1)) for v in vals], "fp_hi long, fp_lo long")
    want = sum((a ^ b).bit_count() <= 3 for a in set(vals) for b in set(vals))
    assert fingerprints.within(df, df).count() == want


def test_chunk_dedup(spark, odd_docs):
    out = chunk_dedup.remove_copies(odd_docs)
    assert out.columns == [*odd_docs.columns, "removed"]
    got = {r["doc_id"]: r for r in out.collect()}
    text = dict(rows_of(odd_docs))
    assert got[5]["removed"] == [] or got[5]["text"] != ""  # the first copy loses only its own repeats
    assert got[6]["text"] == "" or len(got[6]["text"]) < chunk_dedup.MIN_RUN
    assert got[10]["text"] == text[10] and len(got[11]["text"]) < 0.6 * len(text[11])
    assert got[1]["text"] == text[1] and got[2]["text"] == ""
    raw = text[5].encode()
    ends = chunk_dedup.cuts(raw)
    assert ends[-1] == len(raw) and max(np.diff([0, *ends])) <= chunk_dedup.MAX_CHUNK + chunk_dedup.MIN_CHUNK
    assert chunk_dedup.digests(odd_docs.limit(0)).count() == 0


def test_chunk_dedup_takes_whole_passages(spark):
    rng = random.Random(8)
    vocab = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 8))) for _ in range(4000)]
    rows, passages = [], {}
    for k in range(150):
        passages[k] = " ".join(rng.choices(vocab, k=55))
        for i in (2 * k, 2 * k + 1):
            rows.append((i, " ".join(rng.choices(vocab, k=rng.randint(30, 60))) + f" <{i}> " + passages[k] + f" [{i}] " +
                         " ".join(rng.choices(vocab, k=30))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in chunk_dedup.remove_copies(df).collect()}
    assert all(got[i]["removed"] == [] for i in range(0, 300, 2))
    whole, untouched = 0, 0
    for k, p in passages.items():
        text, r = rows[2 * k + 1][1], got[2 * k + 1]
        at = text.index(p)
        whole += any(x["start"] <= at and x["end"] >= at + len(p) for x in r["removed"])
        untouched += r["removed"] == []
        gone = sum(x["end"] - x["start"] for x in r["removed"])
        assert gone <= len(p) + 12 and len(r["text"]) == len(text) - gone
    assert whole + untouched == 150  # a passage that is found goes whole
    assert untouched <= 7


def test_chunk_dedup_keeps_clashing_names(spark, odd_docs):
    import corpus_pipeline

    names = ["dk", "th", "removed", "copied", "contexts", "__cut", "c0"]
    docs = odd_docs.withColumn("n_chars", F.lit(0).cast("long")).withColumns({c: F.lit(c) for c in names})
    out = corpus_pipeline.substring_dedup(spark, docs, None)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert all(r[c] == c for r in out.collect() for c in names)


def test_chunk_dedup_without_spaces_and_with_periods(spark):
    rng = random.Random(9)
    han = lambda k: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(k))
    code = lambda k: "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdef0123456789+/", k=k))
    said = lambda k: " ".join(code(rng.randint(2, 7)) for _ in range(k)) + " "
    rows, passages = [], {}
    for k in range(60):
        make = (han, code, said)[k % 3]
        passages[k] = said(rng.choice([1, 2, 3, 8])) * 60 if make is said else make(400)
        rows += [(i, make(rng.randint(40, 160)) + passages[k] + make(60)) for i in (2 * k, 2 * k + 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in chunk_dedup.remove_copies(df).collect()}
    for k, p in passages.items():
        raw, part = rows[2 * k + 1][1].encode(), p.encode()
        at = raw.index(part)
        assert any(x["start"] <= at and x["end"] >= at + len(part) for x in got[2 * k + 1]["removed"]), (k, p[:40])
        if k % 3 < 2:
            assert got[2 * k]["removed"] == []


def test_repeat_dedup(spark, odd_docs):
    docs = rows_of(odd_docs)
    raws = [t.encode() for _, t in docs]
    where = {}
    for r in raws:
        for w in range(len(r) - 399):
            where[r[w:w + 400]] = where.get(r[w:w + 400], 0) + 1
    want = []
    for (i, _), r in zip(docs, raws, strict=True):
        gone = np.zeros(len(r) + 1, bool)
        for w in range(len(r) - 399):
            if where[r[w:w + 400]] > 1:
                gone[w:w + 400] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(np.frombuffer(r, np.uint8)[~gone[:len(r)]])
        want.append((str(i), len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    got = [(str(r["doc_id"]), *list(r)[1:]) for r in repeat_dedup.digests(odd_docs).collect()]
    assert sorted(got) == sorted(want)
    assert repeat_dedup.digests(odd_docs.limit(0)).count() == 0


def test_repeats_equal_interval_expansion(spark, monkeypatch):
    """Against the breadth-first interval expansion on a Burrows-Wheeler transform, and with slabs of a few hundred bytes."""
    rng = random.Random(14)
    short = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 60))) for _ in range(30)]
    for least in (1, 3, 8):
        seen = {}
        for t in short:
            for k in range(len(t) - least + 1):
                seen[t[k:k + least]] = seen.get(t[k:k + least], 0) + 1
        for t, got in zip(short, bwt_intervals.repeated_starts(short, least), strict=True):
            assert got.tolist() == [k for k in range(len(t) - least + 1) if seen[t[k:k + least]] > 1]
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (399, 400, 450, 900, 1500)]
    texts = ["".join(rng.choice([*passages, "xy" * 300, "own " + str(rng.random())]) for _ in range(rng.randint(0, 6))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {}
    for i, (t, starts) in enumerate(zip(texts, bwt_intervals.repeated_starts([t.encode() for t in texts], 400), strict=True)):
        gone = np.zeros(len(t) + 1, int)
        for k in starts.tolist():
            gone[k:k + 400] = 1
        want[i] = (len(t), int(gone.sum()), int((np.diff(gone, prepend=0) == 1).sum()))
    assert sum(n > 0 for _, n, _ in want.values()) > 20
    for slab in (repeat_dedup.SLAB, 700):
        monkeypatch.setattr(repeat_dedup, "SLAB", slab)
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in repeat_dedup.digests(df).collect()}
        assert got == want


def test_embedding_links(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 32))
    x = np.concatenate([base, base[:30] + 0.15 * rng.normal(size=(30, 32)), base[:5]]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [
        (900, None), (901, []), (902, [0.0] * 32), (903, [float("nan")] * 32), (904, [1.0, 2.0]), (None, x[0].tolist())]
    rows.append(rows[0])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("n", F.lit(1))
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = ((u @ u.T) >= 0.9).sum(1) - 1
    have = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (have <= want).all() and have.sum() >= 0.9 * want.sum()
    assert got[900]["kept"] and got[903]["component_id"] == 903 and got[None]["n_links"] == 0
    assert len(got) == len(x) + 6
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_every_link_counts_once(spark, monkeypatch):
    """A near-copy group over many blocks, copies, and chains: counts and components as by brute force, rows in proportion."""
    rng = np.random.default_rng(6)
    centre = rng.normal(size=16)
    near = centre + 0.05 * rng.normal(size=(300, 16))
    chain = [np.cos(k * 0.3) * np.eye(16)[0] + np.sin(k * 0.3) * np.eye(16)[1] for k in range(6)]
    x = np.concatenate([near, near[:20], chain, 3.0 * rng.normal(size=(40, 16))])
    df = spark.createDataFrame([(i * 7 % 1009, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(embedding_dedup, "BLOCK", 40)
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (u @ u.T) >= 0.9
    have = np.array([got[i * 7 % 1009]["n_links"] for i in range(len(x))])
    want = linked.sum(1) - 1
    assert (have <= want).all() and have.sum() >= 0.999 * want.sum()
    ids = np.arange(len(x)) * 7 % 1009
    low = ids.copy()
    for _ in range(len(x)):
        low = np.where(linked, low[None, :], 1 << 40).min(1)
    assert all(got[i]["component_id"] >= m for i, m in zip(ids.tolist(), low.tolist(), strict=True))
    assert len({got[i]["component_id"] for i in ids[:320].tolist()}) == 1
    good = embedding_dedup.vectors(df, "vec_id", "embedding").groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    rows = embedding_dedup.meetings(good, wide=True).count()
    assert rows < 300 * embedding_dedup.TABLES * (embedding_dedup.PROBES + 1) * (300 // 40 + 2)


def test_crowded_buckets_are_compared_whole(spark, monkeypatch):
    v = np.ones((60, 8)) + np.arange(60)[:, None] * 1e-4 * np.eye(8)[0]
    df = spark.createDataFrame([(i, a.tolist()) for i, a in enumerate(v)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(embedding_dedup, "BLOCK", 7)
    assert {r["n_links"] for r in embedding_dedup.near_duplicates(df).collect()} == {59}


def test_mixing(spark, odd_docs):
    shares = {"a": 0.8, "b": 0.15, "c": 0.05}
    x, w, times = mixing.solve(shares, max_repeats=2.0)
    assert 0 < x < 1 and max(times.values()) == pytest.approx(2.0) and sum(w.values()) == pytest.approx(1.0)
    x, w, _ = mixing.solve(shares, entropy=0.8)
    assert -sum(p * np.log(p) for p in w.values()) == pytest.approx(0.8)
    _, _, times = mixing.solve(shares, max_repeats=1.25, budget=None)
    assert min(times.values()) == pytest.approx(1.0) and max(times.values()) == pytest.approx(1.25)
    docs = spark.range(4000).selectExpr("id as doc_id", "if(id % 10 = 0, 'rare', 'common') as source", "'one two three' as text")
    got = {r["source"]: r["t"] for r in mixing.mix(docs, max_repeats=2.0).groupBy("source").agg(
        F.sum("mix_tokens").alias("t")).collect()}
    assert got["rare"] == 2 * 400 * 3 and abs(got["common"] - (12000 - 2400)) <= 3
    kept = mixing.mix(odd_docs, max_repeats=1.25, budget=None)
    assert kept.filter("mix_epoch = 0").count() == odd_docs.count()
    assert mixing.mix(odd_docs.limit(0)).count() == 0


def test_mixing_without_a_token(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, "  ", None)], "doc_id long, text string, source string")
    for budget in (None, 1.0):
        got = mixing.mix(docs, max_repeats=1.25, budget=budget).collect()
        assert sorted((r["doc_id"], r["mix_epoch"], r["mix_tokens"]) for r in got) == [(1, 0, 0), (2, 0, 0), (3, 0, 0)]
        assert all(0 <= r["mix_at"] <= 1 for r in got)


def test_mixing_keeps_clashing_names(spark, odd_docs):
    import corpus_pipeline

    names = ["mix_x", "mix_tokens", "mix_key", "mix_at", "epochs", "times", "c_rest", "d_stop", "c0"]
    docs = odd_docs.withColumns({c: F.lit(c) for c in names})
    out = corpus_pipeline.mix_sources(spark, docs, None)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) >= docs.count() and all(r[c] == c for r in rows for c in names)


def test_segments_are_the_maximal_ones():
    hits = [(0, 4.0), (8, 3.0), (60, 2.0), (61, 2.0)]
    assert [(a, b, round(s, 6)) for a, b, s in toxicity.segments(hits, 0.1)] == [(0, 8, 6.3), (60, 61, 4.0)]
    assert toxicity.segments([], 0.1) == []


def test_segments_equal_brute_force():
    def best(scores, lo, hi):
        """All maximal segments: the best one, then those left and right of it."""
        sums = [(sum(scores[a:b]), a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)]
        if not sums or (top := max(sums))[0] <= 0:
            return []
        return best(scores, lo, top[1]) + [(top[1], top[2] - 1, round(top[0], 9))] + best(scores, top[2], hi)

    rng = random.Random(21)
    for _ in range(300):
        hits = {i: rng.uniform(0.05, 2) for i in range(18) if rng.random() < 0.4}
        gap = rng.choice([0.1, 0.37, 0.9])
        scores = [hits.get(i, -gap) for i in range(18)]
        assert [(a, b, round(s, 9)) for a, b, s in toxicity.segments(sorted(hits.items()), gap)] == best(scores, 0, 18)


def test_toxicity_of_empty_tables(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (77, 1)], "doc_id long, toxic int")
    assert toxicity.digests(odd_docs.limit(0), labels).count() == 0
    assert toxicity.keep_clean(odd_docs.limit(0), labels.limit(0)).count() == 0
    out = toxicity.digests(odd_docs, labels.limit(0)).collect()
    assert len(out) == odd_docs.count() and max(r["score"] for r in out) < 0.01
    odd = odd_docs.selectExpr("*", "7 as __toxicity", "8 as `__TOXICITY_`")
    assert toxicity.keep_clean(odd, labels.limit(0)).select("__toxicity").distinct().first()[0] == 7
    assert simhash_dedup.deduplicate(odd.selectExpr("*", "9 as __gone")).select("__gone").distinct().first()[0] == 9


def test_toxicity(spark, odd_docs):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=80)) + (" vile scum" if i % 7 == 0 else ""), int(i % 7 == 0)) for i in range(600)]
    data = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    out = toxicity.digests(data.select("doc_id", "text"), data.select("doc_id", "toxic")).collect()
    assert all(r["predicted"] == int(r["doc_id"] % 7 == 0) for r in out)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    none = toxicity.keep_clean(odd_docs, data.select("doc_id", "toxic").limit(0))
    assert none.count() == odd_docs.count() and none.columns == odd_docs.columns


def test_quality(spark, odd_docs):
    rng = random.Random(6)
    words = [f"word{i}" for i in range(300)]
    good = lambda: " ".join(rng.choices(words, k=60)) + "."
    rows = [(i, good() if i % 5 else "SPAM!! " * 40, int(i % 5 > 0)) for i in range(700)]
    data = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    out = quality.digests(data.select("doc_id", "text"), data.select("doc_id", "quality")).collect()
    right = [r["predicted"] == int(r["doc_id"] % 5 > 0) for r in out if r["held_out"]]
    assert np.mean(right) > 0.95
    none = quality.digests(odd_docs.select("doc_id", "text"), data.select("doc_id", "quality").limit(0)).collect()
    assert len(none) == odd_docs.count() and {r["score"] for r in none} == {0.5}


def test_token_store(spark, odd_docs, tmpdir_path):
    file, path = tokenizer_file("word_bpe_49k.json"), f"{tmpdir_path}/store"
    token_store.write(odd_docs, path, file, 2)
    t = Tokenizer.from_file(file)
    rows = sorted(rows_of(odd_docs), key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted((tuple(r) for r in token_store.read(spark, path).collect()), key=lambda r: r[1])
    start = 0
    for (i, text), r in zip(rows, got, strict=True):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert r == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    one = token_store.lookup(spark, path, [1]).collect()
    assert [r["ids"] for r in one] == [[*t.encode(dict(rows)[1], add_special_tokens=False).ids, 2]]
    token_store.write(odd_docs.limit(0), f"{tmpdir_path}/empty", file, 2)
    assert token_store.read(spark, f"{tmpdir_path}/empty").count() == 0


def test_samples_of_very_many_rows(spark):
    ids = spark.range(20_000_000).withColumnRenamed("id", "doc_id")
    assert 2 <= labelled.bounded(ids, 10).count() <= 30
    assert ids.limit(1000).filter(within_share(F.xxhash64("doc_id"), 1.0)).count() == 1000


def test_word_encoder_equals_the_library(monkeypatch):
    file = tokenizer_file("word_bpe_49k.json")
    t = Tokenizer.from_file(file)
    rng = random.Random(8)
    parts = ["The", "the", "naïve", "it's", "12", "3.5", " ", "  ", "\n", "\u3000", "\x85", "\x0b", "\x1f", "\x00", "<|endoftext|>", "e", "\u0301", "!", "...", "中文",
             "\U0001d11e", "stop-it", ".", ",", "İ", "\u200b", "\ufeff"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["", "x" * 50_000, "w " * 30_000]
    for words in (token_store.CACHE_WORDS, 2000, 50):
        monkeypatch.setattr(token_store, "CACHE_WORDS", words)
        own = token_store.WordEncoder(file, 2)
        arrow = pa.array(["skipped", *texts])[1:]  # a slice: offsets don't start at 0
        got = [x for lo in range(0, len(texts), 500) for x in own(arrow[lo:lo + 500])]
        for text, ids in zip(texts, got, strict=True):
            assert ids.tolist() == t.encode(text, add_special_tokens=False).ids, text
    monkeypatch.setattr(token_store, "SLICE_BYTES", 100)
    spans = list(token_store._slices_of(arrow))
    assert [a for a, _ in spans[1:]] == [b for _, b in spans[:-1]] and spans[0][0] == 0 and spans[-1][1] == len(texts)
    assert list(token_store._slices_of(arrow[:0])) == []


def test_words_that_normalising_changes():
    file = tokenizer_file("word_bpe_49k.json")
    t, own = Tokenizer.from_file(file), token_store.WordEncoder(file, 2)
    cores = ["İ", "EĞİTİMİ", "İstanbul", "\u0915\u0958", "\u095f", "पढ\u093c", "\u05d0\ufb2a", "\ufb4b", "ﬁ", "ǅ", "é", "e\u0301", "ẞ", "中文", "İ1"]
    texts = [c + m for c in cores for m in ("", ".", ",", "!?", ";:")]
    texts.append(" ".join(texts))
    for text, ids in zip(texts, own(pa.array(texts)), strict=True):
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids, text
    # every letter, before a closing mark
    letters = [chr(c) + "." for c in range(0x110000) if chr(c).isalpha()]
    for k in range(0, len(letters), 20_000):
        part = letters[k:k + 20_000]
        wrong = [w for w, ids, e in zip(part, own(pa.array(part)), t.encode_batch_fast(part, add_special_tokens=False), strict=True)
                 if ids.tolist() != e.ids]
        assert wrong == []


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(40), sf)
        assert out.columns == docs.columns
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
