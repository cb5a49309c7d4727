"""Operators whose results follow from hashes, and the pipeline, against plain Python."""

import math
import random
import struct

import numpy as np
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from test_llm_operators import brute_fingerprint

from stratum.llm import fingerprints, mixing, toxicity
from stratum.llm.queries import tokenizer_file

MASK = (1 << 64) - 1


def spark_hash(*values):
    """Spark's xxhash64 of ints (4 bytes), ("long", x) and texts."""
    h = 42
    for v in values:
        if v is None:
            continue
        raw = struct.pack("<q", v[1]) if isinstance(v, tuple) else struct.pack("<i", v) if isinstance(v, int) else v.encode()
        h = xxhash.xxh64_intdigest(raw, h)
    return h


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_bits(text):
    words = text.strip(" ").lower().split()
    words = words if text.strip(" ") else [""]
    votes, total = np.zeros(128, int), 0
    for w, x in zip(words, [*words[1:], None], strict=True):
        weight = min(15, max(1, len(w) + len(x or "")))
        total += weight
        for half, h in ((0, spark_hash(w, x)), (64, spark_hash(1, w, x))):
            votes[half:half + 64] += weight * np.array([h >> b & 1 for b in range(64)])
    bits = [int(2 * v > total) for v in votes]
    return sum(b << k for k, b in enumerate(bits[:64])), sum(b << k for k, b in enumerate(bits[64:]))


def test_fingerprint_bits_likeness_and_near_counts(spark):
    rng = random.Random(3)
    vocab = ["the", "quick", "naïve", "fox", "a", "jumps", "extraordinarily", "über", "of", "x1"]
    texts = {i: " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 40))) for i in range(0, 130, 5)}
    texts |= {200: texts[50], 250: texts[50], 300: "", 301: " lead and trail ", 302: "word " * 5000, 303: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").selectExpr("*", "1 as fp_hi", "2 as n", "3 as next")
    got = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(docs).collect()}
    order = sorted(texts, reverse=True)
    plain = {i: (t or "") for i, t in texts.items()}
    fps = {i: brute_bits(t) for i, t in plain.items()}
    far = lambda a, b: sum((x ^ y).bit_count() for x, y in zip(a, b, strict=True))
    for k, i in enumerate(order):
        t, after = plain[i], order[(k + 1) % len(order)]
        edited = brute_bits(t[:len(t) - len(t) // 2] + plain[after][:len(t) // 2])
        r = got[i]
        assert r["fingerprint"] == "%016x%016x" % fps[i] and r["edited_fingerprint"] == "%016x%016x" % edited, i
        assert abs(r["near_edited"] - max(0.0, math.cos(far(fps[i], edited) * math.pi / 128))) < 1e-12
        assert abs(r["near_next"] - max(0.0, math.cos(far(fps[i], fps[after]) * math.pi / 128))) < 1e-12
        assert r["n_near"] == (sum(far(fps[i], f) <= 3 for j, f in fps.items() if j != i) if i % 50 == 0 else None)


def brute_mix(rows, max_repeats):
    """(doc_id, epoch) taken, with multiplicity, of rows (doc_id, source, text)."""
    held = [(i, s, len((t or "").split()), spark_hash(("long", i), ("long", signed(spark_hash(t or ""))), mixing.SEED)) for i, s, t in rows]
    totals = {}
    for _, s, n, _ in held:
        totals[s] = totals.get(s, 0) + n
    whole = sum(totals.values())
    _, _, times = mixing.solve({s: n / whole for s, n in totals.items() if n}, max_repeats, None, 1.0)
    out = []
    for s in totals:
        own = [(i, n, signed(k)) for i, z, n, k in held if z == s]
        repeat = times.get(s, 1.0)
        epochs = int(repeat + 1e-9)
        out += [(i, e) for i, _, _ in own for e in range(epochs)]
        left = max(0.0, (repeat - epochs) * totals[s])
        blocks = {}
        for i, n, k in own:
            blocks.setdefault(k % mixing.BLOCKS, []).append((i, n, k))
        for b in sorted(blocks, key=lambda b: (signed(spark_hash(b, mixing.SEED, epochs)), b)):
            size = sum(n for _, n, _ in blocks[b])
            if size < left:
                out += [(i, epochs) for i, _, _ in blocks[b]]
                left -= size
                continue
            for i, n, k in sorted(blocks[b], key=lambda x: (signed(spark_hash(("long", x[2]), epochs)), x[2])):
                if n > left:
                    break
                out.append((i, epochs))
                left -= n
            break
    return sorted(out)


def test_mix_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCKS", 13)
    rng = random.Random(5)
    rows = [(i, rng.choice(["big"] * 8 + ["mid", "mid", "small", None]), "w " * rng.randint(1, 60)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for most in (1.5, 2.0, 3.7):
        got = sorted((r["doc_id"], r["mix_epoch"]) for r in mixing.mix(docs, max_repeats=most).collect())
        assert got == brute_mix(rows, most)


def test_pipeline_keeps_what_its_stages_keep(spark):
    """The whole of ``run()``: who stays, how often, and what the token ids say."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    clean = {r["doc_id"]: r for r in toxicity.keep_clean(docs, labels).collect()}
    prints = {i: brute_fingerprint(r["text"] or "") for i, r in clean.items()}
    kept, group = set(), {}
    for i in sorted(prints):  # links join components, the smallest id of each stays
        todo = [i]
        if i in group:
            continue
        kept.add(i)
        while todo:
            j = todo.pop()
            if j not in group:
                group[j] = i
                todo += [k for k in prints if k not in group and (prints[j] ^ prints[k]).bit_count() <= 3]
    out = corpus_pipeline.run(spark, sf).collect()
    times = {}
    for r in out:
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert set(times) == kept and set(times.values()) <= {1, 2}
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    whole = 0
    for r in out:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert r["n_tokens"] == len(ids) and sp.decode(ids) == r["decoded"] and r["source"] == clean[r["doc_id"]]["source"]
        full = sp.encode(clean[r["doc_id"]]["text"] or "", add_bos=True, add_eos=True)
        whole += ids == full
        assert len(ids) <= len(full) + 50
    assert whole >= 0.5 * len(out)
    reads = docs.sparkSession.createDataFrame([(r["source"], 1) for r in out], "source string, n int").groupBy("source").agg(F.sum("n").alias("n"))
    assert reads.count() == len({clean[i]["source"] for i in kept})
