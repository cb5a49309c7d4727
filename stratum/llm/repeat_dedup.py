"""Removal of bytes covered by strings of ``LENGTH`` bytes that occur twice.

Every window of ``LENGTH`` bytes belongs to one anchor: the leftmost of its
``GRAM``-byte grams with the least hash.  Equal windows have equal anchors at equal
places, so windows need comparing only among occurrences of one anchor gram, with
the anchors laid over each other.  An occurrence owns a run of window starts.

Classes of equal strings are then expanded by length, breadth first, and a class
of one is dropped at each step:

1. the anchor grams (``GRAM`` bytes);
2. the whole contexts, i.e. all bytes of all windows an occurrence owns: where two
   are equal, all their windows repeat, and one of them stands for all below;
3. for each ``STEP`` window starts, the core that all of them contain (at least
   ``LENGTH - STEP`` bytes): where no other occurrence has it, none of them repeats;
   and all bytes of the windows together: where another has these, all repeat;
4. the windows themselves (``LENGTH`` bytes), only where step 3 left it open.

Each step is one aggregation of digests with map-side combine and one equi-join;
no class is ever gathered in a task, however many occurrences it has, and bytes
travel only for occurrences that step 2 left open.  Digests that decide have 128 bits.

Results: null is the empty text; texts under ``LENGTH`` bytes lose nothing.  A
repeated row (same id and text) occurs elsewhere, so it and its twin lose all that is
long enough.  Null ids are an id like others.  Texts of any length are taken whole,
in slabs of ``SLAB`` bytes.  An empty table gives an empty table.  Only id and text
are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import materialize, text_of

LENGTH = 400
GRAM = 32
STEP = 16
SLAB = 1 << 20
LEAST = -(1 << 63)
#: One pseudo-random number per byte value, and an odd factor.
NOISE = np.array([xxhash.xxh64_intdigest(bytes([b]), 7) for b in range(256)], np.uint64)
FACTOR = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each gram of ``GRAM`` bytes, by doubling."""
    h, span, factor = NOISE[data], 1, FACTOR
    while span < GRAM:
        h = h[:-span] * np.uint64(factor) + h[span:]
        span, factor = span * 2, factor * factor % (1 << 64)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    n = len(x) - width + 1
    size = -(-len(x) // width) * width
    padded = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(x)] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def anchors(raw: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slab: gram hash and place of each anchor, first and last window it owns."""
    for slab in range(0, max(len(raw) - LENGTH + 1, 0), SLAB):
        part = np.frombuffer(raw, np.uint8)[slab:slab + SLAB + LENGTH - 1]
        if len(part) < LENGTH:
            continue
        h = gram_hashes(part)
        packed = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        place = (window_minima(packed, LENGTH - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        last = np.concatenate([first[1:] - 1, [len(place) - 1]])
        at = place[first]
        yield h[at].view(np.int64), at + slab, first + slab, last + slab


def _digests(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(parts), "<i8").reshape(-1, 2)


def _anchor_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    digest = xxhash.xxh3_128_digest
    for batch in batches:
        rows: list[list] = [[] for _ in range(6)]
        contexts: list[bytes] = []
        for dk, th, text in zip(batch.dk, batch.th, batch.text, strict=True):
            raw = text.encode("utf-8")
            for gram, at, first, last in anchors(raw):
                contexts += [digest(raw[a:b + LENGTH], seed=p - a)
                             for p, a, b in zip(at.tolist(), first.tolist(), last.tolist(), strict=True)]
                for k, v in enumerate((np.full(len(at), dk), np.full(len(at), th), gram, at, first, last)):
                    rows[k].append(v)
                if len(contexts) > 50_000:
                    yield _anchor_frame(rows, contexts)
                    rows, contexts = [[] for _ in range(6)], []
        if contexts:
            yield _anchor_frame(rows, contexts)


def _anchor_frame(rows: list[list], contexts: list[bytes]) -> pd.DataFrame:
    d = _digests(contexts)
    cols = [np.concatenate(v) for v in rows]
    return pd.DataFrame({"dk": cols[0], "th": cols[1], "gram": cols[2], "at": cols[3], "first": cols[4],
                         "owned": cols[5] - cols[4], "hi": d[:, 0], "lo": d[:, 1]})


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts compressed for the shuffles."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        yield pd.DataFrame({"dk": batch.dk, "th": batch.th, "z": [press.compress(t.encode("utf-8")) for t in batch.text]})


def _open_contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of the occurrences that are still open."""
    unpress = zstandard.ZstdDecompressor()
    for batch in batches:
        for row in batch.itertuples():
            raw = unpress.decompress(row.z)
            open_ = sorted((int(x["first"]), int(x["at"]), int(x["owned"])) for x in row.open)
            for k in range(0, len(open_), 4096):
                part = open_[k:k + 4096]
                yield pd.DataFrame({"dk": row.dk, "th": row.th, "first": [x[0] for x in part], "at": [x[1] for x in part],
                                    "owned": [x[2] for x in part],
                                    "context": [raw[a:a + n + LENGTH] for a, _, n in part]})


def _step_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Core and whole of each ``STEP`` windows; s is how far the anchor is from a window's start."""
    core_of, whole_of = xxhash.xxh3_64_intdigest, xxhash.xxh3_128_digest
    for batch in batches:
        out, wholes = [], []
        for dk, th, first, at, owned, c in zip(batch.dk, batch.th, batch["first"], batch["at"], batch.owned, batch.context,
                                               strict=True):
            s_high, s_low = at - first, at - first - owned
            for j in range(s_low // STEP, s_high // STEP + 1):
                near, far = j * STEP, j * STEP + STEP - 1  # anchor offsets of the last and the first window
                a, b = max(at - far - first, 0), min(at - near - first, owned)  # owned windows, in the context
                core = core_of(c[at - near - first:at - far - first + LENGTH], seed=j)
                out.append((dk, th, first, j, core - (1 << 64) if core >> 63 else core, a, b))
                wholes.append(whole_of(c[a:b + LENGTH], seed=at - first - a))
        if out:
            frame = pd.DataFrame(out, columns=["dk", "th", "first", "j", "core", "a", "b"])
            d = _digests(wholes)
            yield frame.assign(hi=d[:, 0], lo=d[:, 1])


def _window_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    digest = xxhash.xxh3_128_digest
    for batch in batches:
        for lo in range(0, len(batch), 512):
            out, seen = [], []
            part = batch.iloc[lo:lo + 512]
            for dk, th, first, c, spans in zip(part.dk, part.th, part["first"], part.context, part.spans, strict=True):
                for span in spans:
                    for w in range(int(span["a"]), int(span["b"]) + 1):
                        out.append((dk, th, first + w))
                        seen.append(digest(c[w:w + LENGTH]))
            if out:
                d = _digests(seen)
                yield pd.DataFrame(out, columns=["dk", "th", "start"]).assign(hi=d[:, 0], lo=d[:, 1])


def _twice(df: DataFrame, key: list[str]) -> DataFrame:
    """The keys that more than one row has.

    Written first, so that the join that follows shuffles both sides for itself
    and can split the rows of a common key.  Never broadcast, as estimates take a
    text for one row.
    """
    keys = df.groupBy(*key).agg(F.count("*").alias("times")).filter("times > 1")
    return materialize(keys, "twice").hint("merge")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``(dk, th, spans)``: byte ranges of repeated windows in ``docs (dk, th, text)``."""
    at_doc = "dk long, th long, "
    found = docs.mapInPandas(_anchor_rows, at_doc + "gram long, at long, first long, owned long, hi long, lo long")
    # 1. anchor grams that occur twice
    kept = materialize(found.join(_twice(found, ["gram"]), "gram").drop("times"), "anchors")
    # 2. contexts: equal ones repeat whole; where a gram has several, one of each stays open
    contexts = materialize(kept.groupBy("hi", "lo", "gram").agg(
        F.count("*").alias("times"), F.min(F.struct("dk", "th", "first", "at", "owned")).alias("x")), "contexts")
    whole = kept.join(contexts.filter("times > 1").select("hi", "lo", "gram"), ["hi", "lo", "gram"]).select(
        "dk", "th", F.col("first").alias("start"), F.expr(f"first + owned + {LENGTH}").alias("end"))
    open_ = contexts.drop("times").join(_twice(contexts, ["gram"]), "gram").select("x.*").groupBy("dk", "th").agg(
        F.collect_list(F.struct("first", "at", "owned")).alias("open"))
    packed = docs.mapInPandas(_packed, at_doc + "z binary")
    rows = materialize(packed.join(open_, ["dk", "th"]).mapInPandas(
        _open_contexts, at_doc + "first long, at long, owned long, context binary"), "open")
    # 3. steps of windows
    steps = materialize(rows.mapInPandas(_step_rows, at_doc + "first long, j long, core long, a long, b long, hi long, lo long"),
                        "steps")
    both = steps.join(_twice(steps, ["core"]), "core").drop("times")
    wholes = _twice(steps, ["hi", "lo"])
    both = materialize(both.join(wholes, ["hi", "lo"], "left"), "shared-steps")
    stepped = both.filter("times is not null").select(
        "dk", "th", F.expr("first + a").alias("start"), F.expr(f"first + b + {LENGTH}").alias("end"))
    # 4. single windows; a step that repeats whole takes part once for all its copies, as a partner
    reps = both.filter("times is not null").groupBy("hi", "lo").agg(
        F.min(F.struct("dk", "th", "first", "a", "b")).alias("x"), F.first("core").alias("core"))
    undecided = both.filter("times is null").select("dk", "th", "first", "a", "b", "core")
    partners = reps.join(undecided.select("core").distinct(), "core", "left_semi").select("x.*")
    spans = undecided.select("dk", "th", "first", "a", "b").unionByName(partners).groupBy("dk", "th", "first").agg(
        F.collect_list(F.struct("a", "b")).alias("spans"))
    windows = rows.select("dk", "th", "first", "context").join(spans, ["dk", "th", "first"]).mapInPandas(
        _window_rows, at_doc + "start long, hi long, lo long")
    windows = materialize(windows, "windows")
    single = windows.join(_twice(windows, ["hi", "lo"]), ["hi", "lo"]).select(
        "dk", "th", "start", F.expr(f"start + {LENGTH}").alias("end"))
    return whole.unionByName(stepped).unionByName(single).groupBy("dk", "th").agg(
        F.collect_list(F.struct("start", "end")).alias("spans"))


def _kept(raw: bytes, spans) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed runs, and the bytes that stay."""
    runs: list[tuple[int, int]] = []
    for a, b in sorted((int(x["start"]), int(x["end"])) for x in spans):
        if runs and a <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], b))
        else:
            runs.append((a, b))
    keep = zip([0, *[b for _, b in runs]], [*[a for a, _ in runs], len(raw)], strict=True)
    return runs, b"".join(raw[a:b] for a, b in keep)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id_col, n_bytes, removed, kept)``: removed byte runs and the bytes that stay, per row."""
    docs = docs.select(F.col(id_col).cast("long").alias("dk0"), text_of(text).alias("text"))
    docs = docs.select(F.coalesce("dk0", F.lit(LEAST)).alias("dk"), F.xxhash64("text").alias("th"), "text")
    spans = repeated_spans(docs)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for lo in range(0, len(batch), 512):
                part, rows = batch.iloc[lo:lo + 512], []
                for dk, z, found in zip(part.dk, part.z, part.spans, strict=True):
                    raw = unpress.decompress(z)
                    runs, kept = _kept(raw, [] if found is None else found)
                    rows.append((dk, len(raw), [{"start": a, "end": b} for a, b in runs], kept))
                yield pd.DataFrame(rows, columns=["dk", "n_bytes", "removed", "kept"])

    out = docs.mapInPandas(_packed, "dk long, th long, z binary").join(spans, ["dk", "th"], "left").mapInPandas(
        cut, "dk long, n_bytes long, removed array<struct<start long, end long>>, kept binary")
    return out.select(F.nullif("dk", F.lit(LEAST)).alias(id_col), "n_bytes", "removed", "kept")


def digests(docs: DataFrame) -> DataFrame:
    out = remove_repeats(docs)
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
