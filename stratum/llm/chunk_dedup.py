"""Substring deduplication by content-defined chunks.

Texts are cut, as UTF-8 bytes, at those character starts where a gear rolling hash of
the ``WINDOW`` bytes before is the least within ``REACH`` bytes on both sides, at least
``MIN_CHUNK`` bytes after the last cut.  Equal hashes all count, so text with a short
period is cut at one phase wherever it begins.  Where no cut falls within
``MAX_CHUNK`` bytes, it is at the last least hash in them.  Cuts depend on nearby bytes
only, in texts without spaces too, so an insertion shifts no later chunk for long.  A
chunk is identified by its 128-bit digest.  The occurrence in the smallest
document id, and there the first, is the original; others are copies, in one text
those that begin ``MIN_RUN`` bytes or more after the first.  A run of
adjacent copies is extended byte by byte in both directions as far as the text
equals the original's, up to ``CONTEXT`` bytes, and removed if it then has at least
``MIN_RUN`` bytes or ``MIN_WORDS`` words, so that a short phrase that recurs by
chance stays.  A passage within which no whole chunk falls is not found.

One aggregation finds, for each digest, the smallest and largest id (two longs,
combined before the shuffle); one equi-join brings shared digests back to their
chunks, in which a common chunk's rows can be split freely; a document's copies
are gathered per document.  For the chunks at which a run begins or ends, the bytes
around the original chunk are read once per digest and joined to the copies by
digest.  Only the rows of shared chunks are stored; others are computed anew.

Results: null and empty texts have no chunks and stay (null becomes empty).  A
repeated row (same id and text) gets the same result as its twin.  Different texts
with one id keep what they share with each other.  Null ids count as the smallest
id.  Texts of any length are taken whole; a text may become empty.  An empty table
gives an empty table; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import materialize, text_of

WINDOW = 16
REACH = 32
MIN_CHUNK = 24
MAX_CHUNK = 512
MIN_RUN = 160
MIN_WORDS = 50
#: Bytes of the original that are compared before and after a run of copied chunks: those of the longest chunk and more.
CONTEXT = MAX_CHUNK + 4 * MIN_CHUNK
#: A chunk's place is one number: its start times this, plus its length.
PLACE = 1 << 10
LEAST = -(1 << 63)
#: One pseudo-random 16-bit number per byte value; the hash keeps 16 bits, so 16 bytes count.
GEAR = np.array([xxhash.xxh64_intdigest(bytes([b]), 1) & 0xFFFF for b in range(256)], np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte, by doubling the summed span."""
    h, span = GEAR[data], 1
    while span < WINDOW:
        h[span:] = h[span:] + (h[:-span] << np.uint16(span))
        span *= 2
    return h


def _least_near(h: np.ndarray) -> np.ndarray:
    """The least of each value and the ``REACH`` before it, by doubling."""
    m, span = h.copy(), 1
    while span <= REACH:
        step = min(span, REACH + 1 - span)
        m[step:] = np.minimum(m[step:], m[:-step])
        span += step
    return m


def cuts(raw: bytes) -> list[int]:
    """Ends of the chunks of a text; the last is its length."""
    n = len(raw)
    if n <= MIN_CHUNK:
        return [n] if n else []
    data = np.frombuffer(raw, np.uint8)
    # h[k] belongs to a cut before byte k + 1; characters are not cut
    h = gear(data)[:-1] * np.uint16(40503)
    starts = (data[1:] & 0xC0) != 0x80
    h[~starts] = 0xFFFF
    least = np.minimum(_least_near(h), _least_near(h[::-1])[::-1])
    out, last = [], 0
    for c in [*(np.flatnonzero((h == least) & starts) + 1).tolist(), n]:
        while c - last > MAX_CHUNK:
            # (the last of the least, so that periodic text is cut at one phase)
            part = h[last + MIN_CHUNK - 1:last + MAX_CHUNK][::-1]
            last += MAX_CHUNK - int(np.argmin(part))
            out.append(last)
        if c - last >= MIN_CHUNK and c < n:
            out.append(c)
            last = c
    return [*out, n]


def chunks(raw: bytes) -> tuple[list[int], list[int], list[bytes]]:
    """Starts, ends and digests of the chunks."""
    ends = cuts(raw)
    starts = [0, *ends[:-1]][:len(ends)]
    digest = xxhash.xxh3_128_digest
    return starts, ends, [digest(raw[a:b]) for a, b in zip(starts, ends, strict=True)]


def _chunk_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first occurrence of each chunk of a text; tails under MIN_CHUNK are no copies."""
    for batch in batches:
        for lo in range(0, len(batch), 256):
            part, ids, ths, at, seen = batch.iloc[lo:lo + 256], [], [], [], []
            for dk, th, text in zip(part.dk, part.th, part.text, strict=True):
                starts, ends, digests = chunks(text.encode("utf-8"))
                if ends and ends[-1] - starts[-1] < MIN_CHUNK:
                    starts, digests = starts[:-1], digests[:-1]
                places = [a * PLACE + b - a for a, b in zip(starts, ends, strict=False)]
                first = dict(zip(reversed(digests), reversed(places), strict=True))
                ids += [dk] * len(first)
                ths += [th] * len(first)
                at += first.values()
                seen += first.keys()
            both = np.frombuffer(b"".join(seen), "<i8").reshape(-1, 2)
            yield pd.DataFrame({"dk": np.array(ids, np.int64), "th": np.array(ths, np.int64),
                                "at": np.array(at, np.int64), "hi": both[:, 0], "lo": both[:, 1]})


def _context_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes before and after the wanted chunks of the originals."""
    for batch in batches:
        for text, wanted in zip(batch.text, batch.wanted, strict=True):
            raw = text.encode("utf-8")
            for k in range(0, len(wanted), 4096):
                rows = []
                for x in wanted[k:k + 4096]:
                    a, n = divmod(int(x["at"]), PLACE)
                    rows.append((x["hi"], x["lo"], raw[max(0, a - CONTEXT):a] if x["left"] else b"",
                                 raw[a + n:a + n + CONTEXT] if x["right"] else b""))
                yield pd.DataFrame(rows, columns=["hi", "lo", "before", "after"])


def _alike(x: bytes, y: bytes) -> int:
    """How many bytes two strings share at their starts."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    return int(np.argmax(np.frombuffer(x, np.uint8, n) != np.frombuffer(y, np.uint8, n)))


def _ranges(raw: bytes, copied: set[int], contexts: dict[int, tuple[bytes, bytes]]) -> list[tuple[int, int]]:
    """The byte ranges to remove, given the starts of the chunks that other texts hold first.

    Each run of copied chunks is extended as far as the text equals the original's,
    whose bytes around the run's first and last chunk are in ``contexts``; for a
    repeat in the text itself the bytes around the first occurrence count.
    """
    out: list[tuple[int, int]] = []
    first: dict[bytes, tuple[int, int]] = {}
    starts, ends, digests = chunks(raw)
    for a, b, digest, following in zip(starts, ends, digests, [*digests[1:], b""], strict=False):
        q, end = first.setdefault(digest, (a, b))
        again = b - a >= MIN_CHUNK and a - q >= MIN_RUN
        if not (again or (q in copied and b - a == end - q)):
            continue
        before, after = contexts.get(q, (b"", b""))
        back = _alike(raw[max(0, a - CONTEXT):a][::-1], before[::-1])
        ahead = _alike(raw[b:b + CONTEXT], after)
        if q in copied and following == digest:  # a period: the original's may begin earlier or later
            back = max(back, _alike(raw[max(0, a - CONTEXT):a][::-1], raw[max(0, b - CONTEXT):b][::-1]))
        if again:
            back = max(back, _alike(raw[max(end, q + MIN_RUN, a - CONTEXT):a][::-1], raw[max(0, q - CONTEXT):q][::-1]))
            ahead = max(ahead, _alike(raw[b:b + CONTEXT], raw[end:end + CONTEXT]))
        a, b = a - back, b + ahead
        while raw[a] & 0xC0 == 0x80:
            a += 1
        while b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        while out and out[-1][1] >= a:
            a, b = min(a, out[-1][0]), max(b, out.pop()[1])
        out.append((a, b))
    return [(a, b) for a, b in out if b - a >= MIN_RUN or len(raw[a:b].split()) >= MIN_WORDS]


def copied_chunks(docs: DataFrame) -> DataFrame:
    """``(dk, th, copied, contexts)``: starts of the chunks of each text that a smaller id holds.

    ``contexts`` are the original's bytes around the chunks at which a run of copies begins or ends.
    """
    rows = docs.select("dk", "th", "text").mapInPandas(_chunk_rows, "dk long, th long, at long, hi long, lo long")
    shared = rows.groupBy("hi", "lo").agg(F.min("dk").alias("low"), F.max("dk").alias("high")).filter("high > low")
    # (estimates take a text for one row, so a broadcast is ruled out)
    held = materialize(rows.join(shared.select("hi", "lo", "low").hint("merge"), ["hi", "lo"]), "shared-chunks")
    runs = held.filter("dk > low").groupBy("dk", "th").agg(
        F.array_sort(F.collect_set(F.struct("at", "hi", "lo"))).alias("x"))
    runs = materialize(runs, "copied-chunks")
    edges = runs.selectExpr("dk", "th", f"""explode(filter(transform(x, (c, i) -> struct(c.at, c.hi, c.lo,
        i = 0 or x[greatest(i - 1, 0)].at div {PLACE} + x[greatest(i - 1, 0)].at % {PLACE} <> c.at div {PLACE} as left,
        i = size(x) - 1 or x[least(i + 1, size(x) - 1)].at div {PLACE} <> c.at div {PLACE} + c.at % {PLACE} as right)),
        c -> c.left or c.right)) as c""").select("dk", "th", "c.*")
    wanted = edges.groupBy("hi", "lo").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    first = held.filter("dk = low").groupBy("hi", "lo").agg(F.min(F.struct("dk", "th", "at")).alias("o"))
    wanted = first.join(wanted.hint("merge"), ["hi", "lo"]).select("o.*", "hi", "lo", "left", "right").groupBy("dk", "th").agg(
        F.collect_list(F.struct("at", "hi", "lo", "left", "right")).alias("wanted"))
    around = docs.join(wanted.hint("merge"), ["dk", "th"]).select("text", "wanted").mapInPandas(
        _context_rows, "hi long, lo long, before binary, after binary")
    # written, so that the join that follows shuffles both sides for itself and can split a common chunk's rows
    around = materialize(around.dropDuplicates(["hi", "lo"]), "contexts")
    found = edges.join(around.hint("merge"), ["hi", "lo"]).groupBy("dk", "th").agg(F.collect_list(F.struct(
        F.expr(f"at div {PLACE}").alias("at"), F.when(F.col("left"), F.col("before")).alias("before"),
        F.when(F.col("right"), F.col("after")).alias("after"))).alias("contexts"))
    return runs.selectExpr("dk", "th", f"transform(x, c -> c.at div {PLACE}) as copied").join(
        found.hint("merge"), ["dk", "th"], "left")


def remove_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", removed: str | None = "removed") -> DataFrame:
    """Put the kept text into ``text`` and add the removed byte ranges as the column ``removed``, if named.

    The caller's columns have names of their own meanwhile, so any others are allowed.
    """
    names = docs.columns
    if removed in names:
        raise ValueError(f"rename the column {removed} first, or give another name or None")
    own = [f"c{k}" for k in range(len(names))]
    id_own, text_own = own[names.index(id_col)], own[names.index(text)]
    held = docs.toDF(*own).withColumns({"dk": F.coalesce(F.col(id_own).cast("long"), F.lit(LEAST)),
                                        "th": F.xxhash64(text_of(text_own))})
    found = copied_chunks(held.select("dk", "th", text_of(text_own).alias("text")))

    @F.pandas_udf("struct<text string, removed array<struct<start long, end long>>>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, starts, around in batches:
            rows = []
            for t, copied, contexts in zip(texts, starts, around, strict=True):
                raw = t.encode("utf-8")
                near = {} if contexts is None else {int(x["at"]): (x["before"] or b"", x["after"] or b"") for x in contexts}
                gone = _ranges(raw, set() if copied is None else set(copied.tolist()), near)
                keep = zip([0, *[b for _, b in gone]], [*[a for a, _ in gone], len(raw)], strict=True)
                rows.append((b"".join(raw[a:b] for a, b in keep).decode("utf-8") if gone else t, gone))
            yield pd.DataFrame(rows, columns=["text", "removed"])

    out = held.join(found, ["dk", "th"], "left").withColumn("__cut", cut(text_of(text_own), F.col("copied"), F.col("contexts")))
    kept = [F.col("__cut.text" if c == text_own else c).alias(name) for c, name in zip(own, names, strict=True)]
    return out.select(*kept, *([F.col("__cut.removed").alias(removed)] if removed else []))


def digests(docs: DataFrame) -> DataFrame:
    """Bytes, removed bytes and spans, and the digest of the kept text, per document."""
    out = remove_copies(docs.select("doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"])
    return out.select("doc_id", (F.octet_length("text") + gone).cast("long").alias("n_bytes"), gone.alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"),
                      F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
