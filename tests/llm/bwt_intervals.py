"""Repeated strings of one block of text by interval expansion on its Burrows-Wheeler transform.

The method op7 was dealt, for a text that fits one task; the tests hold the
operator's results against it, and ``python tests/llm/bwt_intervals.py FILE``
measures what it costs.
"""

from __future__ import annotations

import sys
import time

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by at least their first ``depth`` symbols (prefix doubling); symbols are all over 0."""
    n, rank, span = len(text), text.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while True:
        second = np.zeros(n, np.int64)
        second[:n - span] = rank[span:] + 1
        key = rank * (second.max() + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
        rank = np.empty(n, np.int64)
        rank[order] = new
        span *= 2
        if span >= depth or new[-1] == n - 1:
            return order


def long_prefixes(text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order, and whether each suffix shares ``least`` symbols with the one before it.

    Breadth first over intervals of equal prefixes: an interval of length l is extended backward by every
    symbol before its suffixes; a boundary that no shorter prefix has set has common prefix l.  Boundaries
    still unset when l reaches ``least`` are those of repeated strings.
    """
    n = len(text)
    order = suffix_order(text, least)
    bwt = text[order - 1]
    counts = np.bincount(bwt, minlength=int(text.max()) + 1)
    starts = np.cumsum(counts) - counts
    by_symbol = np.argsort(bwt, kind="stable")
    last_first = np.empty(n, np.int64)  # where the suffix one symbol longer stands
    last_first[by_symbol] = np.arange(n)
    unset = np.ones(n + 1, bool)
    unset[0] = unset[n] = False
    lows, highs = np.array([0]), np.array([n])
    for _ in range(least):
        sizes = highs - lows
        rows = np.repeat(lows - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        interval = np.repeat(np.arange(len(lows)), sizes)
        # the extensions of an interval by one symbol are consecutive places
        places, symbols = last_first[rows], bwt[rows]
        at = np.lexsort((places, symbols, interval))
        places, symbols, interval = places[at], symbols[at], interval[at]
        first = np.concatenate([[True], (symbols[1:] != symbols[:-1]) | (interval[1:] != interval[:-1])]) if len(at) else np.zeros(0, bool)
        cut = np.flatnonzero(first)
        lows, highs = places[cut], places[np.concatenate([cut[1:], [len(at)]]) - 1] + 1 if len(at) else places[:0]
        new = unset[highs]
        lows, highs = lows[new], highs[new]
        unset[highs] = False
        if not len(lows):
            break
    del starts
    return order, unset[:n]


def repeated_starts(texts: list[bytes], least: int) -> list[np.ndarray]:
    """Of every text, where a string of ``least`` bytes starts that also starts elsewhere, in it or in another text."""
    parts, owners = [], []
    for k, t in enumerate(texts):
        parts += [np.frombuffer(t, np.uint8).astype(np.int64) + len(texts) + 1, [k + 1]]  # an end of its own
        owners.append(len(t) + 1)
    text = np.concatenate(parts).astype(np.int64)
    order, shared = long_prefixes(text, least)
    repeated = shared | np.concatenate([shared[1:], [False]])
    marks = np.zeros(len(text), bool)
    marks[order] = repeated
    ends = np.cumsum(owners)
    return [np.flatnonzero(marks[e - n:e - 1]) for e, n in zip(ends, owners, strict=True)]


if __name__ == "__main__":
    import pyarrow.parquet as pq

    held, size = [], 0
    for t in pq.read_table(sys.argv[1], columns=["text"]).column("text").to_pylist():
        if size >= float(sys.argv[2]) * 1e6:
            break
        held.append((t or "").encode())
        size += len(held[-1])
    t0 = time.process_time()
    found = repeated_starts(held, 400)
    sec = time.process_time() - t0
    print(f"{size / 1e6:.1f} MB, {sum(map(len, found))} repeated starts, {sec:.1f} CPU s, {sec / size * 1e6:.1f} a MB")
