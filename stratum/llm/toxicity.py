"""Toxicity by maximum-scoring segments of token log-odds.

Learning counts the tokens of toxic and of clean labelled texts and takes, for
each token, the log-odds of the two rates with an informative Dirichlet prior
(the pooled counts, weighted by ``PRIOR``) and its standard error.  Repeated
training texts count once.  Tokens whose
log-odds lie over ``MIN_Z`` errors above zero get it as their score; all others
score ``-GAP``, so that the expected score of a token is negative.

Scoring finds all maximal-scoring segments of a text in one linear scan.  A
segment's score S in a text of n tokens is judged by the extreme-value law of
the best segment of a clean text: x = lambda S - ln n follows a Gumbel law, whose
place and width are fitted on the clean training texts, lambda solving
E[exp(lambda s)] = 1 over their tokens.  The passages whose p-value is at most
``PASSAGE_P`` are the toxic passages.  A text's evidence is the sum of -ln p over
them; a logistic fit of its logarithm on the training texts gives the score.

The model is fitted on a sample of at most about ``TRAIN_ROWS`` labelled rows and
``TRAIN_CHARS`` characters.  That bounds it too: a token needs a dozen toxic
occurrences to be significant.  So it can be sent to every task; all texts are scored
whole.  Occurrences are counted by Spark; the driver gets the counts of distinct
scores, sums, and one number per training text.

Results: null and empty texts and texts without a toxic token have no passage
and the lowest score.  Rows are scored one by one, repeated rows and null ids
included; ids or labels that are null, and labelled ids without a text, teach
nothing; if no toxic or no clean row is left to learn from, every score is the
share of toxic rows (0 without any).  An empty table of documents, or of labels,
gives an empty result, or these scores.  Only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import materialize, text_of, unused, within_share
from stratum.llm.labelled import bounded, held_out

TRAIN_ROWS = 20_000
TRAIN_CHARS = 200_000_000
PRIOR = 0.1
MIN_Z = 3.5
GAP = 0.1
PASSAGE_P = 0.01
TOKEN = re.compile(r"[^\W_]+")


@dataclass
class Model:
    """Token scores, extreme-value law and calibration."""

    scores: dict[str, float]
    scale: float = 1.0  # lambda
    place: float = 0.0
    width: float = 1.0
    slope: float = 0.0
    offset: float = 0.0

    def surprise(self, score: float, n: int) -> float:
        """-ln of the chance that a clean text of n tokens has such a segment."""
        y = (self.scale * score - math.log(max(n, 1)) - self.place) / self.width
        if y > 30:
            return y
        return -math.log(max(-math.expm1(-math.exp(-max(y, -30.0))), 1e-300))


def segments(hits: list[tuple[int, float]], gap: float = GAP) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(first, last, score)`` of a token sequence.

    ``hits`` has position and score of the positive tokens; all others score
    ``-gap``.  Linear in the hits: each candidate keeps the cumulative scores at
    its two ends, and is merged with the nearest earlier one that starts lower
    if that one ends lower too.
    """
    found: list[list] = []  # first, last, cumulative before, cumulative after, index of the nearest lower start
    total, at = 0.0, -1
    for pos, score in hits:
        total -= gap * (pos - at - 1)
        now = [pos, pos, total, total + score, -1]
        total, at = total + score, pos
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= now[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= now[3]:
                now[4] = j
                found.append(now)
                break
            now = [found[j][0], now[1], found[j][2], now[3], -1]
            del found[j:]
    return [(a, b, hi - lo) for a, b, lo, hi, _ in found]


def token_segments(text: str, scores: dict[str, float]) -> tuple[int, list[tuple[int, int, float]]]:
    tokens = TOKEN.findall(text.lower())
    return len(tokens), segments([(i, scores[t]) for i, t in enumerate(tokens) if t in scores])


def assess(text: str, model: Model) -> tuple[float, list[tuple[int, int, float]]]:
    """Probability and toxic passages (first character, end, -ln p) of a text."""
    n, found = token_segments(text, model.scores)
    kept = [(a, b, s) for a, b, score in found if (s := model.surprise(score, n)) >= -math.log(PASSAGE_P)]
    z = model.offset + model.slope * math.log1p(sum(s for _, _, s in kept))
    p = 1 / (1 + math.exp(-max(min(z, 500.0), -500.0)))
    if not kept:
        return p, []
    low = text.lower()
    if len(low) != len(text):  # offsets are those of the lower-cased text where lengths differ
        text = low
    spans = [m.span() for m in TOKEN.finditer(low)]
    return p, [(spans[a][0], spans[b][1], s) for a, b, s in kept]


def token_scores(train: DataFrame) -> dict[str, float]:
    """Significant log-odds of the tokens of ``train (text, label)``."""
    words = train.select("label", F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")).alias("w")).filter("w <> ''")
    n = {r["label"]: r["n"] for r in words.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return {}
    counts = words.groupBy("w").agg(F.sum("label").cast("double").alias("t"),
                                    F.sum(1 - F.col("label")).cast("double").alias("c"))
    prior = F.lit(PRIOR) * (F.col("t") + F.col("c"))
    t, c, strength = F.col("t") + prior, F.col("c") + prior, PRIOR * (n[0] + n[1])
    delta = F.log(t / (n[1] + strength - t)) - F.log(c / (n[0] + strength - c))
    rated = counts.select("w", delta.alias("d"), (delta / F.sqrt(1 / t + 1 / c)).alias("z"))
    return {r["w"]: r["d"] for r in rated.filter(F.col("z") >= MIN_Z).select("w", "d").collect()}


def _fit_scale(rates: list[tuple[float, float]]) -> float:
    """The positive root of sum p exp(x s) = 1 over (s, p), for a negative mean."""
    excess = lambda x: sum(p * math.exp(x * s) for s, p in rates) - 1
    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return max(low, 1e-3)


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps of bounded length, with a small ridge."""
    design, w = np.stack([x, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + 1e-2 * w
        hess = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        w -= np.clip(np.linalg.solve(hess, grad), -1, 1)
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on a bounded sample of ``labels (doc_id, label)`` joined to ``docs (doc_id, text)``."""
    ids = labels.filter("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    train = materialize(docs.select("doc_id", text_of().alias("text")).join(
        F.broadcast(bounded(ids, train_rows)), "doc_id").select("text", "label").distinct(), "toxic-train")
    chars = train.agg(F.sum(F.char_length("text"))).first()[0] or 0
    if chars > TRAIN_CHARS:
        train = train.filter(within_share(F.xxhash64("text", F.lit(23)), TRAIN_CHARS / chars))
    scores = token_scores(train)
    n = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not scores or len(n) < 2:
        p = min(max(n.get(1, 0) / max(sum(n.values()), 1), 1e-6), 1 - 1e-6)
        return Model({}, offset=math.log(p / (1 - p)))

    @F.pandas_udf("struct<n long, segments array<double>, hits array<double>>")
    def stats(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            tokens = TOKEN.findall(t.lower())
            hits = [(i, scores[w]) for i, w in enumerate(tokens) if w in scores]
            rows.append((len(tokens), [s for *_, s in segments(hits)], [s for _, s in hits]))
        return pd.DataFrame(rows, columns=["n", "segments", "hits"])

    seen = materialize(train.select("label", stats("text").alias("s")).select("label", "s.*"), "toxic-stats")
    clean = seen.filter("label = 0")
    total = float(clean.agg(F.sum("n")).first()[0] or 1)
    hits = clean.select(F.explode("hits").alias("s")).groupBy(F.round("s", 3).alias("s")).agg(F.count("*").alias("n")).orderBy("s").collect()
    rates = [(r["s"], r["n"] / total) for r in hits]
    if not rates:  # a token that no clean text has is as rare as half an occurrence
        rates = [(sum(scores.values()) / len(scores), 0.5 / total)]
    rates.append((-GAP, 1 - sum(p for _, p in rates)))
    model = Model(scores, _fit_scale(rates))
    best = F.coalesce(F.array_max("segments"), F.lit(0.0))
    x = model.scale * best - F.log(F.greatest(F.col("n"), F.lit(1)).cast("double"))
    law = clean.agg(F.avg(x).alias("mean"), F.stddev_pop(x).alias("sd")).first()
    model.width = max(law["sd"] * math.sqrt(6) / math.pi, 1e-3)
    model.place = law["mean"] - 0.5772156649015329 * model.width
    limit = -math.log(PASSAGE_P)

    @F.pandas_udf("double")
    def evidence(ns: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([sum(v for b in own if (v := model.surprise(b, n)) >= limit) for n, own in zip(ns, found, strict=True)], dtype=float)

    judged = seen.select("label", evidence("n", "segments").alias("e")).toPandas()  # two numbers a training text
    judged = judged.sort_values(["e", "label"])
    model.slope, model.offset = _fit_logistic(np.log1p(judged.e.to_numpy(float)), judged.label.to_numpy(float))
    return model


_SCORED = "struct<score double, passages array<struct<start int, end int, surprise double>>>"


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """Add ``out``: the score and the passages of every row."""

    @F.pandas_udf(_SCORED)
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([assess(t, model) for t in texts], columns=["score", "passages"])

    return docs.withColumn(out, rate(text_of(text)))


def train_labels(labels: DataFrame) -> DataFrame:
    """The labels outside the held-out fifth."""
    return labels.filter(~held_out(F.col("doc_id"), 5, 0)).select("doc_id", F.col("toxic").alias("label"))


def digests(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, train_labels(labels))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"),
                         F.col("toxicity.score").alias("score"),
                         (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
                         F.size("toxicity.passages").alias("n_passages"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score is below one half."""
    model, out = fit(docs, train_labels(labels)), unused("__toxicity", docs.columns)
    return score(docs, model, out=out).filter(F.col(out)["score"] < 0.5).select([F.col(f"`{c}`") for c in docs.columns])
