"""Quality classifier by positive-unlabelled learning.

Trusted positives are texts labelled good; the unlabelled set is a sample of all
texts, whatever their labels.  Both are turned into ``FEATURES`` statistics of the
whole text.  The class prior is estimated from a first classifier of positive
against unlabelled: the share of unlabelled texts under a score threshold, over the
same share of positives held back from it, at the threshold whose upper confidence
bound is least.  A small network then minimises the non-negative unbiased risk
    prior * E_p[loss(+)] + max(0, E_u[loss(-)] - prior * E_p[loss(-)])
with the logistic loss, so its output estimates the chance of a good text.

At most about ``TRAIN_ROWS`` positives and as many unlabelled rows are used to
fit; all texts are scored whole.

Results: null and empty texts have the statistics of an empty text and are scored
by them.  Rows are scored one by one, repeated rows and null ids included; null
ids and labels teach nothing; without positives or unlabelled rows every score is
one half.  Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import text_of
from stratum.llm.labelled import bounded, held_out

TRAIN_ROWS = 20_000
HIDDEN = 24
STEPS = 1500
BATCH = 512
FEATURES = ("log_chars", "log_words", "word_length", "word_spread", "long_words", "upper", "title_words", "digits", "marks",
            "bangs", "dots_commas", "symbols", "beyond_ascii", "distinct_words", "top_word", "repeats_next", "log_lines",
            "line_length", "distinct_lines", "short_lines", "top_line", "deflated", "entropy", "space", "distinct_pairs")


def features(text: str) -> list[float]:
    """The statistics of one text."""
    n, words = max(len(text), 1), text.split()
    m = max(len(words), 1)
    sizes = np.array([len(w) for w in words] or [0], float)
    chars = Counter(text)
    count = lambda test: sum(c for k, c in chars.items() if test(k))
    seen = Counter(words)
    pairs = set(zip(words, words[1:], strict=False))
    lines = [x.strip() for x in text.split("\n") if x.strip()]
    k = max(len(lines), 1)
    top_line = Counter(lines).most_common(1)
    data = text.encode("utf-8")
    share = np.array(list(chars.values()) or [1], float) / n
    letters = max(count(str.isalpha), 1)
    return [
        np.log1p(len(text)), np.log1p(len(words)), sizes.mean(), sizes.std(), float((sizes > 12).mean()),
        count(str.isupper) / letters, sum(w[0].isupper() for w in words) / m, count(str.isdigit) / n,
        count(lambda c: not c.isalnum() and not c.isspace()) / n, chars["!"] / n, (chars["."] + chars[","]) / m,
        count(lambda c: c in "#$%&*+/<=>@[\\]^_`{|}~") / n, count(lambda c: ord(c) > 127) / n, len(seen) / m,
        (max(seen.values()) if seen else 0) / m, sum(a == b for a, b in zip(words, words[1:], strict=False)) / m,
        np.log1p(len(lines)), np.log1p(len(text) / k), len(set(lines)) / k, sum(len(x) < 20 for x in lines) / k,
        (top_line[0][1] if top_line else 0) / k, len(zlib.compress(data, 1)) / max(len(data), 1),
        float(-(share * np.log(share)).sum()), count(str.isspace) / n, len(pairs) / m]


def _forward(net, x):
    h = np.tanh(x @ net[0] + net[1])
    return h, h @ net[2] + net[3]


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(pos: np.ndarray, unl: np.ndarray, prior: float | None, seed: int = 5) -> list[np.ndarray]:
    """A network by Adam; with ``prior`` the non-negative risk, else positive against unlabelled."""
    rng = np.random.default_rng(seed)
    d = pos.shape[1]
    net = [rng.normal(0, d ** -0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(())]
    m, v = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net]
    for step in range(1, STEPS + 1):
        p, u = pos[rng.integers(len(pos), size=BATCH)], unl[rng.integers(len(unl), size=BATCH)]
        x = np.concatenate([p, u])
        h, z = _forward(net, x)
        s = _sigmoid(z)  # d loss(+) = s - 1, d loss(-) = s
        g = np.empty_like(z)
        if prior is None:
            g[:BATCH], g[BATCH:] = (s[:BATCH] - 1) / BATCH, s[BATCH:] / BATCH
        else:
            lose = np.logaddexp(0, np.clip(z, -30, 30))  # loss(-)
            negative = lose[BATCH:].mean() - prior * lose[:BATCH].mean()
            if negative >= 0:
                g[:BATCH] = prior * (s[:BATCH] - 1 - s[:BATCH]) / BATCH
                g[BATCH:] = s[BATCH:] / BATCH
            else:  # step back from a negative risk of the negatives
                g[:BATCH], g[BATCH:] = prior * s[:BATCH] / BATCH, -s[BATCH:] / BATCH
        back = np.outer(g, net[2]) * (1 - h * h)
        grads = [x.T @ back + 1e-4 * net[0], back.sum(0), h.T @ g + 1e-4 * net[2], g.sum()]
        rate = 0.01 * (1 - step / (STEPS + 1))
        for k, q in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * q
            v[k] = 0.999 * v[k] + 0.001 * q * q
            net[k] = net[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return net


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """The share of positives among the unlabelled, by the best top bin."""
    half = len(pos) // 2
    net = train(pos[:half], unl[: len(unl) // 2], None)
    p, u = np.sort(_forward(net, pos[half:])[1])[::-1], np.sort(_forward(net, unl[len(unl) // 2:])[1])[::-1]
    best, least = 1.0, np.inf
    for share in np.linspace(0.02, 1, 99):
        cut = p[min(int(share * len(p)), len(p) - 1)]
        fp, fu = np.searchsorted(-p, -cut, "right") / len(p), np.searchsorted(-u, -cut, "right") / len(u)
        slack = np.sqrt(np.log(20) / 2 / len(u)) + np.sqrt(np.log(20) / 2 / len(p))
        if (fu + slack) / fp < least:
            best, least = fu / fp, (fu + slack) / fp
    return float(np.clip(best, 0.02, 0.98))


class Scorer:
    """The fitted classifier; without training data it answers one half."""

    def __init__(self, pos: np.ndarray, unl: np.ndarray):
        self.net = None
        if len(pos) >= 4 and len(unl) >= 4:
            self.mean, self.spread = unl.mean(0), unl.std(0) + 1e-6
            pos, unl = self._scaled(pos), self._scaled(unl)
            self.prior = estimate_prior(pos, unl)
            self.net = train(pos, unl, self.prior)

    def _scaled(self, x):
        return np.clip((x - self.mean) / self.spread, -6, 6)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), 0.5) if self.net is None else _sigmoid(_forward(self.net, self._scaled(x))[1])


def fit(docs: DataFrame, positives: DataFrame, unlabelled: DataFrame, train_rows: int = TRAIN_ROWS) -> Scorer:
    """Fit on bounded samples of the ids in ``positives`` and ``unlabelled``."""
    statistics = F.pandas_udf(lambda texts: texts.map(features), "array<double>")
    picked = [bounded(ids.filter("doc_id is not null").select("doc_id").distinct(), train_rows).withColumn("p", F.lit(k))
              for ids, k in ((positives, 1), (unlabelled, 0))]
    ids = picked[0].unionByName(picked[1]).groupBy("doc_id").agg(F.max("p").alias("pos"), F.min("p").alias("p"))
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(ids), "doc_id").select(
        "doc_id", "pos", "p", statistics("text").alias("x")).toPandas().sort_values(["doc_id", "pos"], kind="stable")
    rows = rows.sample(frac=1, random_state=7)
    both = lambda part: np.array(part.x.tolist(), float).reshape(len(part), len(FEATURES))
    return Scorer(both(rows[rows.pos == 1]), both(rows[rows.p == 0]))


def score(docs: DataFrame, scorer: Scorer, text: str = "text") -> DataFrame:
    """Add ``quality``, the chance of a good text, to every row."""

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([features(t) for t in texts], float).reshape(len(texts), len(FEATURES))
            yield pd.Series(scorer(x))

    return docs.withColumn("quality", rate(text_of(text)))


def digests(docs: DataFrame, labels: DataFrame) -> DataFrame:
    side = held_out(F.col("doc_id"), 3, 1)
    scorer = fit(docs, labels.filter(~side & (F.col("quality") == 1)), docs.filter(~side))
    return score(docs.select("doc_id", "text"), scorer).select(
        "doc_id", side.alias("held_out"), F.col("quality").alias("score"),
        (F.col("quality") >= 0.5).cast("int").alias("predicted"))
