"""Quality by positive-unlabelled learning.

Trusted positives and unlabelled web text, both bounded samples, train a logistic model on whole-text statistics by
minimising the non-negative unbiased risk: prior * R+ (positives) + max(0, R- (unlabelled) - prior * R- (positives)).
The class prior is estimated from scores of held-back positives and unlabelled rows; labels of bad documents are not used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, map_texts
from .quality_rules import repeated_words
from .samples import bounded_sample, one_text_each, sampled_texts

#: Positives and unlabelled documents that are fitted on, at most.
POSITIVES, UNLABELLED = 4000, 8000
ROUNDS, RATE, DECAY = 600, 0.03, 1e-4
CUT = 0.3
_SYMBOLS = b"|#*$%&!<>=~^_@{}[]\\/"


def features_of(text: str | None) -> list[float]:
    """Statistics of a whole text; all zero but the first for one without words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [1.0] + [0.0] * (_SIZE - 1)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = max(1, int(hist.sum() - hist[[32, 9, 10, 11, 12, 13]].sum()))
    upper, lower, digit = hist[65:91].sum() / chars, hist[97:123].sum() / chars, hist[48:58].sum() / chars
    marks = [hist[c] / n for c in b".,;:'\"-()?"]
    odd = [hist[c] / n for c in _SYMBOLS]
    p = hist[hist > 0] / len(raw)
    distinct = len(set(words))
    same = sum(a == b for a, b in zip(words, words[1:])) / n
    caps = sum(w.isupper() for w in words) / n
    alone = sum(len(w) == 1 for w in words) / n
    lines = [x for x in raw.split(b"\n") if x.strip()]
    base = [upper, digit, sum(odd), same, caps, alone, repeated_words(words) / n, 1 - len(set(lines)) / len(lines), *marks, *odd]
    return [0.0, np.log(n), np.log(chars / n), lower, -float((p * np.log(p)).sum()), distinct / n, np.log(distinct) / max(np.log(n), 0.7), *base, *np.sqrt(base)]


_SIZE = 7 + 2 * (8 + 10 + len(_SYMBOLS))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -4, 4) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = ROUNDS) -> Model:
    """Full-batch Adam on the non-negative risk with logistic loss; deterministic."""
    everything = np.concatenate([positive, unlabelled])
    model = Model(everything.mean(axis=0), np.maximum(everything.std(axis=0), 1e-3), np.zeros(everything.shape[1]), 0.0, prior)
    xp, xu = (np.hstack([np.clip((x - model.mean) / model.scale, -4, 4), np.ones((len(x), 1))]) for x in (positive, unlabelled))
    w, m, v = np.zeros(xp.shape[1]), 0.0, 0.0
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for t in range(1, rounds + 1):
        p, u = sigmoid(xp @ w), sigmoid(xu @ w)
        negative = -np.log1p(-np.minimum(u, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(p, 1 - 1e-12)).mean()
        of_positive, of_negative = prior * xp.T @ (p - 1) / len(xp), xu.T @ u / len(xu) - prior * xp.T @ p / len(xp)
        # below zero, the step undoes the overfit of the negative part instead
        g = of_positive + of_negative if negative >= 0 else -of_negative
        g[:-1] += DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    model.weights, model.bias = w[:-1], float(w[-1])
    return model


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, sure: float = 0.1) -> float:
    """Share of positives among unlabelled rows, from the scores of rows that the scorer was not fitted on (best bin estimation).

    Above a cut lie a share u of the unlabelled and p of the positives; u / p bounds the prior from above, as all that lies
    there might be positive. The least bound counts, at the cut where sampling errors (at confidence 1 - sure) matter least.
    """
    cuts = np.unique(np.quantile(positive, np.linspace(0.0, 0.95, 96)))
    p, u = ((x[:, None] >= cuts).mean(axis=0) for x in (positive, unlabelled))
    error = sum(math.sqrt(math.log(4 / sure) / (2 * len(x))) for x in (positive, unlabelled))
    best = int(np.argmin((u + error) / p))
    return float(min(1.0, u[best] / p[best]))


def halves(rows: np.ndarray, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of rows at random, the same on every run: neighbours in the order of ids may be alike."""
    order = np.random.default_rng(seed).permutation(len(rows))
    return rows[order[::2]], rows[order[1::2]]


def fit_with_prior(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """A half of the rows, with a guessed prior, gives the scorer by which the other half estimates the prior; all rows give the model."""
    if min(len(positive), len(unlabelled)) < 4:
        return fit(positive, unlabelled, 0.5)
    (some, others), (web, rest) = halves(positive), halves(unlabelled)
    draft = fit(some, web, 0.5)
    return fit(positive, unlabelled, min(0.98, max(0.02, estimated_prior(draft.scores(others), draft.scores(rest)))))


def train(docs: DataFrame, labels: DataFrame, learn: Column, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model | None:
    """From labels (doc_id, quality) where learn holds; None if no trusted positive has a text. Only vectors come to the driver."""
    known = labels.where(learn & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    trusted = bounded_sample(known.where("quality = 1").select("doc_id"), F.col("doc_id"), positives)

    def make():
        return lambda texts: [[features_of(t) for t in texts]]

    def vectors(texts: DataFrame) -> np.ndarray:
        return np.array([r.x for r in map_texts(texts, ["doc_id"], make, "x array<double>").orderBy("doc_id").toLocalIterator()])

    yes = vectors(one_text_each(docs, trusted))
    if not len(yes):
        return None
    return fit_with_prior(yes, vectors(sampled_texts(docs, unlabelled, 12)))


def score(docs: DataFrame, model: Model | None, carry: list[str]) -> DataFrame:
    """carry, score; 0.5 everywhere if nothing could be learnt."""

    def make():
        return lambda texts: [model.scores(np.array([features_of(t) for t in texts])) if model else np.full(len(texts), 0.5)]

    return map_texts(docs, carry, make, "score double")


def learnable(parts: int = 5, held: int = 0) -> Column:
    return fold(F.col("doc_id"), parts) != held


def quality_scores(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs (columns doc_id, text); labels: doc_id, quality.

    Labels of the held-out fold are never read for learning; null ids are not held out and not learnt from. Of ids with
    several labels the worst holds. Null texts score as empty ones. Repeated rows are kept; an empty table gives an empty
    result, and without labels every score is 0.5. Other columns are ignored.
    """
    model = train(docs, labels, learnable(parts, held))
    found = score(docs.select("doc_id", "text"), model, ["doc_id"])
    out = F.coalesce(fold(F.col("doc_id"), parts) == held, F.lit(False))
    return found.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
