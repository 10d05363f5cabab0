"""Language identification by nearest centroid.

A text is a normalised TF-IDF vector of hashed byte n-grams of its letters (1 to 3 bytes, whole text). Each language has
several centroids, found by spherical k-means on a bounded sample of labelled documents. A text takes the language of the
centroid nearest by cosine; one farther from it than nearly all training texts of that cluster is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, map_texts
from .samples import bounded_sample_each

#: Labelled documents that are fitted on, at most, shared out over the languages; centroids of a language; hashed n-grams of 2 and of 3 bytes.
SAMPLE, CLUSTERS, BITS = 3000, 3, 12
#: A text is rejected beyond this quantile of its cluster's training distances, times SLACK.
REJECT, SLACK = 0.995, 1.15
_DIMS = 256 + 2 * (1 << BITS)
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
_MIX = np.uint32(2654435761)


def counts_of(text: str) -> np.ndarray:
    """Hashed counts of a text's n-grams."""
    b = np.frombuffer(b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()) + b" ", np.uint8).astype(np.uint32)
    out = np.zeros(_DIMS, np.float32)
    out[:256] = np.bincount(b, minlength=256)
    if len(b) > 1:
        two = b[:-1] << np.uint32(8) | b[1:]
        out[256 : 256 + (1 << BITS)] = np.bincount((two * _MIX) >> np.uint32(32 - BITS), minlength=1 << BITS)
        three = two[:-1] << np.uint32(8) | b[2:]
        out[256 + (1 << BITS) :] = np.bincount((three * _MIX) >> np.uint32(32 - BITS), minlength=1 << BITS)
    out[32] = 0
    return out


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]  # of each centroid
    radius: np.ndarray  # of each centroid

    def vectors(self, texts: list[str]) -> np.ndarray:
        x = np.log1p(np.stack([counts_of(t) for t in texts])) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _means(x: np.ndarray, label: np.ndarray, k: int) -> np.ndarray:
    c = np.stack([x[label == j].sum(axis=0) for j in range(k)])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Centroids of unit vectors; starts at the row nearest the mean, then at the rows farthest from all before."""
    k = min(k, len(x))
    chosen = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(chosen) < k:
        chosen.append(int(np.argmin((x @ x[chosen].T).max(axis=1))))
    c = x[chosen]
    for _ in range(rounds):
        label = (x @ c.T).argmax(axis=1)
        live = np.unique(label)
        c = _means(x, np.searchsorted(live, label), len(live))
    return c


def sparse_counts(text: str) -> tuple[list[int], list[float]]:
    """The n-grams that occur and their counts; none for a text without letters."""
    x = counts_of(text) if has_letter(text) else np.zeros(0)
    at = np.flatnonzero(x)
    return at.tolist(), x[at].tolist()


def fit(labelled: Iterable[tuple[str, str]], clusters: int = CLUSTERS) -> Model | None:
    """From texts and their languages; None without a text that has a letter."""
    return fit_counts([(*sparse_counts(text), language) for text, language in labelled], clusters)


def fit_counts(labelled: list[tuple[list[int], list[float], str]], clusters: int = CLUSTERS) -> Model | None:
    """From n-grams, their counts and the languages of texts."""
    rows = [r for r in labelled if len(r[0])]
    if not rows:
        return None
    languages = [r[2] for r in rows]
    x = np.zeros((len(rows), _DIMS), np.float32)
    for own, (at, count, _) in zip(x, rows):
        own[at] = count
    del rows
    seen = np.count_nonzero(x, axis=0)
    model = Model((np.log((1 + len(x)) / (1 + seen)) + 1).astype(np.float32), np.zeros((0, _DIMS)), [], np.zeros(0))
    np.log1p(x, out=x)
    x *= model.idf
    x /= np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-12)[:, None]
    own = np.array(languages, dtype=object)
    parts, radius = [], []
    for language in sorted(set(own)):
        mine = x[own == language]
        c = spherical_kmeans(mine, clusters)
        cos = mine @ c.T
        label = cos.argmax(axis=1)
        for j in range(len(c)):
            far = 1 - cos[label == j, j]
            radius.append(SLACK * float(np.quantile(far, REJECT)) + 0.02 if len(far) else 0.5)
        parts.append(c)
        model.languages += [language] * len(c)
    model.centroids, model.radius = np.concatenate(parts).astype(np.float32), np.array(radius)
    return model


def train(docs: DataFrame, learn: Column, limit: int = SAMPLE) -> Model | None:
    """From at most limit documents where learn holds (columns doc_id, text, lang), of every language as many as of others or all.

    Of rows that repeat an id the least language and text is learnt from. Only counts of n-grams come to the driver.
    """
    rows = docs.select("doc_id", "text", "lang").where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    chosen = bounded_sample_each(rows, F.col("doc_id"), "lang", limit).groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("r")).select("doc_id", "r.lang", "r.text")

    def make():
        kinds = (pa.list_(pa.int32()), pa.list_(pa.float32()))
        return lambda texts: [pa.array(x, kind) for x, kind in zip(zip(*map(sparse_counts, texts)), kinds)]

    found = map_texts(chosen, ["doc_id", "lang"], make, "at array<int>, n array<float>")
    return fit_counts([(r.at, r.n, r.lang) for r in found.orderBy("doc_id").toLocalIterator()])


def identify(docs: DataFrame, model: Model | None, carry: list[str]) -> DataFrame:
    """carry, lang_pred, score (cosine of the nearest centroid), rejected."""

    def make():
        def work(texts):
            lang, score, rejected = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            have = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
            for k in range(0, len(have), 256):
                some = have[k : k + 256]
                cos = model.vectors([texts[i] for i in some]) @ model.centroids.T
                best = cos.argmax(axis=1)
                for i, j, c in zip(some, best, cos[np.arange(len(some)), best]):
                    lang[i], score[i], rejected[i] = model.languages[j], min(1.0, max(0.0, float(c))), 1 - c > model.radius[j]
            return [lang, score, rejected]

        return work

    return map_texts(docs, carry, make, "lang_pred string, score double, rejected boolean")


def language_report(docs: DataFrame, parts: int = 4, held: int = 2, limit: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row of docs (columns doc_id, text, lang).

    Learns from labelled documents outside the held-out fold only; a null doc_id is not held out and is not learnt from.
    lang_pred is und (score 0, rejected) for a null text, one without letters, or if nothing could be learnt. Texts that
    are far from every centroid keep the nearest language and are marked as rejected. Repeated rows are kept; an empty
    table gives an empty result. Other columns are ignored.
    """
    out = F.coalesce(fold(F.col("doc_id"), parts) == held, F.lit(False))
    model = train(docs, ~out, limit)
    found = identify(docs.select("doc_id", "text"), model, ["doc_id"])
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "rejected")
