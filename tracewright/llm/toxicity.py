"""Toxicity by a multiple-instance support vector machine on a gap-weighted subsequence kernel with Nystrom landmarks.

Units are a text's words without their non-letters (so inserted signs vanish), and runs of single characters joined (so
spaced-out words return). The kernel of two units sums, over their common subsequences of ORDER characters, DECAY to the
power of the characters each spans, normalised; it tolerates gaps and inserted characters. A label is known for a text as a
whole, so the machine learns from bags: every unit of a clean text is clean, and of a toxic text at least one is toxic.
Which one, its witness, is what the machine of the round before finds worst; each round trains on the witnesses, on slightly
altered copies of them and on the clean units (the worst of all clean units among them), until the witnesses stay the same.
Landmarks are witnesses, frequent and worst clean units. The machine is linear in Nystrom features, that is in a unit's
kernels with the landmarks, and so in its subsequences: a unit is scored by one table of subsequence weights. A text's
score is that of its worst unit, by a sigmoid fitted on the training texts.
"""

from __future__ import annotations

import random
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations, islice

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, map_texts
from .samples import bounded_sample, one_text_each

ORDER, DECAY = 3, 0.6
#: Labelled documents, landmarks and clean units that are fitted on, at most; rounds.
SAMPLE, LANDMARKS, UNITS, ROUNDS = 6000, 240, 8000, 4
#: Ridge of the machine: a unit that a single text vouches for stays below the margin.
RIDGE = 3.0
#: Weights of a clean unit and of a witness's altered copies together, against one text's witness; copies of a witness.
CLEAN, ALTERED, COPIES = 3.0, 4.0, 32
#: Share of toxic texts, and of altered copies, in the sigmoid's fit; clean texts have the rest, as false alarms cost more.
SHARE = 0.05
#: Characters of a window. A longer unit is read in windows that begin at every character: each substring of up to WINDOW stands whole in one.
WINDOW = 16
#: Scores of units that a worker remembers, at most; windows that are scored at a time.
REMEMBER, BLOCK = 500_000, 20_000
#: Stands before and behind each unit, so that its first and last characters count.
_EDGE = "\x7f"
_SPACED_OUT = re.compile(r"(?<!\S)(?:\w[ \t]{1,3}){3,}\w(?!\w)")
_STRIP = re.compile(r"[\W\d_]+")


def units_of(text: str | None) -> set[str]:
    """Distinct lower-case units of a whole text."""
    low = (text or "").lower()
    out = set(low.split())
    odd = [w for w in out if not w.isalpha()]
    out.difference_update(odd)
    out.update(_STRIP.sub("", w) for w in odd)
    for run in _SPACED_OUT.findall(low):
        out.add(_STRIP.sub("", run))
    out.discard("")
    return out


def _symbols(units: list[str]) -> np.ndarray:
    """Rows of symbol numbers below 64, of units of one length: a to z, then all other characters folded onto the rest."""
    c = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(units), -1)
    return np.where((c >= 97) & (c <= 122), c - 97, 26 + c % 38).astype(np.int32)


@cache
def _spans(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Index triplets of a unit of n characters and the weight of each."""
    at = np.array(list(combinations(range(n), ORDER)), np.int32).reshape(-1, ORDER)
    return at, DECAY ** (at[:, -1] - at[:, 0] + 1).astype(float)


def subsequences(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For units of one length: subsequence numbers, sorted, and normalised weights (units x subsequences); all but the last of equal numbers weigh 0."""
    x = _symbols([_EDGE + u + _EDGE for u in units])
    at, weight = _spans(x.shape[1])
    # number and place in one key: windows have less than 1024 triplets
    key = np.sort((x[:, at[:, 0]] << 22) | (x[:, at[:, 1]] << 16) | (x[:, at[:, 2]] << 10) | np.arange(len(at), dtype=np.int32), axis=1)
    code = key >> 10
    sums = np.cumsum(weight[key & 1023], axis=1)
    last = np.ones(code.shape, bool)
    last[:, :-1] = code[:, 1:] != code[:, :-1]
    ends = np.where(last, sums, 0.0)
    before = np.maximum.accumulate(ends, axis=1)
    total = np.where(last, sums, 0.0)
    total[:, 1:] -= np.where(last[:, 1:], before[:, :-1], 0.0)
    return code, total / np.linalg.norm(total, axis=1, keepdims=True)


def windows_of(unit: str) -> list[str]:
    return [unit[i : i + WINDOW] for i in range(max(1, len(unit) - WINDOW + 1))]


def by_length(units: list[str], room: int = 2_000_000) -> Iterator[tuple[list[int], list[str]]]:
    """(positions, units) of each length, in blocks."""
    groups: dict[int, list[int]] = {}
    for i, u in enumerate(units):
        groups.setdefault(len(u) + 2, []).append(i)
    for n, own in groups.items():
        step = max(1, room // len(_spans(n)[0]))
        for k in range(0, len(own), step):
            yield own[k : k + step], [units[i] for i in own[k : k + step]]


class Landmarks:
    """Subsequence weights of the landmarks, a row for each subsequence that any of them has; row 0 is empty."""

    def __init__(self, units: list[str]):
        parts = [(i, c, w) for own, some in by_length(units) for i, c, w in zip(own, *subsequences(some))]
        present = np.unique(np.concatenate([c for _, c, _ in parts]))
        self.row = np.zeros(64**3, np.int32)
        self.row[present] = np.arange(1, len(present) + 1)
        self.weight = np.zeros((len(present) + 1, len(units)), np.float32)
        for i, c, w in parts:
            np.add.at(self.weight[:, i], self.row[c], w.astype(np.float32))

    def kernels(self, units: list[str]) -> np.ndarray:
        """Kernel of each unit, of WINDOW characters at most, with each landmark."""
        out = np.zeros((len(units), self.weight.shape[1]))
        for own, some in by_length(units, 200_000):
            code, weight = subsequences(some)
            dense = np.zeros((len(some), len(self.weight)), np.float32)
            np.add.at(dense, (np.arange(len(some))[:, None], self.row[code]), weight.astype(np.float32))
            dense[:, 0] = 0
            out[own] = dense @ self.weight
        return out

    def table(self, alpha: np.ndarray) -> np.ndarray:
        """Weight of every subsequence in the sum of alpha times the kernel with each landmark."""
        return (self.weight @ alpha.astype(np.float32))[self.row]


@dataclass
class Model:
    table: np.ndarray  # weight of each subsequence
    bias: float
    slope: float = 1.0
    offset: float = 0.0
    landmarks: tuple[str, ...] = ()
    alpha: tuple[float, ...] = ()  # weight of the kernel with each landmark; the table is their sum

    def of_windows(self, windows: list[str]) -> np.ndarray:
        out = np.empty(len(windows))
        for own, some in by_length(windows, 400_000):
            code, weight = subsequences(some)
            out[own] = np.einsum("ij,ij->i", self.table[code], weight)
        return out + self.bias

    def decisions(self, units: list[str]) -> np.ndarray:
        """By blocks of windows, so that the subsequences of few are held at a time."""
        out, pieces = np.full(len(units), -np.inf), ((i, w) for i, u in enumerate(units) for w in windows_of(u))
        while some := list(islice(pieces, BLOCK)):
            np.maximum.at(out, [i for i, _ in some], self.of_windows([w for _, w in some]))
        return out

    @property
    def least(self) -> float:
        """Decision for a text without units."""
        return 2 * self.bias - 1

    def scores(self, worst: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * worst + self.offset, -30, 30)))


_ODD = np.array([2 * k * 0x9E3779B97F4A7C15 + 0xD1342543DE82EF95 & (1 << 64) - 1 for k in range(6)], np.uint64)


def marks_of(text: str) -> list[int]:
    """Least hashes of a text's word triples, one for each of six hash functions."""
    w = text.lower().split()
    h = np.array([xxhash.xxh64_intdigest(" ".join(w[k : k + 3])) for k in range(max(1, len(w) - 2))], np.uint64)
    return [int((h * m).min().astype(np.int64)) for m in _ODD]


class Copies:
    """Tells whether a text is a near copy of earlier ones: two thirds of its marks came before."""

    def __init__(self):
        self.seen: set[tuple[int, int]] = set()

    def __contains__(self, marks: Iterable[int]) -> bool:
        least = set(enumerate(marks))
        again = 3 * len(least & self.seen) >= 2 * len(least)
        self.seen |= least
        return again


def altered(unit: str, most: int = COPIES) -> list[str]:
    """Copies of a unit with a letter inserted, doubled or (from 5 letters) left out; the same ones on every run."""
    rnd = random.Random(unit)
    out = [unit[:i] + unit[i - 1] + unit[i:] for i in range(1, len(unit) + 1)]
    if len(unit) >= 5:
        out += [unit[:i] + unit[i + 1 :] for i in range(1, len(unit) - 1)]
    while len(out) < most:
        i = rnd.randrange(1, len(unit)) if len(unit) > 1 else 1
        out.append(unit[:i] + chr(97 + rnd.randrange(26)) + unit[i:])
    return [v for v in dict.fromkeys(out) if v != unit and len(v) <= WINDOW]


def support_vectors(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = RIDGE, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Linear machine of least ridge/2 |w|^2 + sum of cost * squared hinge, by Newton steps on the rows within the margin; the bias is free."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    prior = np.diag([*np.full(x.shape[1], ridge), 1e-6])
    w, active = np.zeros(x1.shape[1]), None
    for _ in range(rounds):
        inside = y * (x1 @ w) < 1
        if active is not None and (inside == active).all():
            break
        active = inside
        a = x1[inside] * cost[inside, None]
        new = np.linalg.solve(2 * a.T @ x1[inside] + prior, 2 * a.T @ y[inside])
        step = 1.0
        while step > 1e-3 and _risk(x1, y, cost, prior, w + step * (new - w)) > _risk(x1, y, cost, prior, w):
            step /= 2
        w = w + step * (new - w)
    return w[:-1], float(w[-1])


def _risk(x1, y, cost, prior, w) -> float:
    return float(w @ prior @ w / 2 + (cost * np.square(np.maximum(0, 1 - y * (x1 @ w)))).sum())


def nystrom_machine(landmarks: list[str], units: list[str], sign: np.ndarray, cost: np.ndarray) -> Model:
    """The machine in the span of the landmarks."""
    marks = Landmarks(landmarks)
    values, vectors = np.linalg.eigh(marks.kernels(landmarks))
    keep = values > 1e-4
    root = vectors[:, keep] / np.sqrt(values[keep])
    w, bias = support_vectors(marks.kernels(units) @ root, sign, cost)
    return Model(marks.table(root @ w), bias, landmarks=tuple(landmarks), alpha=tuple((root @ w).tolist()))


def exact_machine(units: list[str], sign: np.ndarray, cost: np.ndarray, ridge: float = RIDGE, rounds: int = 150) -> Model:
    """The machine with every unit as a landmark, found in the space of subsequences by accelerated gradient."""
    parts = [(np.repeat(own, c.shape[1]), c.ravel(), w.ravel()) for own, some in by_length(units) for c, w in [subsequences(some)]]
    row, code, weight = (np.concatenate(x) for x in zip(*parts))
    there = weight > 0
    row, weight = row[there], weight[there]
    own, code = np.unique(code[there], return_inverse=True)
    n, m = len(units), len(own) + 1

    def forth(w):
        return np.bincount(row, weight * w[code], n) + w[-1]

    def back(g):
        return np.append(np.bincount(code, weight * g[row], m - 1), g.sum())

    v = np.ones(m)
    for _ in range(20):
        v = back(cost * forth(v)) / np.linalg.norm(v)
    bound = 2.2 * np.linalg.norm(v) + ridge
    prior = np.append(np.full(m - 1, ridge), 0.0)
    w = v = np.zeros(m)
    for t in range(1, rounds + 1):
        new = v - (prior * v - 2 * back(cost * sign * np.maximum(0, 1 - sign * forth(v)))) / bound
        v, w = new + (t - 1) / (t + 2) * (new - w), new
    table = np.zeros(64**3, np.float32)
    table[own] = w[:-1]
    return Model(table, float(w[-1]))


def _apart(pool: list[str], most: int) -> list[str]:
    """The first of pool that are not nearly the same as one before."""
    if not pool:
        return []
    near, kept = Landmarks(pool).kernels(pool), []
    for i in range(len(pool)):
        if len(kept) < most and (not kept or near[i, kept].max() < 0.9):
            kept.append(i)
    return [pool[i] for i in kept]


def fit(bags: Iterable[tuple[list[str], list[int], int]], landmarks: int = LANDMARKS, limit: int = UNITS, rounds: int = ROUNDS) -> Model | None:
    """From (units, marks, whether toxic) of texts; None unless both kinds occur. Near copies of earlier texts are left out."""
    copies, number, sets, labels = Copies(), {}, [], []
    for units, marks, label in bags:
        if marks not in copies:
            sets.append(np.array(sorted({number.setdefault(w, len(number)) for u in units for w in windows_of(u)}), np.int32))
            labels.append(label)
    y, names = np.array(labels), list(number)
    toxic = [s for s, label in zip(sets, y) if label and len(s)]
    if not toxic or y.min() == 1:
        return None
    bad, fine = (np.bincount(np.concatenate([s for s, label in zip(sets, y) if label == k]), minlength=len(names)) for k in (1, 0))
    common = sorted(np.flatnonzero(fine), key=lambda u: (-fine[u], names[u]))
    rare = common[limit // 2 :]
    steady = [*common[: limit // 2], *rare[:: max(1, len(rare) // (limit // 4))][: limit // 4]]
    # to begin with, every unit of a toxic text stands for it, and every unit is a landmark
    share = len(toxic) / len(y)
    first = sorted(np.flatnonzero(bad), key=lambda u: (-bad[u], names[u]))[: limit // 2]
    model = exact_machine([names[u] for u in [*first, *steady]], np.array([1.0] * len(first) + [-1.0] * len(steady)), np.array([bad[u] * (1 - share) for u in first] + [fine[u] * share for u in steady]))
    before, forms = None, []
    for _ in range(rounds):
        each = model.of_windows(names)
        # a text vouches for its worst unit, and for others that are clearly toxic
        vouched = Counter(u for s in toxic for u in s[each[s] >= min(each[s].max(), 0.5)].tolist())
        if vouched == before:
            break
        before = vouched
        yes = sorted(vouched, key=lambda u: (-vouched[u], names[u]))[: limit // 8]
        hard = sorted(np.flatnonzero(fine), key=lambda u: (-each[u], names[u]))[: limit // 4]
        no = list(dict.fromkeys([*hard, *steady]))
        forms = []
        for u in yes:
            if vouched[u] > RIDGE and len(names[u]) > ORDER:
                own = [v for v in altered(names[u]) if v not in number or not fine[number[v]]]
                forms += [(v, ALTERED * vouched[u] / len(own)) for v in own]
        units = [*(names[u] for u in yes), *(v for v, _ in forms), *(names[u] for u in no)]
        sign = np.array([1.0] * (len(yes) + len(forms)) + [-1.0] * len(no))
        cost = np.array([float(vouched[u]) for u in yes] + [c for _, c in forms] + [CLEAN * fine[u] for u in no])
        third = landmarks // 3
        model = nystrom_machine([x for part in (yes, hard, common) for x in _apart([names[u] for u in part[: 4 * third]], third)], units, sign, cost)
    each = model.of_windows(names)
    worst = np.array([each[s].max() if len(s) else model.least for s in sets])
    weight = np.array([c for _, c in forms])
    model.slope, model.offset = calibrated(
        np.concatenate([worst, model.of_windows([v for v, _ in forms])]),
        np.concatenate([y, np.ones(len(forms))]),
        np.concatenate([np.where(y == 1, SHARE / y.sum(), (1 - 2 * SHARE) / (1 - y).sum()), SHARE * weight / max(1, weight.sum())]),
    )
    return model


def calibrated(worst: np.ndarray, y: np.ndarray, cost: np.ndarray) -> tuple[float, float]:
    """Platt's sigmoid by Newton steps with a small ridge: slope, offset."""
    x, p = np.stack([worst, np.ones(len(worst))], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ p, -30, 30)))
        h = (x * (cost * q * (1 - q))[:, None]).T @ x + np.diag([1e-4, 1e-6])
        p = p - np.linalg.solve(h, x.T @ (cost * (q - y)) + np.array([1e-4, 1e-6]) * p)
    return float(max(p[0], 1e-3)), float(p[1])


def train(docs: DataFrame, labels: DataFrame, learn: Column, limit: int = SAMPLE) -> Model | None:
    """From at most limit documents whose labels (doc_id, toxic) learn allows: a third of them toxic if there are enough."""
    known = labels.where(learn & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = None
    for label, most in ((1, limit // 3), (0, limit - limit // 3)):
        part = bounded_sample(known.where(F.col("toxic") == label), F.col("doc_id"), most)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = one_text_each(docs, chosen)

    def make():
        from tracewright.llm import toxicity

        return lambda texts: [[sorted(toxicity.units_of(t)) for t in texts], [toxicity.marks_of(t) for t in texts]]

    # units and marks are found on the executors; whole texts do not come here
    found = map_texts(texts, ["doc_id", "toxic"], make, "units array<string>, marks array<long>")
    return fit((r.units, r.marks, r.toxic) for r in found.orderBy("doc_id").toLocalIterator())


#: Scores of units by the model with the number at "of"; lives as long as a Python worker, over its tasks.
_KNOWN: dict[str, object] = {"of": None, "scores": {}}


def score(docs: DataFrame, model: Model | None, carry: list[str]) -> DataFrame:
    """carry, score; 0 everywhere if nothing could be learnt."""
    number = uuid.uuid4().hex

    def make():
        from tracewright.llm import toxicity

        shared = toxicity._KNOWN
        if shared["of"] != number:
            shared.update(of=number, scores={})

        def work(texts):
            if model is None:
                return [np.zeros(len(texts))]
            sets = [units_of(t) for t in texts]
            if len(shared["scores"]) > REMEMBER:
                shared["scores"] = {}
            known = shared["scores"]
            new = list(set().union(*sets) - known.keys())
            known.update(zip(new, model.decisions(new).tolist()))
            return [model.scores(np.array([max(map(known.__getitem__, s), default=model.least) for s in sets]))]

        return work

    return map_texts(docs, carry, make, "score double")


def toxicity_scores(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs (columns doc_id, text); labels: doc_id, toxic.

    Labels of the held-out fold are never read for learning; null ids are not held out and not learnt from. Of ids with
    several labels toxic holds, of rows that repeat an id the least text is learnt from. Null and empty texts score as a text
    without words. Repeated rows are kept; an empty table gives an empty result, and without labels of both kinds every score
    is 0. Other columns are ignored.
    """
    model = train(docs, labels, fold(F.col("doc_id"), parts) != held)
    found = score(docs.select("doc_id", "text"), model, ["doc_id"])
    out = F.coalesce(fold(F.col("doc_id"), parts) == held, F.lit(False))
    return found.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
