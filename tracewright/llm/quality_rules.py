"""Quality rules: fixed limits, then robust multivariate outliers.

Each document gives a vector of transformed statistics: length, and four ratios that are shrunk towards the language's
median by PRIOR words, as a short text tells little. The minimum-covariance-determinant estimate of a group is found as in
FAST-MCD, from deterministic starts: concentration steps (the SHARE of documents nearest by the present estimate give the
next mean and covariance) from every start, the least determinant wins and goes on until it falls no more, and a
reweighting step ends it. Languages are estimated first; a language and source shrinks towards its language by PEERS
documents, in each step, so small groups need no rule of their own. Steps are aggregates over all documents (partial before
any shuffle, so a source that holds a third of all rows meets nowhere whole); only the matrices of each group are numpy.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, map_texts, materialize

#: Share of the documents that the estimate rests on; quantiles of the chi-square distribution beyond which a document has no weight, and goes.
SHARE, WEIGHTED, QUANTILE = 0.75, 0.975, 1 - 1e-4
#: Words of the language's median in each ratio; documents of the language in each group's estimate.
PRIOR, PEERS = 200, 50.0
#: Steps from every start; the fall of a log determinant that ends the steps, about what quantiles of large groups are exact to; steps at most.
TRIES, FALL, STEPS = 2, 5e-3, 40
#: Tasks for tables of a row a group.
FEW = 16
#: Added to variances so that they can be inverted.
GUARD = 1e-6
#: Words of a block in which distinct words are counted.
BLOCK = 50
_FEATURES = tuple(f"_f{i}" for i in range(5))
_SIGNS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_CAPITALS = bytes(range(65, 91))


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


def repeated_words(words: list[bytes]) -> int:
    """Words inside 5-word windows that occur twice or more, the first occurrence included; exact."""
    n = len(words)
    if n < 6:
        return 0
    ids = {}
    one = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    if len(ids) == n:
        return 0
    two = _ranks(one[:-1] * n + one[1:])
    four = _ranks(two[:-2] * n + two[2:])
    five, count = np.unique(four[:-1] * n + one[4:], return_inverse=True, return_counts=True)[1:]
    starts = np.flatnonzero(count[five] > 1)
    if not len(starts):
        return 0
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + 5, -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


def statistics_of(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    chars = len(text or "") - (len(raw) - len(raw.translate(None, b" \t\n\x0b\x0c\r")))
    symbols = len(raw) - len(raw.translate(None, b"#*$%&|<>"))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def counts_of(text: str | None) -> tuple[int, int, int, int]:
    """Signs and capitals (ASCII), distinct words summed over whole blocks, words in those (of a shorter text, in all)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    whole = len(words) // BLOCK * BLOCK or len(words)
    distinct = sum(len(set(words[k : min(k + BLOCK, whole)])) for k in range(0, whole, BLOCK))
    return len(raw) - len(raw.translate(None, _SIGNS)), len(raw) - len(raw.translate(None, _CAPITALS)), distinct, whole


def statistics(docs: DataFrame, carry: list[str]) -> DataFrame:
    def make():
        return lambda texts: [np.array(x, np.int64) for x in zip(*((*statistics_of(t), *counts_of(t)) for t in texts))]

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_signs", "_capitals", "_distinct", "_whole")
    return map_texts(docs, carry, make, ", ".join(f"{n} long" for n in names))


def chi_square(x: float, k: int) -> float:
    """Distribution function."""
    term = total = 1 / (k / 2)
    for i in range(1, 2000):
        term *= x / 2 / (k / 2 + i)
        total += term
        if term < total * 1e-16:
            break
    return total * math.exp(-x / 2 + k / 2 * math.log(x / 2) - math.lgamma(k / 2)) if x > 0 else 0.0


def chi_square_quantile(q: float, k: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, k) < q else (low, mid)
    return low


def _middle(values: list[Column], share: list[float]) -> list[Column]:
    """Quantiles of each value, exact in groups of up to some hundred rows."""
    return [F.percentile_approx(v, F.array(*map(F.lit, share)), F.lit(1000)) for v in values]


def transformed(stats: DataFrame, language: str) -> DataFrame:
    """stats with the features: log words, and the logs or roots of ratios to which PRIOR words of the language's median are added."""
    parts = (("word_chars", "n_words"), ("_signs", "n_words"), ("_capitals", "n_words"), ("_distinct", "_whole"))
    usual = stats.groupBy(language).agg(*(m[0].alias(f"_u{i}") for i, m in enumerate(_middle([F.col(a) / F.col(b) for a, b in parts], [0.5]))))
    ratios = [(F.col(a) + PRIOR * F.col(f"_u{i}")) / (F.col(b) + PRIOR) for i, (a, b) in enumerate(parts)]
    values = [F.log("n_words"), F.log(ratios[0]), 2 * F.sqrt(ratios[1]), 2 * F.sqrt(ratios[2]), F.log(ratios[3])]
    joined = stats.join(_written(usual), language)
    return joined.select(*stats.columns, *(v.alias(f) for v, f in zip(values, _FEATURES)))


def _pairs(n: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(n) for j in range(i, n)]


def _square(upper: np.ndarray, n: int) -> np.ndarray:
    out = np.empty((n, n))
    for k, (i, j) in enumerate(_pairs(n)):
        out[i, j] = out[j, i] = upper[k]
    return out


def _upper(matrix: np.ndarray) -> list[float]:
    return [float(matrix[i, j]) for i, j in _pairs(len(matrix))]


def _moments(names: tuple[str, ...], take: Column | None = None, of: list[Column] | None = None, weight: Column | None = None) -> Column:
    """Count, sums and sums of products of some rows, as an array."""
    x = of or [F.col(f) for f in names]
    one = F.lit(1.0) if weight is None else weight
    parts = [F.lit(1.0), *x, *(x[i] * x[j] * one for i, j in _pairs(len(x)))]
    return F.array(*(F.coalesce(F.sum(p if take is None else F.when(take, p)), F.lit(0.0)) for p in parts))


def _spread(sums: np.ndarray, n: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Count, mean and covariance from moments."""
    count = sums[0]
    mean = sums[1 : 1 + n] / max(count, 1)
    return count, mean, _square(sums[1 + n :], n) / max(count, 1) - np.outer(mean, mean)


def _schema(k: int) -> str:
    return ", ".join(["_g string", "_p string", "_was double", *(x for s in range(k) for x in (f"_m{s} array<double>", f"_i{s} array<double>", f"_c{s} array<double>", f"_v{s} double"))])


def _table(rows: list[tuple], k: int) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.float64(), *[pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64()] * k]
    names = ["_g", "_p", "_was", *(f"_{x}{s}" for s in range(k) for x in "micv")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def _described(mean: np.ndarray, cov: np.ndarray) -> tuple[list[float], list[float], list[float], float]:
    """Mean, inverse with doubled off-diagonal, covariance, log determinant."""
    n = len(mean)
    cov = (cov + cov.T) / 2 + GUARD * np.eye(n)
    inverse = np.linalg.inv(cov)
    return mean.tolist(), _upper(inverse * (2 - np.eye(n))), _upper(cov), float(np.linalg.slogdet(cov)[1])


def starts_of(cuts: np.ndarray, soft: np.ndarray, sign: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Three starts from a group's quartiles and the moments of its scaled rows: no correlation; that of the rows' tanh; that of their directions."""
    n = len(cuts)
    scale = np.maximum((cuts[:, 2] - cuts[:, 0]) / 1.349, 1e-3)
    out = [np.eye(n)]
    count, _, cov = _spread(soft, n)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    for matrix in (cov / np.outer(sd, sd), _square(sign[1 + n :], n) / max(count, 1) * n):
        out.append((count * matrix + n * np.eye(n)) / (count + n))
    return [(cuts[:, 1], m * np.outer(scale, scale)) for m in out]


def shrunk(count: float, mean: np.ndarray, cov: np.ndarray, target: tuple[np.ndarray, np.ndarray], peers: float) -> tuple[np.ndarray, np.ndarray]:
    """An estimate from count rows with that of peers rows of the target added."""
    a = count / max(count + peers, 1e-12)
    return a * mean + (1 - a) * target[0], a * cov + (1 - a) * target[1]


def consistency(share: float, n: int) -> float:
    """What the covariance of the nearest share of normal rows is to be multiplied by."""
    return share / chi_square(chi_square_quantile(share, n), n + 2)


def _distance(s: int, names: tuple[str, ...]) -> Column:
    d = [F.col(f) - F.col(f"_m{s}")[i] for i, f in enumerate(names)]
    return sum((F.col(f"_i{s}")[k] * d[i] * d[j] for k, (i, j) in enumerate(_pairs(len(names)))), F.lit(0.0))


def _estimate(sums: DataFrame, target: DataFrame, k: int, n: int, factor: float, peers: float) -> DataFrame:
    """The estimates of each group from its moments (_s0 to _sk), shrunk towards its target."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                aim, out = (np.array(r["_tm"]), _square(r["_tc"], n)), []
                for s in range(k):
                    count, mean, cov = _spread(np.array(r[f"_s{s}"]), n)
                    out += _described(*shrunk(count, mean, factor * cov, aim, peers))
                rows.append((r["_g"], r["_p"], r["_was"], *out))
            if rows:
                yield _table(rows, k)

    return sums.join(target, "_p").mapInArrow(run, _schema(k))


def _begun(stats: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """The starts of each group."""
    n = len(names)
    cuts = _written(stats.groupBy("_g", "_p").agg(F.array(*_middle([F.col(f) for f in names], [0.25, 0.5, 0.75])).alias("_cuts")))
    z = [(F.col(f) - F.col("_cuts")[i][1]) / F.greatest((F.col("_cuts")[i][2] - F.col("_cuts")[i][0]) / 1.349, F.lit(1e-3)) for i, f in enumerate(names)]
    scaled = stats.join(cuts, ["_g", "_p"]).select("_g", "_p", *(x.alias(f) for x, f in zip(z, names)))
    size = sum((F.col(f) * F.col(f) for f in names), F.lit(1e-12))
    sums = scaled.groupBy("_g", "_p").agg(_moments(names, of=[F.tanh(f) for f in names]).alias("_soft"), _moments(names, weight=1 / size).alias("_sign"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(r["_g"], r["_p"], None, *(x for m, c in starts_of(np.array(r["_cuts"]), np.array(r["_soft"]), np.array(r["_sign"])) for x in _described(m, c))) for r in b.to_pylist()]
            if rows:
                yield _table(rows, 3)

    return _written(sums.join(cuts, ["_g", "_p"]).mapInArrow(run, _schema(3)))


def _written(df: DataFrame) -> DataFrame:
    """A table of a row a group, so small that joins with it move no rows of documents."""
    return materialize(df.coalesce(FEW), "mcd")


def _stepped(stats: DataFrame, params: DataFrame, target: DataFrame, k: int, names: tuple[str, ...], share: float, peers: float) -> DataFrame:
    """One concentration step from each of k estimates; _was is the first one's log determinant."""
    far = stats.join(params.drop("_p", "_was"), "_g").select("_g", "_p", "_v0", *names, *(_distance(s, names).alias(f"_d{s}") for s in range(k)))
    limits = _written(far.groupBy("_g").agg(*(F.percentile_approx(f"_d{s}", F.lit(share), F.lit(1000)).alias(f"_l{s}") for s in range(k))))
    sums = far.join(limits, "_g").groupBy("_g", "_p").agg(F.first("_v0").alias("_was"), *(_moments(names, F.col(f"_d{s}") <= F.col(f"_l{s}")).alias(f"_s{s}") for s in range(k)))
    out = _written(_estimate(sums, target, k, len(names), consistency(share, len(names)), peers))
    drop_scratch(limits)
    return out


def robust_estimates(stats: DataFrame, target: DataFrame, names: tuple[str, ...] = _FEATURES, share: float = SHARE, peers: float = PEERS) -> DataFrame:
    """_g, _p, _m0 (mean), _i0 (inverse), _c0 (covariance), _v0 (log determinant) of each group _g of stats, with parent _p; target: _p, _tm, _tc."""
    params = _begun(stats, names)
    for _ in range(TRIES):
        before, params = params, _stepped(stats, params, target, 3, names, share, peers)
        drop_scratch(before)
    least = F.least("_v0", "_v1", "_v2")
    chosen = [F.when(F.col("_v0") == least, F.col(f"_{x}0")).when(F.col("_v1") == least, F.col(f"_{x}1")).otherwise(F.col(f"_{x}2")).alias(f"_{x}0") for x in "micv"]
    tried, params = params, params.select("_g", "_p", "_was", *chosen)
    for _ in range(STEPS):
        before, params = params, _stepped(stats, params, target, 1, names, share, peers)
        drop_scratch(before)
        fall = params.agg(F.max(F.col("_was") - F.col("_v0"))).first()[0]
        if fall is None or fall <= FALL:
            break
    # rows with a weight, by the distance that normal rows hardly exceed, give the final estimate
    n = len(names)
    far = stats.join(params.drop("_p", "_was"), "_g").withColumn("_d", _distance(0, names))
    sums = far.groupBy("_g", "_p").agg(F.first("_v0").alias("_was"), _moments(names, F.col("_d") <= chi_square_quantile(WEIGHTED, n)).alias("_s0"))
    out = _written(_estimate(sums, target, 1, n, consistency(WEIGHTED, n), peers))
    drop_scratch(params)
    drop_scratch(tried)
    return out


def robust_distances(stats: DataFrame, names: tuple[str, ...] = _FEATURES, share: float = SHARE, peers: float = PEERS) -> DataFrame:
    """stats with _d: squared Mahalanobis distance by the robust estimate of the row's group _g, which shrinks by peers rows towards that of
    its parent group _p, which shrinks towards the medians of all rows. With peers 0 every group is estimated by itself."""
    n = len(names)
    cuts = _written(stats.agg(F.array(*_middle([F.col(f) for f in names], [0.25, 0.5, 0.75])).alias("_cuts")).where(F.col("_cuts")[0].isNotNull()))
    wide = [F.greatest(F.pow((F.col("_cuts")[i][2] - F.col("_cuts")[i][0]) / 1.349, 2), F.lit(GUARD)) for i in range(n)]
    root = _written(cuts.select(F.lit("").alias("_p"), F.array(*(F.col("_cuts")[i][1] for i in range(n))).alias("_tm"), F.array(*(wide[i] if i == j else F.lit(0.0) for i, j in _pairs(n))).alias("_tc")))
    parents = robust_estimates(stats.withColumn("_g", F.col("_p")).withColumn("_p", F.lit("")), root, names, share, peers)
    target = parents.select(F.col("_g").alias("_p"), F.col("_m0").alias("_tm"), F.col("_c0").alias("_tc"))
    params = robust_estimates(stats, target, names, share, peers)
    return stats.join(params.select("_g", "_m0", "_i0"), "_g").withColumn("_d", _distance(0, names)).drop("_m0", "_i0")


def quality_report(docs: DataFrame, share: float = SHARE, peers: float = PEERS, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance for every row of docs
    (columns doc_id, text, lang, source).

    Null and empty texts have no words and fail. Null languages and sources are values of their own. Rows that the base
    rules fail have no distance and no part in the estimates. A group with few rows rests on its language, a language with
    few rows on the medians of all. Repeated rows and null ids are kept; an empty table gives an empty result. Other columns
    are ignored.
    """
    raw = statistics(docs, ["doc_id", "lang", "source"])
    language = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))
    group = F.concat_ws("\x1f", language, F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    named = raw.withColumns({"_g": group, "_p": language, "base_failed": failed})
    stats = materialize(named.select(*columns, "_g", "_p", "_signs", "_capitals", "_distinct", "_whole"), "statistics")
    passed = materialize(transformed(stats.where(~F.col("base_failed")), "_p").select(*columns, "_g", "_p", *_FEATURES), "features")
    judged = robust_distances(passed, share=share, peers=peers)
    good = judged.select(*columns, (F.col("_d") <= chi_square_quantile(quantile, len(_FEATURES))).alias("kept"), F.col("_d").alias("distance"))
    bad = stats.where("base_failed").select(*columns, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    return good.unionByName(bad)
