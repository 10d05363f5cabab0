import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import corpus, sentence
from tracewright.llm import quality_rules


def plain(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(again)


@pytest.mark.parametrize("text", ["", None, "a", "a b c d e", "a b c d e a b c d e", "a a a a a a", "x\nx\n\n \n x\nx", "#*$ é🎉 \x1c\x85 b", "a b c d e f " * 700, "　a\xa0b c"])
def test_statistics(text):
    assert quality_rules.statistics_of(text) == plain(text)


def test_random_texts():
    rnd = random.Random(0)
    for _ in range(150):
        text = "".join(rnd.choice("ab \n\t#") for _ in range(rnd.randrange(200)))
        assert quality_rules.statistics_of(text) == plain(text)


def test_operator_on_odd_rows(docs, none):
    got = quality_rules.quality_report(docs).collect()
    assert sorted((repr((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got)) == sorted(repr((r[0], *plain(r[1]))) for r in corpus())
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality_rules.quality_report(none).collect() == []


def test_outliers_go_and_the_estimate_resists_them(spark):
    rnd = random.Random(5)
    good = [(i, sentence(rnd, rnd.randrange(40, 200)), "en", "hot" if i % 2 else f"s{i % 3}") for i in range(800)]
    bad = [(1000 + i, "### ".join(sentence(rnd, 60).split()), "en", "hot") for i in range(80)]
    df = spark.createDataFrame(good + bad, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality_rules.quality_report(df).where("kept").collect()}
    assert kept == {r[0] for r in good}


def test_chi_square():
    assert quality_rules.chi_square_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert quality_rules.chi_square(3.0, 3) == pytest.approx(0.60837, abs=1e-4)


def plain_counts(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    whole = len(words) // 50 * 50 or len(words)
    distinct = sum(len(set(words[k : min(k + 50, whole)])) for k in range(0, whole, 50))
    return sum("!" <= c <= "~" and not c.isalnum() for c in text or ""), sum("A" <= c <= "Z" for c in text or ""), distinct, whole


@pytest.mark.parametrize("text", ["", None, "A b, C!", "a b c d e f " * 40, "É A ~ ñ B # 12"])
def test_counts(text):
    assert quality_rules.counts_of(text) == plain_counts(text)


def plain_quantile(x, share):
    return np.sort(x, axis=0)[max(1, int(np.ceil(share * len(x)))) - 1]


def plain_inverse(cov):
    return np.linalg.inv(cov + 1e-6 * np.eye(len(cov)))


def plain_distance(x, mean, cov):
    return np.einsum("ij,jk,ik->i", x - mean, plain_inverse(cov), x - mean)


def plain_estimate(x, target, share, peers):
    """Mean and covariance of one group's rows by minimum covariance determinant, shrunk towards target."""
    n = x.shape[1]

    def of(rows, share):
        factor = share / quality_rules.chi_square(quality_rules.chi_square_quantile(share, n), n + 2)
        a = len(rows) / (len(rows) + peers)
        mean, cov = a * rows.mean(axis=0) + (1 - a) * target[0], a * factor * np.cov(rows.T, bias=True) + (1 - a) * target[1]
        return mean, cov, np.linalg.slogdet(cov + 1e-6 * np.eye(n))[1]

    low, middle, high = (plain_quantile(x, q) for q in (0.25, 0.5, 0.75))
    scale = np.maximum((high - low) / 1.349, 1e-3)
    z = (x - middle) / scale
    signs = z / np.sqrt((z**2).sum(axis=1) + 1e-12)[:, None]
    shapes = [np.eye(n), (len(x) * np.corrcoef(np.tanh(z).T) + n * np.eye(n)) / (len(x) + n), (n * signs.T @ signs + n * np.eye(n)) / (len(x) + n)]
    tries = []
    for shape in shapes:
        now = (middle, shape * np.outer(scale, scale))
        for _ in range(2):
            d = plain_distance(x, *now[:2])
            now = of(x[d <= plain_quantile(d, share)], share)
        tries.append(now)
    now = min(tries, key=lambda t: t[2])
    for _ in range(40):
        d = plain_distance(x, *now[:2])
        before, now = now, of(x[d <= plain_quantile(d, share)], share)
        if abs(now[2] - before[2]) < 1e-9:
            break
    return of(x[plain_distance(x, *now[:2]) <= quality_rules.chi_square_quantile(0.975, n)], 0.975)[:2]


@pytest.mark.parametrize("peers", [0.0, 50.0])
def test_distances_equal_brute_force(spark, peers):
    rng = np.random.default_rng(4)
    mixed = rng.normal(size=(5, 5)) * 0.4 + np.eye(5)
    groups = {"a": ("x", rng.normal(size=(150, 5)) @ mixed), "b": ("x", rng.normal(size=(90, 5)) @ mixed + 3), "c": ("y", rng.normal(size=(120, 5)) * 0.2)}
    groups["a"][1][:30] += 9
    rows = [(g, p, *map(float, x)) for g, (p, xs) in groups.items() for x in xs]
    df = spark.createDataFrame(rows, ["_g", "_p", *(f"_f{i}" for i in range(5))]).repartition(3)
    got = {tuple(round(r[f"_f{i}"], 9) for i in range(5)): r["_d"] for r in quality_rules.robust_distances(df, peers=peers).collect()}
    everything = np.concatenate([x for _, x in groups.values()])
    wide = np.maximum(((plain_quantile(everything, 0.75) - plain_quantile(everything, 0.25)) / 1.349) ** 2, 1e-6)
    root = (plain_quantile(everything, 0.5), np.diag(wide))
    for g, (p, x) in groups.items():
        parent = plain_estimate(np.concatenate([y for q, y in groups.values() if q == p]), root, 0.75, peers)
        expected = plain_distance(x, *plain_estimate(x, (parent[0], parent[1] + 1e-6 * np.eye(5)), 0.75, peers))
        assert np.allclose([got[tuple(np.round(r, 9))] for r in x], expected, rtol=0.02)


def test_masked_outliers_are_caught(spark):
    """A fifth of the rows far off in one statistic, and a tenth in two, of little spread."""
    rng = np.random.default_rng(6)
    for share, shift in ((0.2, [0, 0, 20, 0, 0]), (0.1, [3, 0, 0, 15, 0])):
        x = rng.normal(size=(2000, 5)) * 0.05
        n = int(share * len(x))
        x[:n] += 0.05 * np.array(shift)
        df = spark.createDataFrame([(i, "g", "p", *map(float, r)) for i, r in enumerate(x)], ["i", "_g", "_p", *(f"_f{k}" for k in range(5))])
        far = {r.i for r in quality_rules.robust_distances(df).where(f"_d > {quality_rules.chi_square_quantile(1 - 1e-4, 5)}").collect()}
        assert len([i for i in far if i < n]) >= 0.95 * n and len([i for i in far if i >= n]) <= 0.005 * len(x)


def test_small_groups_rest_on_their_language(spark):
    rnd = random.Random(9)
    docs = [(i, sentence(rnd, rnd.randrange(60, 200)), "en", f"host{i // 4}") for i in range(200)]
    docs += [(900 + i, "### ".join(sentence(rnd, 60).split()), "en", f"host{i}") for i in range(3)]
    got = quality_rules.quality_report(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).collect()
    assert {r.doc_id for r in got if not r.kept} == {900, 901, 902}
