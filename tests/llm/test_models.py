"""Language, quality and toxicity models, token counts, and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SPANISH, WORDS, corpus, rows, sentence
from tracewright.llm import langid, quality_classifier, tokencount, toxicity


def fold(i, parts):
    return None if i is None else zlib.crc32(str(i).encode()) % parts


def test_language_of_odd_rows(docs, none):
    got = langid.language_report(docs).collect()
    assert len(got) == len(corpus())
    texts = {r[0]: r[1] for r in corpus()}
    for r in got:
        assert r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1
        if r.doc_id is not None and r.doc_id != 1:
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or ""))
        if r.doc_id is not None and 100 <= r.doc_id < 140:
            assert r.lang_pred == "es"
        if r.doc_id is not None and 2 <= r.doc_id < 60:
            assert r.lang_pred == "en"
    assert langid.language_report(none).collect() == []


def test_languages_are_learnt_from_the_fold_only(spark):
    rnd = random.Random(0)
    data = [(i, sentence(rnd, 20, SPANISH if i % 2 else WORDS), ("es" if i % 2 else "en") if fold(i, 4) != 2 else "lie") for i in range(200)]
    got = langid.language_report(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()
    assert all(r.lang_pred == ("es" if r.doc_id % 2 else "en") for r in got)
    unlabelled = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert langid.language_report(unlabelled).first().lang_pred == "und"


def test_rare_language_is_learnt(spark):
    rnd = random.Random(5)
    data = [(i, sentence(rnd, 12, SPANISH if i % 200 == 7 else WORDS), "es" if i % 200 == 7 else "en") for i in range(2000)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    got = langid.language_report(df, limit=20).collect()
    assert all(r.lang_pred == ("es" if r.doc_id % 200 == 7 else "en") for r in got)
    from tracewright.llm.samples import bounded_sample_each, shares

    assert shares({"a": 2, "b": 100, "c": 50}, 30) == {"a": 2, "b": 14, "c": 14}
    taken = [r.lang for r in bounded_sample_each(df, F.col("doc_id"), "lang", 12).collect()]
    assert taken.count("es") == 6 and taken.count("en") == 6


def test_far_texts_are_marked():
    rnd = random.Random(1)
    model = langid.fit((sentence(rnd, 40), "en") for _ in range(60))
    v = model.vectors([sentence(rnd, 40), "žščř ěýáí ůúďťň " * 9])
    far = 1 - (v @ model.centroids.T).max(axis=1)
    assert far[0] < model.radius.max() < far[1]


def junk(rnd, n):
    return " ".join(f"{rnd.choice(WORDS).upper()}!! ###" for _ in range(n))


def labelled(spark, n=300):
    rnd = random.Random(2)
    docs = [(i, junk(rnd, 40) if i % 5 == 0 else sentence(rnd, rnd.randrange(20, 80))) for i in range(n)]
    insult = ["moronic", "scumbag", "imbecile"]
    docs = [(i, t + (" " + rnd.choice(insult) + " " + sentence(rnd, 5) if i % 7 == 0 else "")) for i, t in docs]
    labels = [(i, int(i % 5 != 0), int(i % 7 == 0)) for i in range(n)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict(docs)


def test_quality_on_held_out_rows(spark, docs, none):
    texts, labels, _ = labelled(spark)
    got = quality_classifier.quality_scores(texts, labels).collect()
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) for r in got)
    assert all(r.predicted == int(r.doc_id % 5 != 0) for r in got if r.held_out)
    lies = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert rows(quality_classifier.quality_scores(texts, lies)) == rows(quality_classifier.quality_scores(texts, labels))
    odd = quality_classifier.quality_scores(docs, labels).collect()
    assert len(odd) == len(corpus()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in odd)
    assert quality_classifier.quality_scores(none, labels).collect() == []
    assert {r.score for r in quality_classifier.quality_scores(texts, labels.limit(0)).collect()} == {0.5}


def test_non_negative_risk_with_known_mixture():
    rng = np.random.default_rng(0)
    yes, no = rng.normal(2, 1, (400, 3)), rng.normal(-2, 1, (400, 3))
    mixed = np.concatenate([rng.normal(2, 1, (300, 3)), rng.normal(-2, 1, (300, 3))])
    model = quality_classifier.fit(yes, mixed, 0.5)
    assert (model.scores(yes) > 0.5).mean() > 0.95 and (model.scores(no) < 0.5).mean() > 0.95


def test_prior_is_estimated_from_scores():
    rng = np.random.default_rng(2)
    for share in (0.3, 0.6, 0.9):
        yes = rng.normal(2, 1, 4000)
        mixed = np.concatenate([rng.normal(2, 1, int(4000 * share)), rng.normal(-2, 1, 4000 - int(4000 * share))])
        assert abs(quality_classifier.estimated_prior(yes, mixed) - share) < 0.05


def test_quality_scores_equal_brute_force(spark):
    texts, labels, by_id = labelled(spark, 120)
    ids = sorted(i for i in by_id if fold(i, 5) != 0 and i % 5 != 0)
    feature = lambda i: quality_classifier.features_of(by_id[i])
    yes, rest = np.array([feature(i) for i in ids]), np.array([feature(i) for i in sorted(by_id)])
    (a, b), (c, d) = quality_classifier.halves(yes), quality_classifier.halves(rest)
    draft = quality_classifier.fit(a, c, 0.5)
    prior = quality_classifier.estimated_prior(draft.scores(b), draft.scores(d))
    everything = np.concatenate([yes, rest])
    mean, scale = everything.mean(axis=0), np.maximum(everything.std(axis=0), 1e-3)
    model = quality_classifier.fit(yes, rest, min(0.98, max(0.02, prior)))
    got = {r.doc_id: r.score for r in quality_classifier.quality_scores(texts, labels).collect()}
    for i in by_id:
        z = sum(w * min(4, max(-4, (x - m) / s)) for w, x, m, s in zip(model.weights, feature(i), mean, scale)) + model.bias
        assert got[i] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-6)


def test_languages_equal_brute_force(spark):
    rnd = random.Random(6)
    data = [(i, sentence(rnd, 15, SPANISH if i % 3 else WORDS), "es" if i % 3 else "en") for i in range(90)]
    model = langid.fit((t, x) for i, t, x in data if fold(i, 4) != 2)
    got = {r.doc_id: r for r in langid.language_report(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()}
    for i, t, _ in data:
        x = [np.log1p(c) * w for c, w in zip(langid.counts_of(t), model.idf)]
        length = sum(v * v for v in x) ** 0.5
        cos = [sum(a * b for a, b in zip(x, c)) / length for c in model.centroids]
        assert got[i].score == pytest.approx(max(cos), abs=1e-4) and got[i].lang_pred == model.languages[int(np.argmax(cos))]


def test_repeats_of_an_id_are_learnt_once(spark):
    from tracewright.llm.samples import one_text_each, sampled_texts

    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, None), (3, "c"), (None, "d")], "doc_id long, text string")
    chosen = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")
    assert rows(one_text_each(df, chosen)) == [(1, 0, "a")]
    assert rows(sampled_texts(df, 10)) == [(1, "a"), (3, "c")]


def test_toxicity_on_held_out_rows(spark, docs, none):
    texts, labels, _ = labelled(spark)
    got = toxicity.toxicity_scores(texts, labels).collect()
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) for r in got)
    assert all(r.predicted == int(r.doc_id % 7 == 0) for r in got if r.held_out)
    odd = toxicity.toxicity_scores(docs, labels).collect()
    assert len(odd) == len(corpus()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in odd)
    assert toxicity.toxicity_scores(none, labels).collect() == []
    assert {r.score for r in toxicity.toxicity_scores(texts, labels.limit(0)).collect()} == {0.0}


def plain_weights(x):
    """Decayed spans of the subsequences of three characters, by enumeration; each unit stands between two edges."""
    from itertools import combinations

    x, out = f"\x7f{x}\x7f", {}
    for at in combinations(range(len(x)), 3):
        u = "".join(x[i] for i in at)
        out[u] = out.get(u, 0) + toxicity.DECAY ** (at[-1] - at[0] + 1)
    return out


def plain_kernel(a, b):
    dot = lambda p, q: sum(v * q.get(k, 0) for k, v in p.items())
    return dot(a, b) / (dot(a, a) * dot(b, b)) ** 0.5


def test_kernel_equals_enumeration():
    units, marks = ["idiot", "idxiot", "aaa", "banana", "abcabcabc", "stone", "a"], ["idiot", "banana", "aaaa"]
    got = toxicity.Landmarks(marks).kernels(units)
    expected = [[plain_kernel(plain_weights(u), plain_weights(m)) for m in marks] for u in units]
    assert np.allclose(got, expected, atol=1e-5)


def bags(texts, labels):
    return [(sorted(toxicity.units_of(t)), toxicity.marks_of(t), y) for t, y in zip(texts, labels)]


def insulted(n=200):
    rnd, insult = random.Random(8), ["moronic", "scumbag", "imbecile"]
    texts = [sentence(rnd, 25) + (f" {rnd.choice(insult)}" if i % 4 == 0 else "") for i in range(n)]
    return texts, [int(i % 4 == 0) for i in range(n)]


def test_scores_equal_brute_force():
    texts, labels = insulted()
    model = toxicity.fit(bags(texts, labels), landmarks=30)
    marks = [plain_weights(m) for m in model.landmarks]

    def plain_score(text):
        worst = 2 * model.bias - 1
        units = {"".join(c for c in w if c.isalpha()) for w in text.lower().split()} - {""}
        windows = [plain_weights(u[i : i + 16]) for u in units for i in range(max(1, len(u) - 15))]
        if windows:
            worst = max(sum(a * plain_kernel(w, m) for a, m in zip(model.alpha, marks)) + model.bias for w in windows)
        return 1 / (1 + np.exp(-(model.slope * worst + model.offset)))

    odd = ["", "...", "x" * 40, "a", "an imbXecile here", "12 34", "abcdefghijklmnopqrstuvwxyz", *texts[:6]]
    got = [float(model.scores(np.array([max(model.decisions(sorted(toxicity.units_of(t))), default=model.least)]))[0]) for t in odd]
    assert np.allclose(got, [plain_score(t) for t in odd], atol=1e-4)


def test_altered_insults_are_told():
    texts, labels = insulted()
    model = toxicity.fit(bags(texts, labels))
    for u in ("moronic", "scumbag", "imbecile"):
        inserted = [u[:i] + c + u[i:] for i in range(1, len(u)) for c in "xqaeoz"]
        doubled = [u[:i] + u[i - 1] + u[i:] for i in range(1, len(u) + 1)]
        dropped = [u[:i] + u[i + 1 :] for i in range(1, len(u) - 1)]
        for forms in (inserted, doubled, dropped):
            assert (model.scores(model.decisions(forms)) >= 0.5).mean() >= 0.9
    assert (model.scores(model.decisions(sorted(set(WORDS + SPANISH)))) < 0.5).all()


def test_machine_is_the_least_of_its_risk():
    rng = np.random.default_rng(1)
    x, y, cost = rng.normal(size=(60, 4)), rng.choice([-1.0, 1.0], 60), rng.uniform(0.5, 2, 60)
    w, b = toxicity.support_vectors(x, y, cost)
    risk = lambda w, b: 1.5 * w @ w + (cost * np.maximum(0, 1 - y * (x @ w + b)) ** 2).sum()
    least = risk(w, b)
    assert all(risk(w + d[:4], b + d[4]) >= least - 1e-6 for d in rng.normal(scale=0.05, size=(300, 5)))


def test_units():
    assert toxicity.units_of("You i d i o t, w.o-r_m! 12 ÉCLAIR") >= {"you", "idiot", "worm", "éclair"}
    assert toxicity.units_of(None) == set() and toxicity.windows_of("a" * 40)[-1] == "a" * 16
    assert "".join(dict.fromkeys("".join(toxicity.windows_of("abcdefghijklmnopqrstuvwxyz")))) == "abcdefghijklmnopqrstuvwxyz"


def test_no_window_cuts_an_insult():
    for at in range(30):
        unit = "q" * at + "disgustingness"[:13] + "q" * 20
        assert any("disgustingness"[:13] in w for w in toxicity.windows_of(unit))


def test_token_counts(spark, docs, none):
    encode = tokencount.encoder().encode_ordinary
    lengths = [len(encode(r[1])) if r[1] else 0 for r in corpus()]
    assert sorted(r.n_tokens for r in tokencount.token_lengths(docs).collect()) == sorted(lengths)
    got = {r.n_tokens: r for r in tokencount.length_histogram(tokencount.token_lengths(docs)).collect()}
    assert got.keys() == set(lengths)
    for n, r in got.items():
        longer = [x for x in lengths if x > n]
        assert (r.n_docs, r.docs_longer, r.tokens_longer, r.truncated_total) == (lengths.count(n), len(longer), sum(longer), sum(min(x, n) for x in lengths))
        assert r.quantile == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    assert tokencount.length_histogram(tokencount.token_lengths(none)).collect() == []
