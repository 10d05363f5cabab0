"""The pipeline's rows against the operators applied one row at a time."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import sentence
from tests.llm.test_decontaminate import brute
from tests.llm.test_models import junk
from tests.llm.test_simhash import groups, plain_fingerprint
from tracewright.llm import pii, quality_classifier

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(8)
    out = str(tmp_path_factory.mktemp("tables"))
    items = [(i, sentence(rnd, 15)) for i in range(4)]
    docs = [(i, junk(rnd, 30) if i % 6 == 0 else sentence(rnd, rnd.randrange(30, 90))) for i in range(150)]
    docs += [(200 + i, docs[7][1]) for i in range(4)] + [(300 + i, sentence(rnd, 20) + " " + items[i][1]) for i in range(4)]
    docs += [(400 + i, sentence(rnd, 20) + f" mail{i}@example.com and +1 (555) 123-45{i}7") for i in range(9)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in docs]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    spark.createDataFrame([(i, int(i % 6 != 0 or i >= 200), 0) for i, *_ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return out, rows, items


def test_stages_and_run(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = quality_classifier.train(docs, spark.read.parquet(f"{path}/labels.parquet"), quality_classifier.learnable())
    import numpy as np

    left = [r for r in rows if model.scores(np.array([quality_classifier.features_of(r[1])]))[0] >= quality_classifier.CUT]
    assert {r[0] for r in rows} - {r[0] for r in left} == {i for i in range(150) if i % 6 == 0}
    own = groups([plain_fingerprint(r[1]) for r in left])
    left = [r for i, r in enumerate(left) if own[i] == i]
    hit = {x[0] for x in brute([r[:2] for r in left], items) if x[-1]}
    left = [r for r in left if r[0] not in hit]
    assert hit == {300, 301, 302, 303}

    stage = docs
    for k, (name, f) in enumerate(corpus_pipeline.STAGES):
        stage = f(spark, stage, path)
        stage.write.parquet(f"{path}/out{k}")
        stage = spark.read.parquet(f"{path}/out{k}")
        if k < 4:
            assert stage.columns == docs.columns, name
        if k == 2:
            assert sorted(map(tuple, stage.collect())) == sorted(left)
    texts = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(left, DOCS)).collect()}
    assert all("@" not in t and "555" not in t for t in texts.values())
    last = stage.collect()
    assert all(r.text == texts[r.doc_id] and r.n_chars == len(r.text) and 1 <= r.epoch <= r.repetitions <= 3 for r in last)
    again = corpus_pipeline.run(spark, path).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, last))


def staged(spark, docs, path, where):
    """What each stage leaves, written and reread as the next one's input."""
    out = []
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, docs, path).write.parquet(f"{where}/{k}")
        docs = spark.read.parquet(f"{where}/{k}")
        out.append(docs)
    return out


def test_odd_documents(spark, folder, docs, tmp_path):
    path, columns = folder[0], ["doc_id", "text", "lang", "source", "n_chars"]
    good, unique, clean, redacted, mixed = staged(spark, docs, path, str(tmp_path))
    ids = lambda df: sorted((r.doc_id is None, r.doc_id) for r in df.select("doc_id").collect())
    assert all(x.columns == columns for x in (good, unique, clean, redacted))
    model = quality_classifier.train(docs, spark.read.parquet(f"{path}/labels.parquet"), quality_classifier.learnable())
    scores = quality_classifier.score(docs.select(*columns), model, columns)
    assert ids(good) == ids(scores.where(F.col("score") >= quality_classifier.CUT))
    # each group of near copies that a stage gets leaves one row
    left = [tuple(r) for r in good.collect()]
    own = groups([plain_fingerprint(r[1]) for r in left])
    assert unique.count() == len(set(own))
    assert unique.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").count() == 0
    # no benchmark passage is in these rows, and null and empty texts hold none
    assert ids(clean) == ids(unique) == ids(redacted)
    assert [(r.text is None, r.n_chars is None) for r in redacted.where("text is null or n_chars is null").collect()] == [(True, True)] * clean.where("text is null").count()
    for r in mixed.groupBy("doc_id", "text", "repetitions").agg(F.count("*").alias("n"), F.min("epoch").alias("a"), F.max("epoch").alias("b")).collect():
        assert (r.n, r.a, r.b) == (r.repetitions, 1, r.repetitions) and 1 <= r.repetitions <= 3
    assert set(map(tuple, mixed.select("doc_id", "text").collect())) <= set(map(tuple, redacted.select("doc_id", "text").collect()))


def test_empty_documents(spark, folder, docs, tmp_path):
    for stage in staged(spark, docs.select("doc_id", "text", "lang", "source", "n_chars").limit(0), folder[0], str(tmp_path)):
        assert stage.count() == 0
