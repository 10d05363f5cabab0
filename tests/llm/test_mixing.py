import random
import re

import pytest

from tests.llm.conftest import corpus
from tracewright.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in open_}
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ -= over
    return out


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_repeated_redistribution(spark, seed):
    rnd = random.Random(seed)
    sizes = {f"s{i}": rnd.choice([0, 1, 5, 50, 1000, 30000]) for i in range(rnd.randrange(1, 15))} | {None: 7, "é": 3, "Z": 9}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.water_fill(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_mix_of_odd_rows(docs, none):
    data = corpus()
    first, again = (sorted((tuple(r) for r in mixing.mix(d, keep=("source",)).collect()), key=repr) for d in (docs, docs.repartition(5)))
    assert first == again and len(first) == len(data)
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    sizes = {}
    for r in data:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    target = plain_targets(sizes)
    assert sorted((r[0], r[1]) for r in first if r[0] is not None) == sorted((r[0], size(r[1])) for r in data if r[0] is not None)
    taken = {}
    for _, n, whole, t, reps, words, source in first:
        assert whole == sizes[source] and t == pytest.approx(target[source]) and words == reps * n and 0 <= reps <= 3
        taken[source] = taken.get(source, 0) + words
    for s in sizes:
        largest = max(size(r[1]) for r in data if r[3] == s)
        assert target[s] - largest <= taken[s] <= target[s] * (1 + 1e-9)
    assert mixing.mix(none).collect() == []


def test_hot_source_and_huge_documents(spark):
    rnd = random.Random(1)
    data = [(i, "w " * (rnd.choice([3, 10, 40]) if i % 100 else 900), "hot" if i % 3 else f"s{i % 7}") for i in range(1500)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    out = mixing.mix(df, keep=("source",)).toPandas().groupby("source").agg({"taken": "sum", "target": "first"})
    assert ((out.taken - out.target).abs() < 0.01 * out.target + 10).all()
