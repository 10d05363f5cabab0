import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import corpus
from tracewright.llm import simhash


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, radius=4):
    """Component of each value, by its least index, from all pairs."""
    own = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius and own[i] != own[j]:
                a, b = sorted((own[i], own[j]))
                own = [a if x == b else x for x in own]
    return own


def near_values(n=300, seed=1, flips=6):
    rnd = random.Random(seed)
    centers = [rnd.getrandbits(64) for _ in range(12)]
    out = {0, (1 << 64) - 1}
    while len(out) < n:
        x = rnd.choice(centers)
        for _ in range(rnd.randrange(flips)):
            x ^= 1 << rnd.randrange(64)
        out.add(x if rnd.random() < 0.8 else rnd.getrandbits(64))
    return sorted(out)


@pytest.mark.parametrize("text", ["", None, "One", "a b c", "A b\tc D\x0be", "é É ß\n", "w " * 9 + "x" * 20000, "a b c d e f g h " * 50])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    b = a.copy()
    for _ in range(8):
        some = rng.random(1000) < 0.5
        b[some] ^= np.uint64(1) << rng.integers(0, 64, some.sum()).astype(np.uint64)
    assert (simhash.link_pairs(a, b, radius) == (np.bitwise_count(a ^ b) <= radius)).all()


@pytest.mark.parametrize("n", [2, 63, 64, 65, 300])
def test_forest_connects_what_links_connect(n):
    values = near_values(n)
    member, root = simhash.forest(np.array(values, np.uint64), 4)
    assert all((a in values) and (b in values) for a, b in zip(member.tolist(), root.tolist()))
    at = {v: i for i, v in enumerate(values)}
    own = list(range(n))
    for a, b in zip(member.tolist(), root.tolist()):
        x, y = sorted((own[at[a]], own[at[b]]))
        own = [x if v == y else v for v in own]
    assert own == groups(values) and len(member) < n


@pytest.mark.parametrize("chunk", [8192, 20])
def test_edges_and_components_equal_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "SMALL", 4 if chunk == 20 else 32)
    values = near_values(400, 7)
    df = spark.createDataFrame([(np.uint64(v).view(np.int64).item(),) for v in values], "fp long")
    found = simhash.components(simhash.link_edges(df, chunk=chunk))
    label = {np.int64(r.node).view(np.uint64).item(): r.root for r in found.collect()}
    expected = groups(values)
    by = {}
    for v, g in zip(values, expected):
        by.setdefault(g, []).append(v)
    for members in by.values():
        if len(members) > 1:
            roots = {label.get(v, np.uint64(v).view(np.int64).item()) for v in members}
            assert len(roots) == 1
        else:
            assert members[0] not in label


def test_long_chain(spark):
    rows = [(i, i + 1) for i in range(200)] + [(500, 501)]
    found = simhash.components(spark.createDataFrame(rows, "a long, b long"))
    assert {(r.node, r.root) for r in found.collect() if r.node != r.root} == {(i, 0) for i in range(1, 201)} | {(501, 500)}


def test_operator_on_odd_rows(docs):
    data = corpus()
    prints = [plain_fingerprint(r[1]) for r in data]
    own = groups(prints)
    least = {}
    for r, g in zip(data, own):
        least[g] = min((x for x in (least.get(g), r[0]) if x is not None), default=None)
    expected = sorted(((r[0], f"{p:016x}", least[g]) for r, p, g in zip(data, prints, own)), key=repr)
    assert sorted((tuple(r) for r in simhash.near_duplicates(docs).collect()), key=repr) == expected


def test_one_of_each(docs, none):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    named = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs.where("doc_id != 1")).collect()}
    ids = [r.doc_id for r in kept.where("doc_id is not null").collect()]
    assert len(ids) == len(set(ids)) and {i for i in ids if i != 1} == {c for i, c in named.items() if i == c and i != 1}
    assert kept.where(F.col("doc_id").isNull()).count() == 2
    assert simhash.near_duplicates(none).collect() == [] and simhash.one_of_each(none).collect() == []


def test_one_of_each_decides_by_row(spark):
    x, y, z, n = ("alpha beta gamma delta river stone", "song bird wind cloud tree water light", "house of the rising moon over hills", "nobody wrote this line of plain words")
    cases = [
        ([(3, x), (5, x), (5, y)], {(3, x), (5, y)}),
        ([(3, x), (5, x), (5, y), (5, y), (8, y)], {(3, x), (5, y)}),
        ([(None, n), (None, n), (None, n), (1, z)], {(None, n), (1, z)}),
    ]
    for rows, expected in cases:
        kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
        assert len(kept) == len(expected) and {tuple(r) for r in kept} == expected
    # two texts that share their least id: each is stood for, one by its next id
    kept = [tuple(r) for r in simhash.one_of_each(spark.createDataFrame([(5, x), (5, y), (7, x), (7, y), (9, z)], "doc_id long, text string")).collect()]
    assert sorted(i for i, _ in kept) == [5, 7, 9] and {t for _, t in kept} == {x, y, z}


def test_no_join_is_broadcast_by_estimate(spark, docs, monkeypatch):
    """Spark takes each fingerprint's 35 keys for one row, and so broadcast the keys of 240 thousand fingerprints."""
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"
    plans, write = [], simhash.materialize

    def plan(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(simhash, "materialize", lambda df, name: write(plan(df), name))
    plan(simhash.link_edges(spark.range(1000).select(F.xxhash64("id").alias("fp"))))
    plan(simhash.near_duplicates(docs))
    plan(simhash.one_of_each(docs))
    assert sum("Join" in p for p in plans) > 8 and not any("Broadcast" in p for p in plans)
