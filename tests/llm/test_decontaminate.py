import hashlib
import random
import re

import pytest

from tests.llm.conftest import WORDS, corpus, sentence
from tracewright.llm import decontaminate


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if got := windows.get(tuple(w[k : k + n])):
                    found |= got
                    hit.update(range(k, k + n))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(str(x) for x in found if x is not None)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def check(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string, doc_id string")
    got = sorted((tuple(r) for r in decontaminate.contamination(d, b).collect()), key=repr)
    assert got == brute(docs, [x[:2] for x in items])
    return got


def test_planted_passages(spark):
    rnd = random.Random(2)
    items_shared = sentence(rnd, 25)
    items = [(i, sentence(rnd, rnd.randrange(10, 40)).title(), "x") for i in range(12)] + [(20, "stone house", "x"), (21, "river", "x"), (22, None, "x"), (23, " -- ", "x"), (None, sentence(rnd, 20), "x"), (None, "tiny nameless", "x"), (24, "same " * 30, "x"), (25, "same same", "x"), (26, items_shared, "x"), (27, items_shared, "x")]
    docs = []
    for i in range(60):
        text = sentence(rnd, rnd.randrange(0, 80), [w for w in WORDS if w not in ("river", "stone")])
        if i % 3 == 0:
            own = words(rnd.choice(items[:12])[1])
            a = rnd.randrange(0, max(1, len(own) - 9))
            text += " -- " + "\n".join(own[a : a + rnd.randrange(8, 20)]) + " " + text
        docs.append((i, text))
    docs += [(100, "same " * 50), (101, "a river; STONE\thouse"), (102, None), (103, ""), (None, items[0][1]), (103, ""), (7, items[3][1]), (104, items[5][1] * 40), (105, items[5][1] + " " + items[5][1])]
    docs += [(106, "x " + items[16][1] + " x"), (107, "a TINY nameless one, tiny nameless"), (108, items_shared * 3), (109, items[16][1] + " " + items[3][1])]
    got = check(spark, docs, items)
    assert sum(r[-1] for r in got) > 20


def test_two_word_alphabet_has_many_ties(spark):
    rnd = random.Random(4)
    check(spark, [(i, sentence(rnd, 60, ["a", "b"])) for i in range(30)], [(i, sentence(rnd, 14, ["a", "b"]), "") for i in range(30)])


@pytest.mark.parametrize("items", [[], [(1, None, "")], [(1, "one two", "")]])
def test_few_or_no_items(spark, docs, items):
    b = spark.createDataFrame(items, "item_id long, text string, doc_id string")
    got = sorted((tuple(r) for r in decontaminate.contamination(docs, b).collect()), key=repr)
    assert got == brute([r[:2] for r in corpus()], [x[:2] for x in items])


def test_clean_keeps_columns_and_drops_hits(spark, docs, none):
    b = spark.createDataFrame([(1, "under an id that was there", "")], "item_id long, text string, doc_id string")
    kept = decontaminate.clean(docs, b)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    assert decontaminate.clean(none, b).count() == 0 and decontaminate.contamination(none, b).count() == 0


def test_clean_drops_passages_of_items_without_id(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    d = spark.createDataFrame([(1, "before " + passage + " after"), (2, "tiny item here"), (3, "nothing of it")], "doc_id long, text string")
    b = spark.createDataFrame([(None, passage), (None, "tiny item")], "item_id long, text string")
    assert [r.doc_id for r in decontaminate.clean(d, b).collect()] == [3]


def test_sql_gives_the_same_rows(spark):
    import duckdb
    import pandas as pd

    from tracewright.llm.oracles import OP7

    rnd = random.Random(11)
    items = [(1, sentence(rnd, 20)), (None, sentence(rnd, 15)), (2, "stone house"), (None, "river song"), (3, None)]
    docs = [(i, sentence(rnd, 40) + (" " + items[i % 2][1] if i % 3 == 0 else "")) for i in range(30)] + [(40, None), (41, "a river song")]
    con = duckdb.connect()
    for name, rows, columns in (("documents", docs, ["doc_id", "text"]), ("benchmark", items, ["item_id", "text"])):
        con.register(name, pd.DataFrame(rows, columns=columns).astype({columns[0]: "Int64"}))
    expected = sorted(con.sql(OP7).fetchall())
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect())) == expected and sum(r[-1] for r in expected) > 10


def test_clean_with_any_column_names(spark):
    d = spark.createDataFrame([(1, "nine tiny items here", 1, 2, 3, 4), (2, None, 1, 2, 3, 4), (None, "", 1, 2, 3, 4)], "doc_id long, text string, _hit int, _r1 int, _row int, w1 int")
    b = spark.createDataFrame([(1, "tiny items")], "item_id long, text string")
    kept = decontaminate.clean(d, b)
    assert kept.columns == d.columns and sorted(map(repr, kept.select("doc_id").collect())) == ["Row(doc_id=2)", "Row(doc_id=None)"]
