import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, h bigint, p int, m array<string>"
WORDS = "alpha beta gamma delta the of and to in is river stone house light water tree cloud wind bird song".split()
SPANISH = "el la los que casa arbol rio piedra viento canta noche luz agua sol luna mar".split()


def sentence(rnd, n, words=WORDS):
    return " ".join(rnd.choice(words) for _ in range(n))


def corpus():
    """Rows with nulls in every column, empty and long texts, ties, repeats and columns whose names clash with inner ones."""
    rnd = random.Random(3)
    out = [(i, sentence(rnd, rnd.randrange(12, 60)) + ".", "en", f"s{i % 4}") for i in range(60)]
    out += [(100 + i, sentence(rnd, rnd.randrange(12, 60), SPANISH), "es", "s9") for i in range(40)]
    base = sentence(rnd, 400)
    out += [(200 + i, base + " end" * (i % 2), "en", "s0") for i in range(6)]
    out += [(300, None, "en", "s1"), (301, "", None, None), (302, " \t\n", "en", ""), (303, "12 34 5678", None, "s1"), (None, "no id at all here", "en", "s1"), (None, base, None, None)]
    out += [(304, "x" * 30000 + " y", "en", "s2"), (305, "word " * 5000, "en", "s2"), (306, "É̄ ÀÇ ñ Ünd 你好 世界 🎉", "fr", "s3")]
    out += [out[0], out[0], (1, "another text under an id that was there", "en", "s0")]
    return [(i, t, x, s, len(t) if t else None, "k", 1, 2, ["z"]) for i, t, x, s in out]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
