"""Rules and text functions against plain Python on random and odd values."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tracewright.functions import jsonx, text
from tracewright.operators import rules

MODELS = [
    "claude-opus-4-5", "claude-opus-4-20250514", "anthropic/claude-opus-4.6@x", "opus-45", "claude-3-opus-20240229", "CLAUDE-OPUS-4_5", "opus_5", "gpt-5", "gpt5", "gpt-5-mini", "gpt-5.5-mini", "openai/gpt_5:x",
    "gpt-4.5", "gpt-4-5-preview", "gpt-50", "xgpt-5", "", "claude-opus-4-4", "opus-10-1", "opus-99999999999999999999", None,
]


def plain_model(name):
    if not name:
        return False
    m = re.search(r"(?:^|[/.\-_])opus[-_](\d+)(?:(?:[-_.])(\d{1,2}))?(?:[-_.@:]|$)", name, re.I)
    if m and not re.search(r"(?:^|[/.\-_])3[-_]opus(?:[-_.@:]|$)", name, re.I) and len(m[1]) < 18 and (int(m[1]), int(m[2] or 0)) >= (4, 5):
        return True
    return not re.search(r"gpt[-_]?4[-_.]5\b", name, re.I) and not re.search(r"(?:^|[/.\-_])gpt[-_]?5[-_](?:mini|nano)(?:$|[-_.@:])", name, re.I) and bool(re.search(r"(?:^|[/.\-_])gpt[-_]?5(?:$|[-_.@:])", name, re.I))


def test_models(spark):
    df = spark.createDataFrame([(m,) for m in MODELS], "model string")
    got = [r[0] is None for r in df.select(rules.model_match(F.coalesce("model", F.lit("")))).collect()]
    assert got == [plain_model(m) for m in MODELS]


ODD = st.text(alphabet=" \t\n\r\x1c\x85\xa0  aAbÉİẞ_|:/\\<>.", max_size=30)


@settings(max_examples=5, deadline=None)
@given(st.lists(ODD, min_size=40, max_size=60))
def test_text_functions(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    x = F.col("x")
    got = df.select("x", text.folded(x), text.strip(x), text.without_space(x), text.file_name(x), text.sidecar_segment(x)).collect()
    for v, folded, stripped, plain, name, segment in got:
        assert folded == " ".join(v.strip().lower().split()) and stripped == v.strip()
        assert plain == re.sub("[ \n\r\t]", "", v) and name == re.sub(r"[:/\\<>|]", "_", v)
        assert segment == ("_".join(p for p in re.sub(r"[:/\\<>|]", "_", v).split("_") if p and p != "..") or "unsafe")


def test_byte_sizes_round_like_python(spark):
    sizes = [0, 1023, 1024, 430336, 1536, 1 << 20, 1300000, (1 << 30) - 1, 1 << 30, 5 << 31]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in sizes], "n long").select(text.byte_size(F.col("n"))).collect()]

    def plain(n):
        for unit, name in ((1 << 30, "GiB"), (1 << 20, "MiB"), (1 << 10, "KiB")):
            if n >= unit:
                return f"{n / unit:.1f} {name}"
        return f"{n} B"

    assert got == [plain(s) for s in sizes]


@pytest.mark.parametrize(
    "raw, kind",
    [('{"a": 1}', "object"), ('{"a": 1} x', None), ('{"a":1},{"b":2}', None), ("[1]", "list"), ('"s"', "string"), ("", None), ("nul", None), ('{"a":1,"a":2}', "object")],
)
def test_strict_parsing(spark, raw, kind):
    df = spark.createDataFrame([(raw,)], "raw string").select(jsonx.parse(F.col("raw")).alias("v"))
    r = df.select(jsonx.is_object(F.col("v")), jsonx.items(F.col("v")).isNotNull(), jsonx.string(F.col("v")).isNotNull(), F.try_variant_get("v", "$.a", "int")).first()
    assert (kind == "object", kind == "list", kind == "string") == tuple(r[:3])
    if raw.count('"a"') == 2:
        assert r[3] == 2
