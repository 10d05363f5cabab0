"""Queries read whole texts, however long."""

import pytest

from tracewright.plans import queries

LONG = "a|b " * 500


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("long"))
    texts = [(i, LONG + f"end{i}") for i in range(8)] + [(10, "x" * 60 + " <cwd>/deep</cwd>")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{out}/documents.parquet")
    turns = [(1, k, "user", t) for k, t in enumerate(["same start, one", "same start, two", "same start, one", LONG[:120] + "1", LONG[:120] + "2"])]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{out}/conversations.parquet")
    return out


def of(spark, folder, name):
    return {r[0]: r for r in queries.QUERIES[name](spark, folder).collect()}


def test_ends_of_long_texts_are_read(spark, folder):
    assert of(spark, folder, "e3_cwd")[10].cwd == "/deep"
    cells, contents, answers = (of(spark, folder, n) for n in ("f7_cell", "n10_content_text", "p8_chunk_merge"))
    for i in range(8):
        assert cells[i].cell == (LONG + f"end{i}|").replace("|", "\\|")
        assert contents[i].joined == ("" if i % 4 == 2 else LONG + f"end{i}" + {0: "", 1: "\ntwo", 3: "\no"}[i % 4])
        assert answers[i].answer == LONG + f"end{i}"


def test_ids_and_keys_see_past_the_cut(spark, folder):
    import hashlib

    tools = '[{"function":{"description":"","name":"f","parameters":{}},"type":"function"}]'
    for i, r in of(spark, folder, "h2_canonical_session").items():
        if i < 8:
            assert r.session_id == "session_" + hashlib.md5((tools + "systemstold" + "user" + LONG + f"end{i}" + "tool" + f"r{i}").replace(" ", "").encode()).hexdigest()
    assert of(spark, folder, "d8_in_array")[1].turns == "0,1,3"
