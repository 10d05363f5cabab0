import gzip
import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from tests.samples import INPUT, answer, envelope, write_lines
from tracewright.plans import clean, report
from tracewright.sources import delivery


def run(spark, folder, **kw):
    out = clean.clean(spark, delivery.read(spark, str(folder)), stamp="2025-01-01T00:00:00.000Z", **kw)
    return out, report.build(out)


CALL = [{"type": "function_call", "name": "shell", "arguments": "{}", "call_id": "z"}]
PLAIN = [{"role": r, "content": f"turn {i}"} for i, r in enumerate(["user", "assistant"] * 3)]
BEAT = [*INPUT, {"role": "user", "content": "[OpenClaw heartbeat poll]"}]


@pytest.mark.parametrize(
    "record, reasons",
    [
        (envelope(), []),
        (envelope(model="claude-3-5-sonnet-20241022"), ["model_not_target_family"]),
        (envelope(tools=[]), ["no_tools"]),
        (envelope(inp=INPUT[:4]), ["messages_le_5"]),
        (envelope(inp=[m for m in INPUT if m.get("role") != "developer"] + [INPUT[1]], instructions=""), ["no_system_prompt"]),
        (envelope(response=answer(CALL)), ["stop_reason_tool_calls"]),
        (envelope(inp=PLAIN), ["no_assistant_tool_call"]),
        (envelope(inp=BEAT), ["heartbeat_non_task_traffic"]),
        (envelope(inp=[*INPUT, {"role": "user", "content": "[SLIENT]"}]), ["silent_keepalive_marker"]),
        (envelope(response=answer(status="incomplete")), ["stop_reason_missing"]),
    ],
)
def test_each_rule(spark, tmp_path, record, reasons):
    write_lines(tmp_path / "a.jsonl", [record])
    out, _ = run(spark, tmp_path)
    assert [r.reasons for r in out.judged.collect()] == [reasons]


def test_longest_of_a_session_wins_in_either_order(spark, tmp_path):
    short, long = envelope("s"), envelope("l", inp=[*INPUT, *INPUT[2:4]])
    write_lines(tmp_path / "up" / "a.jsonl", [short, long])
    write_lines(tmp_path / "down" / "a.jsonl", [long, short])
    out, up = run(spark, tmp_path / "up")
    assert (up["filter_kept"], up["dedup_dropped"], up["trace_valid"]) == (2, 0, 1)
    assert [r.session_key for r in out.traces.collect()] == ["l"]
    _, down = run(spark, tmp_path / "down")
    assert (down["dedup_dropped"], down["drop_reasons"]) == (1, {"session_id_duplicate": 1})


def test_equal_length_keeps_the_first_file(spark, tmp_path):
    write_lines(tmp_path / "a.jsonl", [envelope("first")])
    write_lines(tmp_path / "b.jsonl", [envelope("second")])
    out, r = run(spark, tmp_path)
    assert r["dedup_dropped"] == 1 and [t.session_key for t in out.traces.collect()] == ["first"]


def test_malformed_lines_are_counted_apart(spark, tmp_path):
    write_lines(tmp_path / "a.jsonl", [{"response": "{}"}, {"request": 1, "response": "{}"}, envelope(response="not valid json or sse"), "not json", "", "[1]"])
    _, r = run(spark, tmp_path)
    assert (r["scanned"], r["json_line_errors"], r["parse_errors"]) == (5, 2, 5)
    assert r["unwrap_failures"] == {"request_not_string": 2, "response_parse_error": 1}


def test_gzip_and_tar_read_like_plain_files_and_unsafe_members_are_left(spark, tmp_path):
    text = (json.dumps(envelope()) + "\n\n" + json.dumps(envelope("two", inp=INPUT[:3])) + "\n").encode()
    (tmp_path / "b.jsonl.gz").write_bytes(gzip.compress(text))
    with tarfile.open(tmp_path / "c.tar.gz", "w:gz") as tar:
        for name in ("../../evil.jsonl", "safe.jsonl", "d/two.jsonl", "x.txt"):
            info = tarfile.TarInfo(name)
            info.size = len(text)
            tar.addfile(info, io.BytesIO(text))
    lines = [(r.source_file, r.source_line) for r in delivery.read(spark, str(tmp_path)).orderBy(*clean.ORDER).collect()]
    assert lines == [("b.jsonl.gz", 1), ("b.jsonl.gz", 3), ("c.tar.gz:safe.jsonl", 1), ("c.tar.gz:safe.jsonl", 3), ("c.tar.gz:d/two.jsonl", 1), ("c.tar.gz:d/two.jsonl", 3)]
    meta = delivery.tar_warnings(spark, str(tmp_path)).first()
    assert (meta.archive, meta.jsonl_member_count, meta.used_members) == ("c.tar.gz", 2, ["safe.jsonl", "d/two.jsonl"])


def test_large_files_and_lines_are_reported(spark, tmp_path):
    write_lines(tmp_path / "a.jsonl", ["{}", '{"a": "' + "x" * 400 + '"}'])
    got = [(r.kind, r.size_bytes) for r in delivery.size_warnings(delivery.read(spark, str(tmp_path), max_bytes=100)).collect()]
    assert got == [("file", (tmp_path / "a.jsonl").stat().st_size)]


def test_excluded_folder_is_not_scanned(spark, tmp_path):
    write_lines(tmp_path / "a.jsonl", [envelope()])
    write_lines(tmp_path / "out" / "b.jsonl", [envelope()])
    assert delivery.read(spark, str(tmp_path), exclude_dirs=str(tmp_path / "out")).count() == 1


def test_events_are_ordered_and_not_repeated(spark, tmp_path):
    again = [{"type": "function_call", "name": "shell", "arguments": "{}", "call_id": "c1"}, *json.loads(answer())["output"]]
    write_lines(tmp_path / "a.jsonl", [envelope(response=answer(again))])
    out, _ = run(spark, tmp_path)
    t = out.traces.first()
    assert [e.type for e in t.events] == ["session_meta", "turn_context", *["response_item"] * 7, "event_msg"]
    meta = json.loads(str(t.events[0].payload))
    assert (meta["id"], meta["cwd"], meta["base_instructions"]) == ("client:pass-1", "/src/app", {"text": "Be brief"})
    assert json.loads(str(t.events[-1].payload))["info"]["total_token_usage"] == {"input_tokens": 10, "output_tokens": 5, "total_tokens": 15}
    assert (t.route, t.last_relevant_role, t.trace_name) == ("valid", "assistant", "client_pass-1.jsonl")


def test_traces_and_sidecars_are_written(spark, tmp_path):
    write_lines(tmp_path / "in" / "a.jsonl", [envelope(), envelope("bad", tools=[])])
    out, r = run(spark, tmp_path / "in")
    clean.write(out, str(tmp_path / "out"), keep_dropped=True, keep_unwrapped=True)
    lines = (tmp_path / "out/traces/client_pass-1.jsonl").read_text().splitlines()
    assert json.loads(lines[0])["type"] == "session_meta" and len(lines) == 10
    assert json.loads((tmp_path / "out/dropped/a.jsonl_2.jsonl").read_text())["_drop_reasons"] == ["no_tools"]
    assert len(list((tmp_path / "out/unwrapped").iterdir())) == 2
    assert "no_tools" in report.markdown(r)


def test_custom_rule(spark, tmp_path):
    from tracewright.operators import rules

    write_lines(tmp_path / "a.jsonl", [envelope()])
    df = clean.judge(delivery.read(spark, str(tmp_path)))
    extra = [*rules.RULES, ("R8_short", lambda: F.when(F.col("n_messages") < 100, F.lit("short")))]
    assert rules.evaluate(df, extra).first().reasons == ["short"]


def test_names_that_sessions_share_are_told_apart(spark):
    rows = [(i, 0, 1, n) for i, n in enumerate(["a.jsonl", "a.jsonl", "a_1.jsonl", "b.jsonl", "a.jsonl"])]
    got = clean.named_apart(spark.createDataFrame(rows, "src_rank int, member_rank int, source_line int, trace_name string")).collect()
    assert len({r.trace_name for r in got}) == 5
    assert {r.src_rank: r.trace_name for r in got}.items() >= {0: "a.jsonl", 2: "a_1.jsonl", 3: "b.jsonl"}.items()


def test_text_functions_are_pythons(spark):
    from pyspark.sql import functions as F

    from tracewright.functions import text
    from tracewright.operators import funnel
    from tracewright.plans import report

    rows = [(3, 2000), (3, 20000), (1, 8), (1, 3), (0, 5), (5, 5), (7, 0)] + [(a, b) for b in (16, 40, 4000, 20000) for a in range(0, b, max(1, b // 300))]
    for r in spark.createDataFrame(rows, "a long, b long").select("a", "b", text.percent(F.col("a"), F.col("b")).alias("p"), funnel.rate(F.col("a"), F.col("b")).alias("r")).collect():
        assert r.p == report.percent_text(r.a, r.b) and r.r == (round(r.a / r.b, 4) if r.b else None)
    strings = ["\u3000 a b \x1f\n", "", " ", "x", None, "\u200bq "]
    for r in spark.createDataFrame([(x,) for x in strings], "s string").select("s", text.strip(F.col("s")).alias("t"), text.table_cell(F.col("s")).alias("c")).collect():
        assert r.t == (None if r.s is None else r.s.strip()) and r.c == ("—" if r.s is None else r.s)


def test_report_texts(tmp_path):
    from tracewright.plans import report

    assert [report.elapsed_text(x) for x in (None, 59.94, 61, 3599, 7260)] == ["—", "59.9s", "1m1s", "59m59s", "2h1m"]
    assert report.describe("no_tools") and report.describe("stop_reason_odd") == "stopped by odd" and report.describe("other") == "—"
    assert report.shown_path(str(tmp_path), True) == str(tmp_path.resolve()) and report.shown_path(".") == "."


def test_path_guards(tmp_path):
    from tracewright.sources import delivery

    (tmp_path / "in").mkdir()
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "x.jsonl").write_text("{}\n")
    (tmp_path / "in" / "a.jsonl").write_text("{}\n")
    (tmp_path / "in" / "link.jsonl").symlink_to(tmp_path / "out" / "x.jsonl")
    assert [n for n, _ in delivery.discover(str(tmp_path / "in"))] == ["a.jsonl"]
    assert delivery.resolve_under(tmp_path, "a/../b").name == "b"
    for bad in ("../x", "/etc/x", "a/../../x"):
        with pytest.raises(ValueError):
            delivery.resolve_under(tmp_path, bad)


def test_validator_by_name(spark, tmp_path, monkeypatch):
    from tracewright import cli
    from tracewright.operators import validators

    (tmp_path / "in").mkdir()
    assert cli.main(["clean", str(tmp_path / "in"), str(tmp_path / "o"), "--validator", "no_such_module_here"]) == 3
    assert validators.available("json") and not validators.available("no_such.module")
