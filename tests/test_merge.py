import json

import pytest

from tests.samples import INPUT, envelope, write_lines
from tracewright import cli
from tracewright.plans import merge


def trace(sid, n):
    said = [{"type": "response_item", "payload": {"type": "message", "role": "user", "content": []}}] * n
    return [{"type": "session_meta", "payload": {"id": sid}}, *said, {"type": "response_item", "payload": {"type": "reasoning"}}]


@pytest.fixture
def days(tmp_path):
    for day, traces, valid in (("20250101", {"a": ("client:aaa-bbb", 2), "b": ("unknown-session", 3)}, 2), ("20250102", {"c": ("client:aaa-bbb", 4), "d": ("", 1), "e": ("x", 1)}, 3)):
        for name, (sid, n) in traces.items():
            write_lines(tmp_path / "days" / day / "traces" / f"{name}.jsonl", trace(sid, n))
        report = {"scanned": 10, "trace_valid": valid, "export_total": valid, "elapsed_seconds": 10.7, "drop_reasons": {"no_tools": 2}, "size_warnings": [{"kind": "file"}]}
        (tmp_path / "days" / day / "report.json").write_text(json.dumps(report))
    return tmp_path


def test_longest_trace_over_days_wins_and_nameless_ones_go(spark, days):
    m = merge.merge_traces(spark, str(days / "days"), str(days / "out"))
    assert (m["pre_filter_files"], m["post_filter_files"], m["post_dedup_files"]) == (5, 3, 2)
    assert (m["discarded_unknown_session"], m["cross_day_duplicates"]) == (2, 1)
    assert sorted(p.name for p in (days / "out/traces").iterdir()) == ["client_aaa-bbb.jsonl", "x.jsonl"]
    assert len((days / "out/traces/client_aaa-bbb.jsonl").read_text().splitlines()) == 6
    r = merge.merge_reports(spark, str(days / "days"), str(days / "out"))
    assert (r["scanned"], r["elapsed_seconds"], r["elapsed_seconds_max"]) == (20, 20, 10.7)
    assert r["drop_reasons"] == {"no_tools": 4} and len(r["size_warnings"]) == 2
    assert [(d["date"], d["discarded_unknown_session"], d["kept_after_quality_filter"]) for d in r["per_day"]] == [("20250101", 1, 1), ("20250102", 1, 2)]
    assert r["cross_day_dedup"] == {"duplicate_session_keys": 1, "post_dedup_files": 2}


def test_dry_run_writes_only_the_manifest(spark, days):
    merge.merge_traces(spark, str(days / "days"), str(days / "out"), dry=True)
    assert [p.name for p in (days / "out").iterdir()] == ["merge_manifest.json"]


def test_command_line(spark, tmp_path):
    write_lines(tmp_path / "in/a.jsonl", [envelope(), envelope("two", inp=INPUT[:2])])
    assert cli.main(["clean", str(tmp_path / "in"), str(tmp_path / "in/out"), "--clean-output", "--training-rows"]) == 0
    r = json.loads((tmp_path / "in/out/report.json").read_text())
    assert (r["scanned"], r["filter_kept"], r["trace_valid"]) == (2, 1, 1)
    assert cli.main(["clean", str(tmp_path / "in"), str(tmp_path / "in/out"), "--limit-records", "1"]) == 0
    assert cli.main(["clean", str(tmp_path / "nowhere"), str(tmp_path)]) == 2
