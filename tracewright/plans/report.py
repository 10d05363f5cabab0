"""Funnel reports: one-row aggregates as dictionaries and Markdown."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import funnel
from ..sources import delivery
from .clean import ORDER, Cleaned

DASH = "—"
#: The drop reasons that are told, with what each means.
MEANING = {
    "model_not_target_family": "model is not of a kept family",
    "no_tools": "the request offers no tools",
    "messages_le_5": "the transcript has five messages or fewer",
    "no_assistant_tool_call": "no assistant turn calls a tool",
    "stop_reason_missing": "no stop reason can be told",
    "stop_reason_tool_calls": "the response ends on a call whose result was not yet given",
    "stop_reason_length": "cut off at the most output tokens",
    "stop_reason_content_filter": "cut off by a content filter",
    "stop_reason_end_turn": "stop reason is not one that its format accepts",
    "stop_reason_stop": "stop reason is not one that its format accepts",
    "no_system_prompt": "there is no system prompt",
    "silent_keepalive_marker": "a keep-alive marker occurs",
    "heartbeat_non_task_traffic": "heartbeat traffic, not a task",
    "session_id_duplicate": "a longer record of the session is kept",
}


def describe(reason: str) -> str:
    """What a drop reason means; a dash for one that is not known."""
    other = f"stopped by {reason.removeprefix('stop_reason_')}" if reason.startswith("stop_reason_") else DASH
    return MEANING.get(reason, other)


def elapsed_text(seconds: float | None) -> str:
    """Seconds with a decimal below a minute, then minutes and seconds, then hours and minutes."""
    if seconds is None:
        return DASH
    if seconds < 60:
        return f"{seconds:.1f}s"
    whole = int(seconds // 60)
    return f"{whole}m{seconds - 60 * whole:.0f}s" if whole < 60 else f"{whole // 60}h{whole % 60}m"


def percent_text(part: int, whole: int) -> str:
    return f"{100.0 * part / whole:.1f}%" if whole > 0 else DASH


def shown_path(path: str, absolute: bool = False) -> str:
    """A path as reports show it: relative to the working folder, or absolute; the name alone where neither can be told."""
    full = os.path.realpath(path)
    try:
        return full if absolute else os.path.relpath(full, os.path.realpath(os.curdir))
    except ValueError:
        return os.path.basename(full)


def progress_line(r: dict) -> str:
    """One line on a run: counts, records a second, time."""
    took = r["elapsed_seconds"]
    counts = {"scanned": "scanned", "unwrapped": "unwrapped", "kept": "filter_kept", "dropped": "filter_dropped", "parse_err": "parse_errors", "dedup_drop": "dedup_dropped"}
    return " ".join(f"{k}={r[v]}" for k, v in counts.items()) + f" ({r['scanned'] / took if took > 0 else 0.0:.1f} rec/s, elapsed {elapsed_text(took)})"


def _counter(df: DataFrame, values) -> dict[str, int]:
    return {r.reason: r.n for r in funnel.histogram(df.select(values.alias("v"), F.struct(*ORDER).alias("o")).where("v is not null"), "v", "o").select("reason", "n").collect()}


def share(part: int, whole: int) -> float | None:
    return round(part / whole, 4) if whole else None


def build(out: Cleaned, elapsed: float = 0.0, tar: DataFrame | None = None, list_valid: bool = False) -> dict:
    """The report as a dictionary. What reaches the driver are counts, reason names and warnings."""
    c = funnel.counters(out.judged).first().asDict()
    warnings = [r.asDict() for r in delivery.size_warnings(out.lines).collect()]
    routes = {r.route: r["count"] for r in out.traces.groupBy("route").count().collect()}
    v, i, x = (routes.get(k, 0) for k in ("valid", "incomplete", "invalid"))
    archives = [r.asDict() for r in tar.collect()] if tar is not None else []
    drops = out.judged.withColumn("_r", F.when(F.col("dropped"), F.array(F.lit("session_id_duplicate"))).when(~F.col("passed"), F.col("reasons")))
    report = {
        "elapsed_seconds": round(elapsed, 2),
        "export_total": v + i + x,
        "scanned": c["scanned"],
        # a line that is too large counts as a bad line and as a warning
        "parse_errors": c["record_errors"] + len(warnings),
        "json_line_errors": c["json_line_errors"],
        "unwrap_failures": _counter(out.judged.where("envelope is not null and failure is not null"), F.array("failure")),
        **{k: c[k] for k in ("unwrapped", "filter_kept", "filter_dropped", "dedup_dropped")},
        "trace_valid": v,
        "trace_incomplete": i,
        "trace_invalid": x,
        "funnel": {"valid_rate": share(v, v + i + x), "incomplete_rate": share(i, v + i + x), "invalid_rate": share(x, v + i + x)},
        "drop_reasons": _counter(drops, F.col("_r")),
        "trace_errors": _counter(out.traces.where("error is not null"), F.array("error")),
        **{f"tar_{k}": n for k, n in (funnel.archive_counts(tar).first().asDict() if tar is not None else {"archives_with_multiple_jsonl": 0, "skipped_jsonl_members": 0}).items()},
        "tar_warnings": archives,
        "size_warnings": warnings,
        "trace_results": [r.asDict() for r in out.traces.where("route = 'valid'").select("trace_name", "session_key", "route", "messages_count", "last_relevant_role").collect()] if list_valid else [],
    }
    return report if list_valid or not v else report | {"valid_files_omitted": v}


def _cell(x) -> str:
    return DASH if x is None else str(x).replace("|", "\\|")


def table(head: tuple[str, ...], rows) -> list[str]:
    """A Markdown table and an empty line; a dash in place of one without rows."""
    lines = [f"| {' | '.join(map(_cell, r))} |" for r in rows]
    return [f"| {' | '.join(head)} |", "|" + "---|" * len(head), *lines, ""] if lines else [DASH, ""]


def markdown(report: dict, title: str = "Cleaning report") -> str:
    scanned, exported = report["scanned"], report["export_total"]
    out = [f"# {title}", ""]
    out += [f"* {k}: {report[k]}" for k in ("input_dir", "output_dir", "generated_at") if report.get(k)]
    out += [f"* elapsed: {elapsed_text(report.get('elapsed_seconds'))}", f"* no parse errors: {'yes' if not report['parse_errors'] else 'no'}", f"* valid traces: {'yes' if report['trace_valid'] else 'no'}", "", "## Records", ""]
    steps = ("scanned", "parse_errors", "unwrapped", "filter_kept", "filter_dropped", "dedup_dropped", "export_total", "trace_valid", "trace_incomplete", "trace_invalid")
    out += table(("Step", "Records", "Of all scanned"), ((k, report[k], percent_text(report[k], scanned)) for k in steps))
    out += ["## Traces", "", *table(("Route", "Traces", "Of all exported"), ((k, report[f"trace_{k}"], percent_text(report[f"trace_{k}"], exported)) for k in ("valid", "incomplete", "invalid") if exported))]
    gone = sum(report["drop_reasons"].values())
    out += ["## Drop reasons", "", *table(("Reason", "Records", "Share", "Meaning"), ((k, n, percent_text(n, gone), describe(k)) for k, n in report["drop_reasons"].items()))]
    for heading, name, of in (("Lines that could not be unwrapped", "unwrap_failures", "Failure"), ("Faults of traces", "trace_errors", "Fault")):
        out += [f"## {heading}", "", *table((of, "Records"), report.get(name, {}).items())]
    out += ["## Archives", "", *table(("Archive", "Members", "Used", "Skipped"), ((w["archive"], w["jsonl_member_count"], ", ".join(w.get("used_members") or []), ", ".join(w.get("skipped_members") or [])) for w in report.get("tar_warnings", [])))]
    out += ["## Sizes", "", *table(("File", "Kind", "Bytes", "Limit"), ((w["source_file"], w["kind"], w["size_bytes"], w["limit_bytes"]) for w in report.get("size_warnings", [])))]
    valid = ((r["trace_name"], r["messages_count"], r["last_relevant_role"]) for r in report.get("trace_results", []))
    out += ["## Valid traces", "", *(table(("Trace", "Messages", "Last role"), valid) if report.get("trace_results") else [f"{report.get('valid_files_omitted', 0)} not listed", ""])]
    return "\n".join(out)
