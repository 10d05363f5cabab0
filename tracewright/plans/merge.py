"""Merging several days of traces and reports."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonx import configure, is_object, parse
from ..functions.text import file_name
from ..operators import merge
from ..sources import delivery, sinks
from .report import describe, shown_path, table
from .scratch import materialize


def trace_lines(spark: SparkSession, days: list[Path]) -> DataFrame:
    """day, path, line_no, event of every trace line of the given days."""
    parts = None
    for d in days:
        lines = delivery.read(spark, str(d / "traces")).where("raw is not null")
        part = lines.select(F.lit(d.name).alias("day"), F.concat(F.lit(f"{d}/traces/"), "source_file").alias("path"), F.col("source_line").alias("line_no"), parse(F.col("raw")).alias("event"))
        parts = part if parts is None else parts.unionByName(part)
    return parts.withColumn("event", F.when(is_object(F.col("event")), F.col("event")))


def merge_traces(spark: SparkSession, root: str, out: str | None = None, *, include: list[str] | None = None, exclude: list[str] | tuple[str, ...] = (), link: bool = False, dry: bool = False) -> dict:
    """Keep the longest trace of each session over all days; returns the manifest and writes it, also on a dry run."""
    configure(spark)
    days = [d for d in delivery.day_dirs(root, include) if d.name not in exclude and (d / "traces").is_dir()]
    if not days:
        return {"pre_filter_files": 0, "post_filter_files": 0, "post_dedup_files": 0, "discarded_unknown_session": 0, "cross_day_duplicates": 0, "per_day": []}
    candidates = materialize(merge.trace_candidates(trace_lines(spark, days)), "candidates")
    marked = materialize(merge.merge_candidates(candidates), "merged")
    per_day = [r.asDict() for r in merge.day_counts(candidates).orderBy("day").collect()]
    kept, total = marked.agg(F.count_if("winner"), F.count("*")).first()
    manifest = {
        "source_days": [d.name for d in days],
        "pre_filter_files": sum(d["pre_filter"] for d in per_day),
        "post_filter_files": total,
        "post_dedup_files": kept,
        "discarded_unknown_session": sum(d["discarded_unknown_session"] for d in per_day),
        "discarded_reason": merge.NO_SESSION,
        "cross_day_duplicates": total - kept,
        "dry_run": dry,
        "per_day": [{"date": d.pop("day"), **d} for d in per_day],
    }
    if out:
        if not dry:
            name = F.concat(F.lit("traces/"), file_name(F.col("session_id")), F.lit(".jsonl"))
            sinks.copy_files(marked.where("winner").select(F.col("path").alias("source"), name.alias("target")), out, link)
        sinks.write_json(manifest, Path(out) / "merge_manifest.json")
    return manifest


def _report_row(day: Path) -> tuple:
    r = json.loads((day / "report.json").read_text(encoding="utf-8"))
    number = lambda k: float(r.get(k) or 0)
    return (day.name, *(number(k) for k in merge.SUM_FIELDS), *({str(k): int(v) for k, v in (r.get(c) or {}).items()} for c in merge.COUNTERS), json.dumps(r.get("tar_warnings") or []), json.dumps(r.get("size_warnings") or []))


def read_reports(spark: SparkSession, days: list[Path]) -> DataFrame:
    """A row a day: date, the fields that add up, counters as maps, warnings as JSON. One small report a day reaches the driver."""
    schema = ", ".join(["date string", *(f"{k} double" for k in merge.SUM_FIELDS), *(f"{k} map<string,bigint>" for k in merge.COUNTERS), "tar_warnings string", "size_warnings string"])
    return spark.createDataFrame([_report_row(d) for d in days], schema)


def merge_reports(spark: SparkSession, root: str, out: str | None = None, *, include: list[str] | None = None, exclude: list[str] | tuple[str, ...] = (), manifest: dict | None = None) -> dict:
    """Add up the reports of several days; with a merge manifest, also its per-day counts and sections."""
    days = [d for d in delivery.day_dirs(root, include) if d.name not in exclude]
    reports = read_reports(spark, days)
    if manifest is None and out and (Path(out) / "merge_manifest.json").is_file():
        manifest = json.loads((Path(out) / "merge_manifest.json").read_text(encoding="utf-8"))
    known = (manifest or {}).get("per_day") or []
    dates = spark.createDataFrame([(d["date"], d.get("pre_filter"), d.get("discarded_unknown_session"), d.get("kept_after_quality_filter")) for d in known], "date string, pre_filter bigint, discarded_unknown_session bigint, kept_after_quality_filter bigint")
    rows = merge.per_day(reports, dates).orderBy("date").select("date", "scanned", "trace_valid", "pre_filter", "discarded_unknown_session", "kept_after_quality_filter").collect()
    sums = merge.sum_reports(reports).first().asDict()
    export = sums["export_total"]
    warned = reports.orderBy("date").select("tar_warnings", "size_warnings").collect()
    merged = {
        "report_type": "merged",
        "source_days": [d.name for d in days],
        "input_root": shown_path(root),
        "output_dir": shown_path(out) if out else None,
        "merge_manifest": shown_path(str(Path(out) / "merge_manifest.json")) if out and manifest else None,
        **sums,
        **{c: {r.key: r.n for r in merge.sum_counters(reports, c).collect()} for c in merge.COUNTERS},
        "funnel": {f"{k}_rate": round(sums[f"trace_{k}"] / export, 4) if export else None for k in ("valid", "incomplete", "invalid")},
        "tar_warnings": [w for r in warned for w in json.loads(r.tar_warnings)],
        "size_warnings": [w for r in warned for w in json.loads(r.size_warnings)],
        "per_day": [r.asDict() for r in rows],
        "pre_cross_day_dedup": {"trace_valid": sums["trace_valid"]},
    }
    if manifest:
        merged["quality_filter"] = {k: manifest.get(k) for k in ("pre_filter_files", "post_filter_files", "discarded_unknown_session", "discarded_reason")}
        # as in the manifest: duplicate_session_keys counts files that went, not keys
        merged["cross_day_dedup"] = {"duplicate_session_keys": manifest.get("cross_day_duplicates"), "post_dedup_files": manifest.get("post_dedup_files")}
    if out:
        sinks.write_json(merged, Path(out) / "report.json")
        (Path(out) / "report.md").write_text(markdown(merged), encoding="utf-8")
    return merged


def markdown(merged: dict) -> str:
    out = ["# Merged report", "", "Days: " + ", ".join(merged["source_days"]), ""]
    out += [f"* {k}: {merged[k]}" for k in ("input_root", "output_dir", "merge_manifest") if merged.get(k)]
    out += ["", "## Sums", "", *table(("Field", "Sum"), ((k, merged[k]) for k in merge.SUM_FIELDS))]
    days = ((d["date"], int(d["scanned"] or 0), int(d["trace_valid"] or 0), d["pre_filter"], d["discarded_unknown_session"], d["kept_after_quality_filter"]) for d in merged["per_day"])
    out += ["## Days", "", *table(("Day", "Scanned", "Valid", "Before the filter", "Discarded", "Kept"), days)]
    out += ["## Drop reasons", "", *table(("Reason", "Records", "Meaning"), ((k, n, describe(k)) for k, n in merged.get("drop_reasons", {}).items()))]
    for heading, name in (("Quality filter", "quality_filter"), ("Repeats across days", "cross_day_dedup"), ("Rates", "funnel")):
        out += [f"## {heading}", "", *table(("Field", "Value"), merged.get(name, {}).items())]
    return "\n".join(out)
