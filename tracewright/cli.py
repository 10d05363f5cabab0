"""Command line: clean, filter, merge-traces, merge-reports.

Exit codes: 0 done, 1 nothing valid although --strict-empty was given, 2 bad arguments, 3 a validator that cannot be imported.
"""

from __future__ import annotations

import argparse
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from .operators import validators
from .plans import clean, merge, platforms, report
from .sources import delivery, sinks


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tracewright", description=__doc__.splitlines()[0])
    sub = top.add_subparsers(dest="command", required=True)
    c = sub.add_parser("clean", help="delivery logs to traces and a report")
    c.add_argument("input")
    c.add_argument("output", nargs="?", help="default: the folder output in the input folder")
    for flag in ("no-filter", "no-dedup", "keep-dropped", "keep-unwrapped", "clean-output", "strict-empty", "no-report", "no-report-md", "report-absolute-paths", "skip-validate", "quiet"):
        c.add_argument(f"--{flag}", action="store_true")
    c.add_argument("--list-valid", "--report-include-valid", action="store_true")
    c.add_argument("--training-rows", "--emit-training-rows", action="store_true")
    c.add_argument("--no-dropped", dest="keep_dropped", action="store_false")
    c.add_argument("--workers", type=int, help="tasks at a time; only for a session that this command starts")
    for flag in ("report", "report-md"):
        c.add_argument(f"--{flag}", type=Path)
    c.add_argument("--validator", help="module with check(events) -> (route, error), in place of the rule built in")
    for flag in ("limit-files", "limit-records", "max-bytes"):
        c.add_argument(f"--{flag}", type=int)
    f = sub.add_parser("filter", help="judge files of one record each")
    f.add_argument("input")
    f.add_argument("--output")
    f.add_argument("--report")
    f.add_argument("--glob", default="*.json")
    f.add_argument("--dedup", choices=("full", "stats", "off"), default="full")
    f.add_argument("--limit", type=int)
    for name in ("merge-traces", "merge-reports"):
        m = sub.add_parser(name)
        m.add_argument("root")
        m.add_argument("output")
        m.add_argument("--days", nargs="*")
        if name == "merge-traces":
            m.add_argument("--link", action="store_true")
            m.add_argument("--dry-run", action="store_true")
        m.add_argument("--exclude", nargs="*", default=[])
        m.add_argument("--quiet", action="store_true")
    return top


def run_clean(spark: SparkSession, a: argparse.Namespace) -> int:
    began, say = time.monotonic(), (lambda *x: None) if a.quiet else print
    if a.clean_output:
        sinks.clean(a.output)
    options = {"limit_files": a.limit_files, "exclude_dirs": a.output, "max_bytes": a.max_bytes}
    lines = delivery.read(spark, a.input, **options)
    if a.limit_records is not None:
        lines = lines.orderBy(*clean.ORDER).limit(a.limit_records)
    out = clean.clean(spark, lines, apply_filter=not a.no_filter, with_dedup=not a.no_dedup, validator=a.validator, skip_validate=a.skip_validate)
    clean.write(out, a.output, keep_dropped=a.keep_dropped, keep_unwrapped=a.keep_unwrapped)
    if a.training_rows:
        clean.training_rows(out.traces).write.mode("overwrite").json(os.path.join(a.output, "training_rows"))
    r = report.build(out, time.monotonic() - began, delivery.tar_warnings(spark, a.input, limit_files=a.limit_files, exclude_dirs=a.output), a.list_valid)
    r = {k: report.shown_path(str(v), a.report_absolute_paths) for k, v in (("input_dir", a.input), ("output_dir", a.output))} | {"generated_at": out.stamp} | r
    if not a.no_report:
        sinks.write_json(r, a.report or Path(a.output) / "report.json")
    if not a.no_report_md:
        md = a.report_md or Path(a.output) / "report.md"
        md.parent.mkdir(parents=True, exist_ok=True)
        md.write_text(report.markdown(r), encoding="utf-8")
    say(report.progress_line(r))
    return int(a.strict_empty and not r["trace_valid"])


def run_filter(spark: SparkSession, a: argparse.Namespace) -> int:
    df = platforms.judge_files(spark, a.input, a.glob, a.dedup, a.limit)
    r = platforms.summary(df, a.dedup)
    if a.report:
        sinks.write_json(r, Path(a.report))
    if a.output:
        from pyspark.sql import functions as F

        root = "file:" + str(Path(a.input).resolve()) + "/"
        local = F.regexp_replace("source_file", "^file:/+", "/")
        sinks.copy_files(df.where("passed").select(local.alias("source"), F.substr(F.concat(F.lit("file:"), local), F.lit(len(root) + 1)).alias("target")), a.output)
    return 0 if r["kept"] else 1


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    where = a.root if "root" in a else a.input
    if not os.path.isdir(where):
        print(f"no such folder: {where}", file=sys.stderr)
        return 2
    if a.command == "clean":
        a.output = a.output or os.path.join(a.input, "output")
        if a.validator and not a.skip_validate and not validators.available(a.validator):
            print(f"cannot import {a.validator}; install it or pass --skip-validate", file=sys.stderr)
            return 3
    builder = SparkSession.builder.master(f"local[{a.workers}]") if a.command == "clean" and a.workers else SparkSession.builder
    spark = builder.appName("tracewright").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "clean":
        return run_clean(spark, a)
    if a.command == "filter":
        return run_filter(spark, a)
    if a.command == "merge-traces":
        merge.merge_traces(spark, a.root, a.output, include=a.days, exclude=a.exclude, link=a.link, dry=a.dry_run)
    else:
        merge.merge_reports(spark, a.root, a.output, include=a.days, exclude=a.exclude)
    return 0


if __name__ == "__main__":
    sys.exit(main())
