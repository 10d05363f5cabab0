"""Sinks: one trace file a session, sidecars, copies, reports."""

from __future__ import annotations

import json
import os
import shutil
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import sidecar_segment
from .delivery import resolve_under

ROUTES = {"valid": "traces", "incomplete": "incomplete", "invalid": "invalid"}
FOLDERS = ("traces", "incomplete", "invalid", "dropped", "unwrapped")


def clean(out: str) -> None:
    """Empty the output folders, keeping them."""
    for name in FOLDERS:
        folder = Path(out) / name
        if folder.is_dir():
            for p in folder.iterdir():
                shutil.rmtree(p) if p.is_dir() and not p.is_symlink() else p.unlink()


def bulk(lines: DataFrame, out: str) -> None:
    """route, session_key, seq, line as partitioned text: the sink for any store and size."""
    lines.repartition("session_key").sortWithinPartitions("session_key", "seq").select("route", "session_key", "line").write.mode("overwrite").partitionBy("route", "session_key").text(out)


def one_file_each(lines: DataFrame, out: str) -> None:
    """One file a trace on a file system that executors share; lines: route, trace_name, seq, line."""

    def write(rows) -> None:
        handle, current = None, None
        for r in rows:
            path = resolve_under(Path(out), f"{ROUTES[r.route]}/{r.trace_name}")
            if path != current:
                if handle:
                    handle.close()
                path.parent.mkdir(parents=True, exist_ok=True)
                handle, current = path.open("w", encoding="utf-8"), path
            handle.write(r.line + "\n")
        if handle:
            handle.close()

    lines.repartition("route", "trace_name").sortWithinPartitions("route", "trace_name", "seq").foreachPartition(write)


def sidecars(rows: DataFrame, out: str, folder: str) -> None:
    """One file a record: rows with source_file, source_line, line."""
    named = rows.select(F.concat(sidecar_segment(F.col("source_file")), F.lit("_"), F.col("source_line"), F.lit(".jsonl")).alias("name"), "line")

    def write(part) -> None:
        for r in part:
            path = resolve_under(Path(out) / folder, r.name)
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(r.line + "\n", encoding="utf-8")

    named.foreachPartition(write)


def copy_files(pairs: DataFrame, out: str, link: bool = False) -> None:
    """source, target (relative to out): copies or hard links, replacing what is there."""

    def place(part) -> None:
        for r in part:
            to = resolve_under(Path(out), r.target)
            to.parent.mkdir(parents=True, exist_ok=True)
            to.unlink(missing_ok=True)
            os.link(r.source, to) if link else shutil.copy2(r.source, to)

    pairs.select("source", "target").foreachPartition(place)


def write_json(value, path: Path) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(value, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
