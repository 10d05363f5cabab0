"""Delivery logs: JSON Lines, gzip and tar archives under a folder, with line numbers and in a fixed order.

delivery_log is a Python data source with one partition a file. For splittable reads of plain JSON Lines without line
numbers, from any store Spark knows, use text_lines().
"""

from __future__ import annotations

import gzip
import io
import os
import tarfile
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Fixed value: files, members and lines beyond this are skipped and reported.
MAX_READ_BYTES = 4 << 30
SUFFIXES = (".jsonl", ".jsonl.gz", ".tar.gz")
SCAN = "src_rank int, member_rank int, source_file string, source_line int, raw string, problem string, size_bytes bigint"
META = "archive string, jsonl_member_count int, used_members array<string>, skipped_members array<string>"


def within(path: Path, root: Path) -> bool:
    """Whether a path, links resolved, is root or below it."""
    return path.resolve().is_relative_to(root.resolve())


def resolve_under(base: Path, relative: str) -> Path:
    """The path, unless it leaves base."""
    out = (base.resolve() / relative).resolve()
    if not out.is_relative_to(base.resolve()):
        raise ValueError(f"{relative!r} leaves {base}")
    return out


def safe_member(name: str) -> bool:
    path = name.replace("\\", "/")
    return bool(name) and "\0" not in name and name.endswith(".jsonl") and path[0] != "/" and name[1:2] != ":" and ".." not in path.split("/")


def discover(root: str, exclude: tuple[str, ...] = (), limit: int | None = None) -> list[tuple[str, str]]:
    """(relative path, path): all plain files, then gzip, then tar, each sorted; nothing outside root or in an excluded folder."""
    top, out = Path(root), []
    for suffix in SUFFIXES:
        for p in sorted(top.rglob(f"*{suffix}")):
            if p.is_file() and within(p, top) and not any(within(p, Path(x)) for x in exclude):
                out.append((p.relative_to(top).as_posix(), str(p)))
    return out[:limit] if limit is not None else out


@dataclass
class OneFile(InputPartition):
    rank: int
    name: str
    path: str

    def __init__(self, rank: int, name: str, path: str):
        super().__init__(rank)
        self.rank, self.name, self.path = rank, name, path


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.meta = options.get("mode", "records") == "meta"
        self.most = int(options.get("max_bytes", MAX_READ_BYTES))
        self.limit = int(options["limit_files"]) if "limit_files" in options else None
        self.exclude = tuple(x for x in options.get("exclude_dirs", "").split(os.pathsep) if x)

    def partitions(self):
        files = discover(self.root, self.exclude, self.limit)
        return [OneFile(i, n, p) for i, (n, p) in enumerate(files) if not self.meta or n.endswith(".tar.gz")] or [OneFile(0, "", "")]

    def _lines(self, stream, rank: int, member: int, name: str, newline: str | None) -> Iterator[tuple]:
        text = io.TextIOWrapper(stream, encoding="utf-8", errors="replace", newline=newline)
        for number, line in enumerate(text, 1):
            line = line.rstrip("\n")
            if line.strip():
                size = len(line.encode("utf-8", "replace")) if len(line) * 4 > self.most else 0
                big = size > self.most
                yield rank, member, name, number, None if big else line, "jsonl_line" if big else None, size if big else None

    def read(self, partition: OneFile) -> Iterator[tuple]:
        rank, name, path = partition.rank, partition.name, partition.path
        if not path:
            return
        if self.meta:
            with tarfile.open(path, "r:gz") as archive:
                safe = [m.name for m in archive if m.isfile() and safe_member(m.name)]
            yield name, len(safe), safe, []
            return
        size = os.path.getsize(path)
        if size > self.most:
            yield rank, 0, name, 0, None, "gzip" if name.endswith(".gz") and not name.endswith(".tar.gz") else "file", size
        elif name.endswith(".tar.gz"):
            with tarfile.open(path, "r:gz") as archive:
                for member, info in enumerate(m for m in archive if m.isfile() and safe_member(m.name)):
                    if info.size > self.most:
                        yield rank, member, f"{name}:{info.name}", 0, None, "tar_member", info.size
                    else:
                        yield from self._lines(archive.extractfile(info), rank, member, f"{name}:{info.name}", "\n")
        elif name.endswith(".gz"):
            with gzip.open(path, "rb") as f:
                yield from self._lines(f, rank, 0, name, None)
        else:
            with open(path, "rb") as f:
                yield from self._lines(f, rank, 0, name, None)


class DeliveryLog(DataSource):
    """Options: mode (records or meta), limit_files, exclude_dirs (joined by the path separator), max_bytes."""

    @classmethod
    def name(cls) -> str:
        return "delivery_log"

    def schema(self) -> str:
        return META if self.options.get("mode") == "meta" else SCAN

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def read(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(DeliveryLog)
    return spark.read.format("delivery_log").options(**{k: str(v) for k, v in options.items() if v is not None}).load(path)


def scanned(lines: DataFrame) -> DataFrame:
    """Lines that count as records: all but whole files and members that were too large."""
    return lines.where(F.col("problem").isNull() | (F.col("problem") == "jsonl_line"))


def size_warnings(lines: DataFrame, limit: int = MAX_READ_BYTES) -> DataFrame:
    return lines.where("problem is not null").select("source_file", F.col("problem").alias("kind"), "size_bytes", F.lit(limit).alias("limit_bytes"), F.lit("size_exceeded").alias("reason"))


def tar_warnings(spark: SparkSession, path: str, **options) -> DataFrame:
    """Archives with no safe member, or more than one."""
    meta = read(spark, path, mode="meta", **options)
    return meta.where("jsonl_member_count != 1").withColumn("warning", F.when(F.col("jsonl_member_count") == 0, "no_safe_jsonl_member").otherwise("multiple_jsonl_members"))


def text_lines(spark: SparkSession, path: str, glob: str = "*.jsonl*") -> DataFrame:
    """raw, source_file of non-blank lines; gzip is read as it is. Splittable and without line numbers."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path)
    return lines.select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("source_file")).where(F.trim("raw") != "")


def whole_files(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """source_file, raw: one JSON document a file."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("wholetext", "true").text(path)
    return files.select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("raw"))


def day_dirs(root: str, include: list[str] | None = None, exclude: tuple[str, ...] = ("merged",)) -> list[Path]:
    """Sorted sub-folders that hold a report."""
    found = sorted(p for p in Path(root).iterdir() if p.is_dir() and (p / "report.json").is_file())
    return [p for p in found if p.name not in exclude and (include is None or p.name in include)]
