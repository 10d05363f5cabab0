"""Merging days: traces by session, reports by sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import field, string, text_of
from ..functions.text import strip
from .dedup import winners

#: Fields a merged report adds up, counters it merges, roles that count as messages, the id that is discarded.
SUM_FIELDS = ("scanned", "parse_errors", "json_line_errors", "unwrapped", "filter_kept", "filter_dropped", "dedup_dropped", "export_total", "trace_valid", "trace_incomplete", "trace_invalid", "elapsed_seconds")
COUNTERS = ("unwrap_failures", "drop_reasons", "trace_errors")
ROLES = ("user", "assistant", "tool", "model")
NO_SESSION = "unknown-session"


def discarded(session: Column) -> Column:
    return session.isNull() | (strip(session) == "") | (strip(session) == NO_SESSION)


def is_message(event: Column) -> Column:
    counts = (string(field(event, "type")) == "response_item") & (string(field(event, "payload", "type")) == "message") & string(field(event, "payload", "role")).isin(*ROLES)
    return F.coalesce(counts, F.lit(False))


def trace_candidates(lines: DataFrame) -> DataFrame:
    """day, path, session_id, messages_count, discarded of each trace; lines: day, path, line_no, event (VARIANT)."""
    meta = F.when((F.col("line_no") == 1) & (string(field(F.col("event"), "type")) == "session_meta"), text_of(field(F.col("event"), "payload", "id")))
    out = lines.groupBy("day", "path").agg(F.max(meta).alias("session_id"), F.count_if(is_message(F.col("event"))).alias("messages_count"))
    return out.withColumn("discarded", discarded(F.col("session_id")))


def merge_candidates(candidates: DataFrame) -> DataFrame:
    """Kept candidates with winner: the longest of its session over all days, then the earliest day and path."""
    return winners(candidates.where("not discarded"), "session_id", "messages_count", ["day", "path"])


def day_counts(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("day").agg(F.count("*").alias("pre_filter"), F.count_if("discarded").alias("discarded_unknown_session"), F.count_if(~F.col("discarded")).alias("kept_after_quality_filter"))


def sum_reports(reports: DataFrame, fields=SUM_FIELDS) -> DataFrame:
    """One row: every field cut to a whole number a day and added up, and the longest day."""
    return reports.agg(*(F.coalesce(F.sum(F.col(f).cast("bigint")), F.lit(0)).alias(f) for f in fields), F.max("elapsed_seconds").alias("elapsed_seconds_max"))


def sum_counters(reports: DataFrame, name: str) -> DataFrame:
    """key, n: a map column added up over days, largest first."""
    rows = reports.select(F.explode(name).alias("key", "n"))
    return rows.groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key")


def per_day(reports: DataFrame, manifest: DataFrame) -> DataFrame:
    """Report rows with what the manifest knows of the day (left join on date); no kept count falls back to valid minus discarded."""
    m = manifest.select("date", "pre_filter", "discarded_unknown_session", F.col("kept_after_quality_filter").alias("_kept"))
    out = reports.join(m, "date", "left")
    gone = F.coalesce("discarded_unknown_session", F.lit(0))
    kept = F.coalesce(F.nullif(F.col("_kept"), F.lit(0)), F.greatest(F.col("trace_valid") - gone, F.lit(0)))
    return out.withColumn("discarded_unknown_session", gone).withColumn("kept_after_quality_filter", kept).drop("_kept")
