"""Counters, histograms and rates of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import rounded


def histogram(df: DataFrame, values: str, order: str) -> DataFrame:
    """reason, n, first_seen: how often each element of an array column occurs, most frequent first, then first seen."""
    rows = df.select(F.explode(values).alias("reason"), F.col(order).alias("_o"))
    return rows.groupBy("reason").agg(F.count("*").alias("n"), F.min("_o").alias("first_seen")).orderBy(F.desc("n"), "first_seen", "reason")


def top(df: DataFrame, values: str, order: str, k: int) -> DataFrame:
    return histogram(df, values, order).limit(k)


def by_format(df: DataFrame) -> DataFrame:
    """total, kept and dropped of each format; records that did not parse count as parse_error."""
    fmt = F.coalesce("format", F.lit("parse_error"))
    kept = F.coalesce(F.col("passed"), F.lit(False))
    return df.groupBy(fmt.alias("format")).agg(F.count("*").alias("total"), F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped"))


def rate(part: Column, whole: Column) -> Column:
    """Four decimals, rounded as Python does; null without a whole."""
    return rounded(F.try_divide(part.cast("double"), whole), 4) / 10000.0


def counters(scan: DataFrame, *more: Column) -> DataFrame:
    """One row of counts over scanned records with columns envelope, failure, passed and dropped; more: other aggregates."""
    bad = F.col("envelope").isNull()
    return scan.agg(
        F.count("*").alias("scanned"),
        F.count_if(bad).alias("json_line_errors"),
        F.count_if(bad | F.col("failure").isNotNull()).alias("record_errors"),
        F.count_if(~bad & F.col("failure").isNull()).alias("unwrapped"),
        F.count_if("passed").alias("filter_kept"),
        F.count_if(~F.col("passed")).alias("filter_dropped"),
        F.count_if("dropped").alias("dedup_dropped"),
        *more,
    )


def archive_counts(tar: DataFrame) -> DataFrame:
    """One row over archives (jsonl_member_count, skipped_members): those with several members, and members that were skipped."""
    return tar.agg(F.count_if(F.col("jsonl_member_count") > 1).alias("archives_with_multiple_jsonl"), F.coalesce(F.sum(F.size("skipped_members")), F.lit(0)).alias("skipped_jsonl_members"))
