"""The stand-alone filter over files of one JSON record each, of any supported platform."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonx import configure, is_object, parse
from ..operators import dedup, funnel, rules, session
from ..operators.normalize import normalize
from ..sources import delivery
from .scratch import materialize


def judge_files(spark: SparkSession, path: str, glob: str = "*.json", mode: str = "full", limit: int | None = None) -> DataFrame:
    """source_file, format, passed, reasons, session_id of each file, in path order; mode: full demotes shorter repeats, stats and off do not.

    Files that hold no JSON object have format parse_error and do not pass.
    """
    configure(spark)
    files = delivery.whole_files(spark, path, glob)
    if limit is not None:
        files = files.orderBy("source_file").limit(limit)
    v = parse(F.col("raw"))
    df = files.withColumn("record", v).withColumn("record", F.when(is_object(F.col("record")), F.col("record")))
    df = rules.evaluate(normalize(df))
    if mode != "off":
        df = session.identify(df)
    else:
        df = df.withColumn("session_id", F.lit(None).cast("string"))
    fine = F.col("record").isNotNull()
    df = df.select("source_file", F.when(fine, F.col("format")).otherwise("parse_error").alias("format"), F.coalesce(F.col("passed") & fine, F.lit(False)).alias("passed"), F.when(fine, F.col("reasons")).otherwise(F.array(F.lit("parse_error"))).alias("reasons"), "session_id", "n_messages")
    df = materialize(df, "files")
    if mode == "full":
        kept = dedup.demoted(df.where("passed"), "session_id", "n_messages", ["source_file"]).withColumn("passed", F.col("winner")).drop("winner")
        df = kept.unionByName(df.where("not passed"))
    return df


def summary(df: DataFrame, mode: str = "full") -> dict:
    """Counts of a judged table; stats are of records that passed the rules."""
    total, kept, bad = df.agg(F.count("*"), F.count_if("passed"), F.count_if(F.col("format") == "parse_error")).first()
    repeats = df.where(F.array_contains("reasons", "session_id_duplicate")).count()
    fine = df.where(F.col("passed") | F.array_contains("reasons", "session_id_duplicate"))
    return {
        "scanned": total,
        "kept": kept,
        "parse_errors": bad,
        "dedup_mode": mode,
        "dedup_enabled": mode == "full",
        "dedup_dropped": repeats,
        "dedup_stats": dedup.stats(fine, "session_id").first().asDict() if mode != "off" else None,
        "per_format": {r.format: {"total": r.total, "kept": r.kept, "dropped": r.dropped} for r in funnel.by_format(df).collect()},
        "drop_reasons": {r.reason: r.n for r in funnel.histogram(df.where("not passed"), "reasons", "source_file").collect()},
    }
