"""The cleaning plan: scan, unwrap, normalise, judge, dedup, flatten, validate, route."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonx import configure, is_object, parse
from ..operators import dedup, export, response, rules, session, validators
from ..operators.normalize import normalize
from ..sources import delivery, sinks
from .scratch import materialize

ORDER = ["src_rank", "member_rank", "source_line"]


def now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="milliseconds").replace("+00:00", "Z")


@dataclass
class Cleaned:
    lines: DataFrame  # every line, and files and members that were too large, with problem and size_bytes
    judged: DataFrame  # with failure, reasons, passed, dropped, winner
    traces: DataFrame  # winners with events, route
    stamp: str


def envelopes(lines: DataFrame) -> DataFrame:
    """lines with envelope: the JSON object of raw, null for anything else."""
    v = parse(F.col("raw"))
    return lines.withColumn("envelope", v).withColumn("envelope", F.when(is_object(F.col("envelope")), F.col("envelope")))


def judge(lines: DataFrame) -> DataFrame:
    """Scanned lines through rules and session ids; failed lines keep null columns."""
    df = response.unwrap(envelopes(lines)).drop("response")
    df = rules.evaluate(normalize(df))
    fine = F.col("record").isNotNull()
    df = df.withColumn("passed", F.when(fine, F.col("passed"))).withColumn("reasons", F.when(fine, F.col("reasons"))).withColumn("format", F.when(fine, F.col("format")))
    df = session.identify(df)
    key = response.session_key(F.col("envelope"))
    return df.withColumn("session_key", key).withColumn("session_id", F.when(fine, F.coalesce("session_id", key)))


def dedup_marks(judged: DataFrame, by_filter: bool = True) -> DataFrame:
    """judged with dropped and winner. Only keys and lengths are shuffled for the windows, then joined back by scan order."""
    kept = judged.where("passed" if by_filter else "record is not null").select("session_id", "n_messages", *ORDER)
    marks = dedup.winners(dedup.dropped_in_order(kept, "session_id", "n_messages", ORDER), "session_id", "n_messages", ORDER)
    return judged.join(marks.select(*ORDER, "dropped", "winner"), ORDER, "left")


def clean(spark: SparkSession, lines: DataFrame, *, apply_filter: bool = True, with_dedup: bool = True, stamp: str | None = None, validator: str | None = None, skip_validate: bool = False) -> Cleaned:
    """The whole plan over lines as delivery.read gives them. Nothing is collected; the logs are parsed once.

    validator: a module that judges traces (operators.validators); skip_validate: every trace counts as valid.
    """
    configure(spark)
    stamp = stamp or now()
    columns = [*ORDER, "source_file", "envelope", "failure", "record", "format", "model", "n_messages", "stop_reason", "reasons", "passed", "session_id", "session_key"]
    # what was too large to read is written with the rest, so that warnings read no log again
    every = materialize(judge(lines).select(*columns, "problem", "size_bytes"), "judged")
    judged = delivery.scanned(every).drop("problem", "size_bytes")
    if with_dedup:
        judged = dedup_marks(judged, apply_filter)
    else:
        judged = judged.withColumn("dropped", F.lit(False)).withColumn("winner", F.col("passed") if apply_filter else F.col("record").isNotNull())
    traces = export.validate(export.trace_events(judged.where("winner"), stamp))
    if skip_validate:
        traces = traces.withColumns({"route": F.lit("valid"), "error": F.lit(None).cast("string")})
    elif validator:
        traces = validators.by_module(traces, validator)
    traces = materialize(traces, "traces")
    return Cleaned(every, judged, traces.withColumn("trace_name", export.trace_name(F.col("session_key"))), stamp)


def write(out: Cleaned, folder: str, *, keep_dropped: bool = False, keep_unwrapped: bool = False) -> None:
    """Trace files by route, and sidecars on request. Names that several sessions share are told apart, so none is lost."""
    lines = export.trace_lines(named_apart(out.traces), out.stamp, ["route", "trace_name"])
    sinks.one_file_each(lines, folder)
    if keep_dropped:
        why = F.when(F.col("passed") & F.col("dropped"), F.array(F.lit("session_id_duplicate"))).otherwise(F.col("reasons"))
        gone = out.judged.where("not passed or dropped").select("source_file", "source_line", F.to_json(F.to_variant_object(F.map_concat(F.try_variant_get("envelope", "$", "map<string,variant>"), F.create_map(F.lit("_drop_reasons"), F.to_variant_object(why))))).alias("line"))
        sinks.sidecars(gone, folder, "dropped")
    if keep_unwrapped:
        sinks.sidecars(out.judged.where("record is not null").select("source_file", "source_line", F.to_json("record").alias("line")), folder, "unwrapped")


def named_apart(traces: DataFrame) -> DataFrame:
    """traces whose names no two share: of a name that several have, each but the first gets a hash of its place in the scan.

    Only names that several have are joined back, usually few; a name of many traces burdens neither the aggregate nor the join.
    """
    place = F.struct(*ORDER)
    shared = traces.groupBy("trace_name").agg(F.min(place).alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    hashed = F.left(F.sha2(F.concat_ws(":", *ORDER), 256), F.lit(16))
    other = F.concat(F.regexp_replace("trace_name", r"\.jsonl$", ""), F.lit("~"), hashed, F.lit(".jsonl"))
    alone = F.col("_first").isNull() | (F.col("_first") == place)
    return traces.join(shared, "trace_name", "left").withColumn("trace_name", F.when(alone, F.col("trace_name")).otherwise(other)).drop("_first")


def training_rows(traces: DataFrame) -> DataFrame:
    """session_key, messages_count, messages (role, text) of valid traces, for a JSON sink."""
    spoken = F.filter("events", lambda e: e["type"] == "response_item")
    rows = F.transform(spoken, lambda e: F.struct(export.role_of(e["payload"]).alias("role"), F.to_json(e["payload"]).alias("item")))
    return traces.where("route = 'valid'").select("session_key", "messages_count", rows.alias("messages"))
