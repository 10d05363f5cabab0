"""Queries of the engine's operators over the shared tables, each with SQL that gives the same rows.

Conversations stand for agent sessions. What they lack (models, tools, stop reasons, markers) is derived from conv_id by the
same arithmetic on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonx, text
from ..operators import dedup, export, funnel, merge, normalize, response, rules, session
from ..sources import delivery, sinks
from .report import MEANING
from .scratch import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MODELS = ("claude-opus-4-5", "claude-opus-4-20250514", "anthropic/claude-opus-4.6@x", "gpt-5.5", "gpt-5-mini", "gpt-4.5-preview", "gpt-5", "claude-3-opus-20240229", "openai/gpt_5:latest", "opus-5", "claude-sonnet-4-5", "gpt-5.5-mini")
STOPS = ("stop", "end_turn", None, "tool_calls", "stop_sequence")
FORMATS = ("openai_responses", "openai_chat", "anthropic_messages", "bedrock_converse", "unknown")


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values, key: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (key % len(values) + 1).cast("int"))


def _sql_list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


#: Conversations with one message text changed here and there so that every marker occurs.
_TEXT_SQL = """CASE WHEN conv_id % 17 = 3 AND turn = 1 THEN text || ' [SILENT]'
 WHEN conv_id % 19 = 4 AND turn = 0 THEN text || ' read HEARTBEAT.md'
 WHEN conv_id % 23 = 5 AND role = 'assistant' THEN ' HEARTBEAT_OK '
 WHEN conv_id % 29 = 6 AND role = 'assistant' THEN 'EvoMap Heartbeat  result: HTTP status 200'
 WHEN conv_id % 31 = 7 AND role = 'assistant' THEN 'EvoMap  heartbeat completed successfully.'
 WHEN conv_id % 37 = 8 AND role = 'assistant' THEN '<heartbeat> ok <decision>DONT_NOTIFY</decision>'
 WHEN conv_id % 41 = 9 AND turn = 0 THEN text || ' Continue the OpenClaw runtime event'
 ELSE text END"""
_TURNS_SQL = f"turns AS (SELECT conv_id, turn, role, {_TEXT_SQL} AS text FROM conversations)"
_TRIM_SQL = "CASE WHEN length(text) <= 4000 THEN text ELSE left(text, 2000) || chr(10) || right(text, 2000) END"
_CONV_SQL = f"""{_TURNS_SQL},
conv AS (SELECT conv_id, count(*) AS n_messages,
 {_sql_list(MODELS)}[conv_id % {len(MODELS)} + 1] AS model, conv_id % 4 AS n_tools,
 {_sql_list(FORMATS)}[conv_id % {len(FORMATS)} + 1] AS format, {_sql_list(STOPS)}[conv_id // 2 % {len(STOPS)} + 1] AS stop_reason,
 bool_or(role = 'assistant' AND (conv_id + turn) % 3 = 0) AS has_tool_call,
 coalesce(arg_min(text, turn) FILTER (WHERE role = 'system' AND text <> ''), '') AS system_prompt,
 coalesce(string_agg({_TRIM_SQL}, chr(10) ORDER BY turn) FILTER (WHERE text <> ''), '') AS scan_text,
 coalesce(arg_max(text, turn) FILTER (WHERE role = 'assistant' AND text <> ''), '') AS last_text,
 count(*) FILTER (WHERE role = 'assistant' AND lower(trim(text)) = 'heartbeat_ok') AS n_alive
 FROM turns GROUP BY conv_id)"""
_R1_SQL = r"""(regexp_matches(model, '(?i)(?:^|[/.\-_])opus[-_](\d+)(?:(?:[-_.])(\d{1,2}))?(?:[-_.@:]|$)') AND NOT regexp_matches(model, '(?i)(?:^|[/.\-_])3[-_]opus(?:[-_.@:]|$)')
 AND (CAST(coalesce(nullif(regexp_extract(model, '(?i)(?:^|[/.\-_])opus[-_](\d+)(?:(?:[-_.])(\d{1,2}))?(?:[-_.@:]|$)', 1), ''), '0') AS BIGINT) * 100
 + CAST(coalesce(nullif(regexp_extract(model, '(?i)(?:^|[/.\-_])opus[-_](\d+)(?:(?:[-_.])(\d{1,2}))?(?:[-_.@:]|$)', 2), ''), '0') AS BIGINT)) >= 405)"""
_GPT_SQL = r"""(regexp_matches(model, '(?i)(?:^|[/.\-_])gpt[-_]?5(?:$|[-_.@:])') AND NOT regexp_matches(model, '(?i)(?:^|[/.\-_])gpt[-_]?5[-_](?:mini|nano)(?:$|[-_.@:])') AND NOT regexp_matches(model, '(?i)gpt[-_]?4[-_.]5\b'))"""
_STOP_SQL = """CASE WHEN stop_reason IS NULL THEN 'stop_reason_missing' WHEN (format IN ('openai_responses', 'openai_chat') AND stop_reason = 'stop') OR (format = 'anthropic_messages' AND stop_reason = 'end_turn')
 OR (format = 'bedrock_converse' AND stop_reason IN ('end_turn', 'stop_sequence')) OR (format = 'unknown' AND stop_reason IN ('end_turn', 'stop')) THEN NULL ELSE 'stop_reason_' || stop_reason END"""
_NORM_SQL = r"lower(trim(regexp_replace(last_text, '\s+', ' ', 'g')))"
_BEAT_SQL = f"""CASE WHEN contains(scan_text, '[SILENT]') OR contains(scan_text, '[SLIENT]') THEN 'silent_keepalive_marker'
 WHEN contains(lower(scan_text), 'read heartbeat.md') OR contains(lower(scan_text), '[openclaw heartbeat poll]') OR contains(lower(scan_text), '[heartbeat:chill]') OR contains(lower(scan_text), 'continue the openclaw runtime event')
 OR ({_NORM_SQL} = 'heartbeat_ok' AND (n_alive >= 2 OR contains(lower(scan_text), 'inside openclaw')))
 OR (starts_with({_NORM_SQL}, 'evomap heartbeat result') AND contains({_NORM_SQL}, 'http status')) OR starts_with({_NORM_SQL}, 'evomap heartbeat completed successfully')
 OR (starts_with({_NORM_SQL}, '<heartbeat>') AND contains({_NORM_SQL}, '<decision>dont_notify')) THEN 'heartbeat_non_task_traffic' END"""
_JUDGED_SQL = f"""{_CONV_SQL},
judged AS (SELECT *, list_filter([CASE WHEN NOT ({_R1_SQL} OR {_GPT_SQL}) THEN 'model_not_target_family' END, CASE WHEN n_tools = 0 THEN 'no_tools' END,
 CASE WHEN n_messages <= 5 THEN 'messages_le_5' END, CASE WHEN NOT has_tool_call THEN 'no_assistant_tool_call' END, {_STOP_SQL},
 CASE WHEN trim(system_prompt) = '' THEN 'no_system_prompt' END, {_BEAT_SQL}], lambda x: x IS NOT NULL) AS reasons FROM conv)"""


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    c, said = F.col("conv_id"), F.col("role") == "assistant"
    new = (
        F.when((c % 17 == 3) & (F.col("turn") == 1), F.concat("text", F.lit(" [SILENT]")))
        .when((c % 19 == 4) & (F.col("turn") == 0), F.concat("text", F.lit(" read HEARTBEAT.md")))
        .when((c % 23 == 5) & said, F.lit(" HEARTBEAT_OK "))
        .when((c % 29 == 6) & said, F.lit("EvoMap Heartbeat  result: HTTP status 200"))
        .when((c % 31 == 7) & said, F.lit("EvoMap  heartbeat completed successfully."))
        .when((c % 37 == 8) & said, F.lit("<heartbeat> ok <decision>DONT_NOTIFY</decision>"))
        .when((c % 41 == 9) & (F.col("turn") == 0), F.concat("text", F.lit(" Continue the OpenClaw runtime event")))
    )
    return t.withColumn("text", F.coalesce(new, F.col("text")))


def trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a conversation with the columns that rules read."""
    c = F.col("conv_id")
    spoken = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    df = turns(spark, sf_dir).groupBy("conv_id").agg(spoken.alias("m"), F.bool_or((F.col("role") == "assistant") & ((c + F.col("turn")) % 3 == 0)).alias("has_tool_call"))
    texts = lambda role: F.transform(F.filter("m", lambda x: (x["role"] == role) & (x["text"] != "")), lambda x: x["text"])
    scanned = F.transform(F.filter("m", lambda x: x["text"] != ""), lambda x: text.scan_trim(x["text"]))
    return df.select(
        "conv_id",
        F.size("m").cast("long").alias("n_messages"),
        _pick(MODELS, c).alias("model"),
        (c % 4).alias("n_tools"),
        _pick(FORMATS, c).alias("format"),
        _pick(STOPS, F.floor(c / 2)).alias("stop_reason"),
        "has_tool_call",
        F.coalesce(F.get(texts("system"), F.lit(0)), F.lit("")).alias("system_prompt"),
        F.lit("").alias("recovered_prompt"),
        F.array_join(scanned, "\n").alias("scan_text"),
        texts("assistant").alias("assistant_texts"),
    )


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.evaluate(trajectories(spark, sf_dir))


@query(f"WITH {_CONV_SQL} SELECT conv_id, model, {_R1_SQL} AS opus, {_GPT_SQL} AS gpt5, CASE WHEN NOT ({_R1_SQL} OR {_GPT_SQL}) THEN 'model_not_target_family' END AS reason FROM conv")
def r1_model_match(spark, sf_dir):
    m = F.col("model")
    return trajectories(spark, sf_dir).select("conv_id", m, rules.is_opus(m).alias("opus"), rules.is_gpt5(m).alias("gpt5"), rules.model_match(m).alias("reason"))


@query(f"WITH {_CONV_SQL} SELECT conv_id, n_tools, CASE WHEN n_tools = 0 THEN 'no_tools' END AS reason FROM conv")
def r2_has_tools(spark, sf_dir):
    return trajectories(spark, sf_dir).select("conv_id", "n_tools", rules.has_tools(F.col("n_tools")).alias("reason"))


@query(f"WITH {_CONV_SQL} SELECT conv_id, n_messages, CASE WHEN n_messages <= 5 THEN 'messages_le_5' END AS reason FROM conv")
def r3_min_messages(spark, sf_dir):
    return trajectories(spark, sf_dir).select("conv_id", "n_messages", rules.min_messages(F.col("n_messages")).alias("reason"))


@query(f"WITH {_CONV_SQL} SELECT conv_id, has_tool_call, CASE WHEN NOT has_tool_call THEN 'no_assistant_tool_call' END AS reason FROM conv")
def r4_tool_call(spark, sf_dir):
    """Through VARIANT messages in the shape of a chat request."""
    called = (F.col("role") == "assistant") & ((F.col("conv_id") + F.col("turn")) % 3 == 0)
    calls = F.when(called, F.array(F.struct(F.lit("f").alias("name")))).otherwise(F.array().cast("array<struct<name:string>>"))
    m = F.to_variant_object(F.struct("role", F.col("text").alias("content"), calls.alias("tool_calls")))
    df = table(spark, sf_dir, "conversations").select("conv_id", m.alias("m"), F.lit(None).cast("variant").alias("response"))
    df = df.groupBy("conv_id").agg(F.collect_list("m").alias("m"))
    has = normalize.has_tool_call(F.lit("openai_chat"), F.col("m"), F.lit(None).cast("variant"))
    return df.select("conv_id", has.alias("has_tool_call"), rules.tool_call(has).alias("reason"))


@query(f"WITH {_CONV_SQL} SELECT conv_id, format, stop_reason, {_STOP_SQL} AS reason FROM conv")
def r5_stop_reason(spark, sf_dir):
    return trajectories(spark, sf_dir).select("conv_id", "format", "stop_reason", rules.stop_reason(F.col("format"), F.col("stop_reason")).alias("reason"))


@query(f"WITH {_CONV_SQL} SELECT conv_id, CASE WHEN trim(system_prompt) = '' THEN 'no_system_prompt' END AS reason FROM conv")
def r6_system_prompt(spark, sf_dir):
    return trajectories(spark, sf_dir).select("conv_id", rules.system_prompt(F.col("system_prompt"), F.lit("")).alias("reason"))


@query(f"WITH {_CONV_SQL} SELECT conv_id, {_BEAT_SQL} AS reason FROM conv")
def r7_heartbeat(spark, sf_dir):
    return trajectories(spark, sf_dir).select("conv_id", rules.heartbeat(F.col("scan_text"), F.col("assistant_texts")).alias("reason"))


@query(f"WITH {_JUDGED_SQL} SELECT conv_id, array_to_string(reasons, ',') AS reasons, len(reasons) = 0 AS passed FROM judged")
def r8_all_reasons(spark, sf_dir):
    return judged(spark, sf_dir).select("conv_id", F.array_join("reasons", ",").alias("reasons"), "passed")


@query("SELECT conv_id, coalesce(arg_min(text, turn), '') AS first_text, (arg_min(text, turn) IS NULL OR trim(arg_min(text, turn)) = '' OR trim(arg_min(text, turn)) = 'unknown-session') AS discarded FROM conversations GROUP BY conv_id")
def r9_discarded_session(spark, sf_dir):
    df = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.min_by("text", "turn").alias("first"))
    return df.select("conv_id", F.coalesce("first", F.lit("")).alias("first_text"), merge.discarded(F.col("first")).alias("discarded"))


@query(f"WITH {_JUDGED_SQL} SELECT count(*) AS scanned, count(*) FILTER (WHERE len(reasons) = 0) AS kept, count(*) FILTER (WHERE len(reasons) > 0) AS dropped, CAST(sum(n_messages) AS BIGINT) AS messages FROM judged")
def a1_funnel(spark, sf_dir):
    scan = judged(spark, sf_dir).select("passed", F.lit("{}").alias("envelope"), F.lit(None).cast("string").alias("failure"), F.lit(False).alias("dropped"), "n_messages")
    counted = funnel.counters(scan, F.sum("n_messages").alias("messages"))
    return counted.select("scanned", F.col("filter_kept").alias("kept"), F.col("filter_dropped").alias("dropped"), "messages")


_HIST_SQL = f"WITH {_JUDGED_SQL}, r AS (SELECT conv_id, unnest(reasons) AS reason FROM judged) SELECT reason, count(*) AS n, min(conv_id) AS first_seen FROM r GROUP BY reason ORDER BY n DESC, first_seen, reason"


@query(_HIST_SQL)
def a2_reason_histogram(spark, sf_dir):
    return funnel.histogram(judged(spark, sf_dir), "reasons", "conv_id")


@query(f"{_HIST_SQL} LIMIT 5")
def a3_top_reasons(spark, sf_dir):
    return funnel.top(judged(spark, sf_dir), "reasons", "conv_id", 5)


@query(f"WITH {_JUDGED_SQL} SELECT format, count(*) AS total, count(*) FILTER (WHERE len(reasons) = 0) AS kept, count(*) FILTER (WHERE len(reasons) > 0) AS dropped FROM judged GROUP BY format")
def a4_format_breakdown(spark, sf_dir):
    return funnel.by_format(judged(spark, sf_dir))


@query(f"WITH {_JUDGED_SQL}, r AS (SELECT unnest(reasons) AS reason FROM judged) SELECT reason, count(*) AS n FROM r GROUP BY reason")
def a5_reason_breakdown(spark, sf_dir):
    return funnel.histogram(judged(spark, sf_dir).where(~F.col("passed")), "reasons", "conv_id").select("reason", "n")


@query("WITH s AS (SELECT conv_id % 20 AS sid, count(DISTINCT conv_id) AS n FROM conversations GROUP BY 1) SELECT count(*) AS unique_sessions, count(*) FILTER (WHERE n > 1) AS duplicate_groups, CAST(sum(n - 1) AS BIGINT) AS would_collapse FROM s")
def a6_dedup_stats(spark, sf_dir):
    return dedup.stats(table(spark, sf_dir, "conversations").select("conv_id").distinct().withColumn("sid", F.col("conv_id") % 20), "sid")


@query(f"WITH {_JUDGED_SQL} SELECT format, round(count(*) FILTER (WHERE n_messages > 5) / CAST(count(*) AS DOUBLE), 4) AS long_rate FROM judged GROUP BY format")
def a7_rates(spark, sf_dir):
    df = trajectories(spark, sf_dir).groupBy("format").agg(F.count_if(F.col("n_messages") > 5).alias("a"), F.count("*").alias("b"))
    return df.select("format", funnel.rate(F.col("a"), F.col("b")).alias("long_rate"))


_DAY_SQL = "day AS (SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(count(*) AS BIGINT) AS scanned, CAST(floor(sum(value)) AS DOUBLE) + 0.75 AS elapsed_seconds, count(*) FILTER (WHERE event_id % 3 = 0) AS trace_valid FROM events GROUP BY 1)"


def _days(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("date"))
    return e.agg(F.count("*").alias("scanned"), (F.floor(F.sum("value")) + F.lit(0.75)).alias("elapsed_seconds"), F.count_if(F.col("event_id") % 3 == 0).alias("trace_valid"))


@query(f"WITH {_DAY_SQL} SELECT CAST(sum(scanned) AS BIGINT) AS scanned, CAST(sum(trace_valid) AS BIGINT) AS trace_valid, CAST(sum(CAST(trunc(elapsed_seconds) AS BIGINT)) AS BIGINT) AS elapsed_seconds, max(elapsed_seconds) AS elapsed_seconds_max FROM day")
def a9_day_merge(spark, sf_dir):
    return merge.sum_reports(_days(spark, sf_dir), ("scanned", "trace_valid", "elapsed_seconds"))


@query(f"WITH {_DAY_SQL} SELECT max(elapsed_seconds) AS elapsed_seconds_max FROM day")
def a10_longest_day(spark, sf_dir):
    return _days(spark, sf_dir).agg(F.max("elapsed_seconds").alias("elapsed_seconds_max"))


_MANIFEST_SQL = "m AS (SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS pre_filter, count(*) FILTER (WHERE user_id % 10 = 0) AS gone, CASE WHEN day(min(ts)) % 3 = 0 THEN 0 ELSE count(*) FILTER (WHERE user_id % 10 <> 0) END AS kept FROM events WHERE day(ts) % 2 = 0 GROUP BY 1)"


@query(
    f"WITH {_DAY_SQL}, {_MANIFEST_SQL} SELECT d.date, d.scanned, d.trace_valid, coalesce(m.pre_filter, 0) AS pre_filter, coalesce(m.gone, 0) AS discarded_unknown_session, CAST(coalesce(nullif(m.kept, 0), greatest(d.trace_valid - coalesce(m.gone, 0), 0)) AS BIGINT) AS kept_after_quality_filter FROM day d LEFT JOIN m USING (date)"
)
def a11_day_left_join(spark, sf_dir):
    e = table(spark, sf_dir, "events").where(F.dayofmonth("ts") % 2 == 0).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("date"))
    kept = F.when(F.dayofmonth(F.min("ts")) % 3 == 0, 0).otherwise(F.count_if(F.col("user_id") % 10 != 0))
    m = e.agg(F.count("*").alias("pre_filter"), F.count_if(F.col("user_id") % 10 == 0).alias("discarded_unknown_session"), kept.alias("kept_after_quality_filter"))
    return merge.per_day(_days(spark, sf_dir), m).drop("elapsed_seconds").withColumn("pre_filter", F.coalesce("pre_filter", F.lit(0)))


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS pre_filter, count(*) FILTER (WHERE user_id % 7 = 0) AS discarded_unknown_session, count(*) FILTER (WHERE user_id % 7 <> 0) AS kept_after_quality_filter FROM events GROUP BY 1")
def a12_day_counts(spark, sf_dir):
    return merge.day_counts(table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), (F.col("user_id") % 7 == 0).alias("discarded")))


@query("SELECT conv_id, count(*) FILTER (WHERE role IN ('user', 'assistant', 'tool', 'model') AND turn % 5 <> 4) AS messages_count FROM conversations GROUP BY conv_id")
def a13_message_count(spark, sf_dir):
    """Over trace events as VARIANT; every fifth is no message."""
    kind = F.when(F.col("turn") % 5 == 4, "reasoning").otherwise("message")
    event = F.to_variant_object(F.struct(F.lit("response_item").alias("type"), F.struct(kind.alias("type"), "role").alias("payload")))
    df = table(spark, sf_dir, "conversations").select("conv_id", event.alias("e"))
    return df.groupBy("conv_id").agg(F.count_if(merge.is_message(F.col("e"))).alias("messages_count"))


@query("SELECT count(*) FILTER (WHERE n > 1) AS archives, CAST(coalesce(sum(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) AS members FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)")
def a14_warning_counts(spark, sf_dir):
    """Sources as archives that hold their documents: all but one of each are skipped."""
    n = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").cast("int").alias("jsonl_member_count"))
    tar = n.select("jsonl_member_count", F.array_repeat(F.lit("x"), F.col("jsonl_member_count") - 1).alias("skipped_members"))
    return funnel.archive_counts(tar).select(F.col("archives_with_multiple_jsonl").alias("archives"), F.col("skipped_jsonl_members").alias("members"))


_SESSIONS_SQL = "s AS (SELECT conv_id, conv_id % 20 AS sid, count(*) AS m FROM conversations GROUP BY conv_id)"


def _sessions(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("m")).withColumn("sid", F.col("conv_id") % 20)


@query(f"WITH {_SESSIONS_SQL} SELECT conv_id, sid, m, coalesce(max(m) OVER (PARTITION BY sid ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= m, false) AS dropped FROM s")
def d1_dedup_dropped(spark, sf_dir):
    return dedup.dropped_in_order(_sessions(spark, sf_dir), "sid", "m", ["conv_id"])


@query(f"WITH {_SESSIONS_SQL} SELECT conv_id, sid, m FROM s QUALIFY row_number() OVER (PARTITION BY sid ORDER BY m DESC, conv_id) = 1")
def d1_dedup_winner(spark, sf_dir):
    return dedup.winners(_sessions(spark, sf_dir), "sid", "m", ["conv_id"]).where("winner").drop("winner")


@query(f"WITH {_SESSIONS_SQL} SELECT conv_id, CASE WHEN row_number() OVER (PARTITION BY sid ORDER BY m DESC, conv_id) = 1 THEN '' ELSE 'session_id_duplicate' END AS reasons FROM s")
def d5_dedup_full(spark, sf_dir):
    df = _sessions(spark, sf_dir).withColumn("reasons", F.array().cast("array<string>"))
    return dedup.demoted(df, "sid", "m", ["conv_id"]).select("conv_id", F.array_join("reasons", ",").alias("reasons"))


@query(f"WITH {_SESSIONS_SQL}, c AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY m DESC, conv_id % 3, conv_id) AS rn FROM s WHERE sid <> 0) SELECT conv_id % 3 AS day, count(*) FILTER (WHERE rn = 1) AS kept, count(*) FILTER (WHERE rn > 1) AS cross_day_duplicates FROM c GROUP BY 1")
def d7_cross_day(spark, sf_dir):
    c = _sessions(spark, sf_dir).select((F.col("conv_id") % 3).alias("day"), F.col("conv_id").alias("path"), F.col("sid").alias("session_id"), F.col("m").alias("messages_count"), (F.col("sid") == 0).alias("discarded"))
    return merge.merge_candidates(c).groupBy("day").agg(F.count_if("winner").alias("kept"), F.count_if(~F.col("winner")).alias("cross_day_duplicates"))


@query("SELECT conv_id, array_to_string(list(turn ORDER BY turn), ',') AS turns FROM (SELECT conv_id, turn FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id, role, left(text, 120) ORDER BY turn) = 1) GROUP BY conv_id")
def d8_in_array(spark, sf_dir):
    return _first_turns(spark, sf_dir, text.KEY_CUT)


def _first_turns(spark, sf_dir, cut: int) -> DataFrame:
    df = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    firsts = dedup.first_by_key(F.col("m"), lambda x: F.concat(x["role"], F.lit(":"), F.left(x["text"], F.lit(cut))))
    return df.select("conv_id", F.array_join(F.transform(firsts, lambda x: x["turn"].cast("string")), ",").alias("turns"))


@query("SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'message:' || role || ':' || left(text, 120) WHEN 1 THEN 'function_call:c' || turn ELSE 'function_call_output:c' || turn END AS key FROM conversations")
def d9_event_key(spark, sf_dir):
    call = F.concat(F.lit("c"), F.col("turn"))
    item = (
        F.when(F.col("turn") % 3 == 0, F.to_variant_object(F.struct(F.lit("message").alias("type"), "role", F.array(F.struct(F.lit("output_text").alias("type"), "text")).alias("content"))))
        .when(F.col("turn") % 3 == 1, F.to_variant_object(F.struct(F.lit("function_call").alias("type"), F.lit("f").alias("name"), call.alias("call_id"))))
        .otherwise(F.to_variant_object(F.struct(F.lit("function_call_output").alias("type"), call.alias("call_id"))))
    )
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", export.event_key(item).alias("key"))


_PREFIX_SQL = "p AS (SELECT conv_id, turn, role, text, min(turn) OVER (PARTITION BY conv_id) AS f FROM conversations), q AS (SELECT *, min(CASE WHEN role = 'assistant' AND turn > f THEN turn END) OVER (PARTITION BY conv_id) AS s FROM p)"


@query(f"WITH {_PREFIX_SQL} SELECT conv_id, turn, role FROM q WHERE s IS NULL OR turn < s")
def h7_session_prefix(spark, sf_dir):
    return session.prefix_rows(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role").select("conv_id", "turn", "role")


@query("SELECT conv_id, turn, replace(replace(replace(replace(replace(replace(text, '<think>', ''), '</think>', ''), ' ', ''), chr(10), ''), chr(13), ''), chr(9), '') AS plain FROM conversations")
def h10_normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.without_space(F.col("text")).alias("plain"))


@query(f"WITH {_PREFIX_SQL} SELECT conv_id, 'session_' || md5(replace(replace(replace(replace('[]' || string_agg(role || text, '' ORDER BY turn), ' ', ''), chr(10), ''), chr(13), ''), chr(9), '')) AS session_id FROM q WHERE s IS NULL OR turn < s GROUP BY conv_id")
def h11_session_id(spark, sf_dir):
    """Exact ids of chat-shaped conversations without tools."""
    m = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: F.to_variant_object(F.struct(x["role"].alias("role"), x["text"].alias("content"))))
    df = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(m.alias("messages"))
    df = df.select("conv_id", "messages", F.lit("openai_chat").alias("format"), F.array().cast("array<variant>").alias("tools"), F.lit(None).cast("variant").alias("response"), F.lit("").alias("system_prompt"))
    return session.identify(df).select("conv_id", "session_id")


@query("SELECT doc_id, CAST(doc_id % 4 + 1 AS BIGINT) AS n_blocks, 'tick' AS last_event, CAST(doc_id % 4 AS BIGINT) AS last_value FROM documents")
def p5_sse_blocks(spark, sf_dir):
    """Streams with bad data, bare events and end marks around the blocks that count."""
    one = lambda i: F.concat(F.lit("event: tick\ndata: broken\ndata: {\"v\": "), i.cast("string"), F.lit("}\n\ndata: [DONE]\n\n"))
    stream = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("doc_id") % 4), one), "")
    df = table(spark, sf_dir, "documents").select("doc_id", response.sse_blocks(stream).alias("b"))
    last = F.try_element_at("b", F.lit(-1))
    return df.select("doc_id", F.size("b").cast("long").alias("n_blocks"), last["event"].alias("last_event"), F.try_variant_get(last["data"], "$.v", "bigint").alias("last_value"))


@query("SELECT doc_id, CAST(2 + doc_id % 2 AS BIGINT) AS n_items, text AS answer, 'f' || doc_id AS last_name, CASE WHEN doc_id % 5 = 0 THEN 'incomplete' ELSE 'completed' END AS status FROM documents")
def p8_chunk_merge(spark, sf_dir):
    """Chunk streams whose text and tool calls come in interleaved pieces."""
    return _chunks_merged(spark, sf_dir, F.col("text"))


def _chunks_merged(spark, sf_dir, t: Column) -> DataFrame:
    d = F.col("doc_id")
    delta = lambda **parts: F.concat(F.lit("data: "), F.to_json(F.struct(F.lit("chat.completion.chunk").alias("object"), F.array(F.struct(F.struct(*(v.alias(k) for k, v in parts.items() if k != "finish_reason")).alias("delta"), *(v.alias(k) for k, v in parts.items() if k == "finish_reason"))).alias("choices"))), F.lit("\n\n"))
    call = lambda i, name, args: delta(tool_calls=F.array(F.struct(F.lit(i).alias("index"), F.lit(f"id{i}").alias("id"), F.struct(name.alias("name"), F.lit(args).alias("arguments")).alias("function"))))
    second = F.when(d % 2 == 1, call(1, F.concat(F.lit("f"), d), "{}")).otherwise("")
    end = delta(content=F.lit(""), finish_reason=F.when(d % 5 == 0, "length").otherwise("stop"))
    stream = F.concat(delta(content=F.left(t, F.lit(10))), second, call(0, F.when(d % 2 == 1, "g").otherwise(F.concat(F.lit("f"), d)), "{"), delta(content=F.substr(t, F.lit(11))), call(0, F.lit(""), "}"), end, F.lit("data: [DONE]\n\n"))
    df = response.parse_responses(table(spark, sf_dir, "documents").select("doc_id", stream.alias("s")), "s")
    items = jsonx.items(jsonx.field(F.col("response"), "output"))
    answer = F.try_variant_get(F.get(items, F.lit(0)), "$.content[0].text", "string")
    return df.select("doc_id", F.size(items).cast("long").alias("n_items"), answer.alias("answer"), F.try_variant_get(F.try_element_at(items, F.lit(-1)), "$.name", "string").alias("last_name"), F.try_variant_get("response", "$.status", "string").alias("status"))


@query("SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'openai_responses' WHEN 1 THEN 'openai_chat' WHEN 2 THEN 'bedrock_converse' WHEN 3 THEN 'anthropic_messages' WHEN 4 THEN 'unknown' ELSE 'anthropic_messages' END AS format, CASE doc_id % 6 WHEN 0 THEN 'stop' WHEN 1 THEN 'length' WHEN 2 THEN 'end_turn' WHEN 3 THEN 'tool_use' END AS stop_reason FROM documents")
def n1_detect_format(spark, sf_dir):
    shapes = (
        '{"response": {"object": "response", "status": "completed", "output": []}}',
        '{"response": {"choices": [{"message": {}, "finish_reason": "length"}]}}',
        '{"response": {"stopReason": "end_turn"}}',
        '{"type": "message", "stop_reason": "tool_use", "content": []}',
        '{"note": 1}',
        '{"messages": [{"role": "user", "content": [{"type": "text", "text": "x"}]}]}',
    )
    df = table(spark, sf_dir, "documents").select("doc_id", F.parse_json(_pick(shapes, F.col("doc_id"))).alias("record"))
    df = df.withColumn("response", normalize.response_of(F.col("record")))
    df = df.withColumn("format", normalize.detect_format(F.col("record"), F.col("response")))
    return df.select("doc_id", "format", normalize.stop_reason_of(F.col("format"), F.col("response")).alias("stop_reason"))


@query(f"WITH {_CONV_SQL} SELECT conv_id, system_prompt FROM conv")
def n8_system_prompt(spark, sf_dir):
    """Through VARIANT messages."""
    m = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: F.to_variant_object(F.struct(x["role"].alias("role"), x["text"].alias("content"))))
    df = turns(spark, sf_dir).groupBy("conv_id").agg(m.alias("m"))
    return df.select("conv_id", normalize.system_prompt_of(F.lit(None).cast("variant"), F.col("m")).alias("system_prompt"))


@query(f"WITH {_TURNS_SQL} SELECT conv_id, coalesce(string_agg(text, '|' ORDER BY turn) FILTER (WHERE role = 'assistant' AND text <> ''), '') AS texts FROM turns GROUP BY conv_id")
def n12_assistant_texts(spark, sf_dir):
    return _spoken(spark, sf_dir).select("conv_id", F.array_join("texts", "|").alias("texts"))


@query(f"WITH {_CONV_SQL} SELECT conv_id, last_text FROM conv")
def n13_last_text(spark, sf_dir):
    return _spoken(spark, sf_dir).select("conv_id", F.coalesce(F.try_element_at("texts", F.lit(-1)), F.lit("")).alias("last_text"))


def _spoken(spark, sf_dir) -> DataFrame:
    """conv_id, texts: what assistants say in VARIANT messages, every second turn in a list of blocks."""
    content = lambda x: F.when(x["turn"] % 2 == 0, x["text"].cast("variant")).otherwise(F.to_variant_object(F.array(F.struct(x["text"].alias("text")))))
    m = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: F.to_variant_object(F.struct(x["role"].alias("role"), content(x).alias("content"))))
    df = turns(spark, sf_dir).groupBy("conv_id").agg(m.alias("m"))
    return df.select("conv_id", normalize.assistant_texts_of(F.col("m"), F.parse_json(F.lit("{}"))).alias("texts"))


@query(f"SELECT doc_id, {_TRIM_SQL} AS scan_text FROM documents")
def n14_scan_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.scan_trim(F.col("text")).alias("scan_text"))


@query(r"SELECT doc_id, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS folded FROM documents")
def n15_norm(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.folded(F.col("text")).alias("folded"))


@query("SELECT event_id, event_id % 5 <> 0 AND props IS NOT NULL AS is_object, CASE WHEN event_id % 5 <> 0 THEN CAST(regexp_extract(props, ':\\s*(-?\\d+)', 1) AS BIGINT) ELSE -1 END AS k FROM events")
def s10_json_object(spark, sf_dir):
    """Strict parsing: text after the object makes a line no object."""
    line = F.when(F.col("event_id") % 5 == 0, F.concat("props", F.lit(" x"))).otherwise(F.col("props"))
    v = jsonx.parse(line)
    df = table(spark, sf_dir, "events").select("event_id", v.alias("v"))
    return df.select("event_id", jsonx.is_object(F.col("v")).alias("is_object"), F.coalesce(F.try_variant_get("v", "$.k", "bigint"), F.lit(-1)).alias("k"))


_NAMES = ("a/b.jsonl", "../evil.jsonl", "/abs.jsonl", "c:x.jsonl", "x.txt", "a\\..\\b.jsonl", "ok.jsonl")


@query("SELECT doc_id, doc_id % 7 IN (0, 6) AS safe FROM documents")
def s8_safe_member(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.safe_member(_pick(_NAMES, F.col("doc_id"))).alias("safe"))


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'client_' || doc_id || '_x' WHEN doc_id % 4 = 1 THEN 'resp_' || doc_id WHEN doc_id % 4 = 2 THEN 'log:' || doc_id ELSE 'unknown' END AS session_key FROM documents")
def p12_session_key(spark, sf_dir):
    d, k = F.col("doc_id").cast("string"), F.col("doc_id") % 4
    e = F.struct(F.when(k == 0, F.concat(F.lit("client:"), d, F.lit("/x"))).otherwise("").alias("request_id"), F.when(k == 1, F.concat(F.lit("resp\\"), d)).alias("response_id"), F.when(k == 2, F.concat(F.lit("log:"), d)).alias("logid"))
    df = table(spark, sf_dir, "documents").select("doc_id", F.to_variant_object(e).alias("e"))
    return df.select("doc_id", response.session_key(F.col("e")).alias("session_key"))


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'request_not_string' WHEN 1 THEN 'request_json_error' WHEN 2 THEN 'request_not_object' WHEN 3 THEN 'response_parse_error' END AS failure FROM documents")
def p1_unwrap_failure(spark, sf_dir):
    good = '{"object": "response", "output": []}'
    shapes = ({"request": 1, "response": good}, {"request": "{} x", "response": good}, {"request": "[1]", "response": good}, {"request": "{}", "response": "neither"}, {"request": '{"model": "m"}', "response": good})
    import json

    df = table(spark, sf_dir, "documents").select("doc_id", F.parse_json(_pick([json.dumps(s) for s in shapes], F.col("doc_id"))).alias("envelope"))
    return response.unwrap(df).select("doc_id", "failure")


def _records(spark, sf_dir) -> DataFrame:
    """A Responses record for each conversation."""
    m = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: F.struct(F.lit("message").alias("type"), x["role"].alias("role"), x["text"].alias("content")))
    df = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(m.alias("input"))
    origin = F.struct(F.concat(F.lit("r"), "conv_id").alias("request_id"), F.when(F.col("conv_id") % 2 == 0, F.col("conv_id")).alias("input_tokens"), F.when(F.col("conv_id") % 3 == 0, F.lit(7)).alias("output_tokens"))
    return df.select("conv_id", F.to_variant_object(F.struct("input", F.lit("gpt-5").alias("model"), origin.alias("_provenance"))).alias("record"))


@query(
    """WITH i AS (SELECT conv_id, turn, role, left(text, 120) AS k FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id, role, left(text, 120) ORDER BY turn) = 1),
 n AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) + 1 AS seq, 'response_item' AS type, role FROM i)
 SELECT conv_id, CAST(seq AS BIGINT) AS seq, type, role FROM n
 UNION ALL SELECT conv_id, 0, 'session_meta', NULL FROM (SELECT DISTINCT conv_id FROM conversations) UNION ALL SELECT conv_id, 1, 'turn_context', NULL FROM (SELECT DISTINCT conv_id FROM conversations)
 UNION ALL SELECT conv_id, CAST(count(*) + 2 AS BIGINT), 'event_msg', NULL FROM i WHERE conv_id % 2 = 0 OR conv_id % 3 = 0 GROUP BY conv_id"""
)
def e1_events(spark, sf_dir):
    rows = export.trace_events(_records(spark, sf_dir), "2025-01-01T00:00:00.000Z").select("conv_id", F.posexplode("events").alias("seq", "e"))
    return rows.select("conv_id", F.col("seq").cast("long").alias("seq"), F.col("e.type").alias("type"), F.try_variant_get("e.payload", "$.role", "string").alias("role"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '/w/' || doc_id ELSE '/workspace' END AS cwd FROM documents")
def e3_cwd(spark, sf_dir):
    said = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" <CWD> /w/"), F.col("doc_id"), F.lit(" </cwd> <cwd>/late</cwd>"))).otherwise(F.col("text"))
    r = F.to_variant_object(F.struct(F.array(F.struct(F.lit("user").alias("role"), F.array(F.struct(F.lit("x").alias("type"), said.alias("text"))).alias("content"))).alias("input")))
    df = table(spark, sf_dir, "documents").select("doc_id", r.alias("record"))
    return df.select("doc_id", export.guess_cwd(F.col("record")).alias("cwd"))


@query("SELECT conv_id, CASE WHEN conv_id % 2 = 0 OR conv_id % 3 = 0 THEN CAST(CASE WHEN conv_id % 2 = 0 THEN conv_id ELSE 0 END + CASE WHEN conv_id % 3 = 0 THEN 7 ELSE 0 END AS BIGINT) ELSE -1 END AS total_tokens FROM (SELECT DISTINCT conv_id FROM conversations)")
def e7_token_count(spark, sf_dir):
    df = export.trace_events(_records(spark, sf_dir), "2025-01-01T00:00:00.000Z")
    last = F.try_element_at("events", F.lit(-1))
    return df.select("conv_id", F.coalesce(F.try_variant_get(last["payload"], "$.info.total_token_usage.total_tokens", "bigint"), F.lit(-1)).alias("total_tokens"))


@query("WITH i AS (SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id, role, left(text, 120) ORDER BY turn) = 1) SELECT conv_id, count(*) AS messages_count, arg_max(role, turn) FILTER (WHERE role IN ('assistant', 'model', 'tool')) AS last_relevant_role, 'valid' AS route FROM i GROUP BY conv_id")
def e8_validate(spark, sf_dir):
    df = export.validate(export.trace_events(_records(spark, sf_dir), "2025-01-01T00:00:00.000Z"))
    return df.select("conv_id", F.col("messages_count").cast("long").alias("messages_count"), "last_relevant_role", "route")


def _said(role: Column) -> Column:
    return F.to_variant_object(F.struct(F.lit("message").alias("type"), role.alias("role")))


def _traces(spark, sf_dir, payload: Column) -> DataFrame:
    """conv_id and events: session_meta, then the payload of each turn unless it is null; with roles, that of the conversation."""
    said = F.array_sort(F.collect_list(F.struct("turn", "role")))
    df = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(said.alias("m"), F.collect_set("role").alias("roles"))
    rows = df.select("conv_id", "roles", F.posexplode_outer("m").alias("i", "x")).select("conv_id", "roles", "i", F.col("x.role").alias("role"))
    event = lambda kind, p: F.struct(F.lit(kind).alias("type"), p.alias("payload"))
    rows = rows.select("conv_id", "i", event("response_item", payload).alias("e"))
    items = F.transform(F.array_sort(F.collect_list(F.struct("i", F.to_json(F.col("e.payload")).alias("p")))), lambda x: event("response_item", F.parse_json(x["p"])))
    meta = F.array(event("session_meta", F.parse_json(F.lit("{}"))))
    return rows.groupBy("conv_id").agg(items.alias("items")).select("conv_id", F.concat(meta, F.filter("items", lambda e: e["payload"].isNotNull())).alias("events"))


@query("SELECT conv_id, arg_max(role, turn) FILTER (WHERE role IN ('assistant', 'model', 'tool')) AS last_role FROM conversations GROUP BY conv_id")
def e9_last_role(spark, sf_dir):
    df = export.validate(_traces(spark, sf_dir, _said(F.col("role"))))
    return df.select("conv_id", F.col("last_relevant_role").alias("last_role"))


@query("SELECT page_id, left(translate(url || '|' || url, ':/\\<>|', '______'), 180) AS name FROM pages")
def e12_safe_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.file_name(F.concat("url", F.lit("|"), "url")).alias("name"))


@query("WITH x AS (SELECT doc_id, n_chars * n_chars * (doc_id % 5) AS n FROM documents) SELECT doc_id, CASE WHEN n >= 1073741824 THEN printf('%.1f GiB', n / 1073741824.0) WHEN n >= 1048576 THEN printf('%.1f MiB', n / 1048576.0) WHEN n >= 1024 THEN printf('%.1f KiB', n / 1024.0) ELSE n || ' B' END AS size FROM x")
def f1_byte_size(spark, sf_dir):
    n = F.col("n_chars") * F.col("n_chars") * (F.col("doc_id") % 5)
    return table(spark, sf_dir, "documents").select("doc_id", text.byte_size(n).alias("size"))


@query("SELECT page_id, coalesce(nullif(array_to_string(list_filter(string_split(translate(url, ':|/\\<>', '______'), '_'), lambda x: x <> '' AND x <> '..'), '_'), ''), 'unsafe') AS segment FROM pages")
def f2_sanitize(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.sidecar_segment(F.col("url")).alias("segment"))


@query(f"WITH {_CONV_SQL} SELECT format, printf('%.1f%%', 100.0 * count(*) FILTER (WHERE n_messages > 5) / count(*)) AS share FROM conv GROUP BY format")
def f6_pct(spark, sf_dir):
    df = trajectories(spark, sf_dir).groupBy("format").agg(F.count_if(F.col("n_messages") > 5).alias("a"), F.count("*").alias("b"))
    return df.select("format", text.percent(F.col("a"), F.col("b")).alias("share"))


@query("SELECT doc_id, coalesce(replace(text || '|', '|', '\\|'), '—') AS cell FROM documents")
def f7_cell(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.table_cell(F.concat("text", F.lit("|"))).alias("cell"))


_MEANING_SQL = ", ".join(f"('{k}', '{v}')" for k, v in MEANING.items())


@query(f"WITH {_JUDGED_SQL}, r AS (SELECT unnest(reasons) AS reason FROM judged), d(reason, meaning) AS (VALUES {_MEANING_SQL}) SELECT r.reason, CASE WHEN d.meaning IS NOT NULL THEN d.meaning WHEN starts_with(r.reason, 'stop_reason_') THEN 'stopped by ' || substr(r.reason, 13) ELSE r.reason END AS meaning, count(*) AS n FROM r LEFT JOIN d USING (reason) GROUP BY 1, 2")
def j1_lookup_join(spark, sf_dir):
    """A left join with a table of meanings, whose size is that of the program's own dictionary."""
    meanings = spark.createDataFrame(list(MEANING.items()), "reason string, meaning string")
    df = funnel.histogram(judged(spark, sf_dir), "reasons", "conv_id").join(F.broadcast(meanings), "reason", "left")
    other = F.when(F.col("reason").startswith("stop_reason_"), F.concat(F.lit("stopped by "), F.substr("reason", F.lit(13)))).otherwise(F.col("reason"))
    return df.select("reason", F.coalesce("meaning", other).alias("meaning"), "n")


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def j2_semi(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").where("quality = 1"), "doc_id", "left_semi")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j3_anti(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti")


@query("SELECT 'document' AS kind, doc_id AS id FROM documents UNION ALL SELECT 'page', page_id FROM pages UNION ALL SELECT 'item', item_id FROM benchmark")
def u1_union(spark, sf_dir):
    part = lambda name, key, kind: table(spark, sf_dir, name).select(F.lit(kind).alias("kind"), F.col(key).alias("id"))
    return part("documents", "doc_id", "document").unionByName(part("pages", "page_id", "page")).unionByName(part("benchmark", "item_id", "item"))


@query("SELECT conv_id, CASE WHEN count(*) FILTER (WHERE role IN ('assistant', 'tool')) = 0 THEN 'invalid' WHEN arg_max(role, turn) = 'assistant' THEN 'valid' ELSE 'incomplete' END AS route FROM conversations GROUP BY conv_id")
def k2_route(spark, sf_dir):
    """Turns of others than the assistant as tool outputs; no item at all without an assistant or a tool."""
    output = F.to_variant_object(F.struct(F.lit("function_call_output").alias("type")))
    shown = F.when(F.arrays_overlap("roles", F.array(F.lit("assistant"), F.lit("tool"))), F.when(F.col("role") == "assistant", _said(F.col("role"))).otherwise(output))
    return export.validate(_traces(spark, sf_dir, shown)).select("conv_id", "route")


@query("SELECT event_id, user_id FROM events ORDER BY ts, event_id LIMIT 100")
def l1_limit_records(spark, sf_dir):
    """A limit on records in scan order."""
    return table(spark, sf_dir, "events").orderBy("ts", "event_id").limit(100).select("event_id", "user_id")


def _json(**parts) -> Column:
    return F.to_json(F.struct(*((v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in parts.items())))


def _variant(**parts) -> Column:
    return F.to_variant_object(F.struct(*((v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in parts.items())))


def _docs(spark, sf_dir) -> DataFrame:
    """doc_id, d (as text) and t, the whole text."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("d"), F.col("text").alias("t"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'mine' WHEN 1 THEN 'asked' ELSE '' END AS model, 'openai_responses' AS call_type, 'r' || doc_id AS request_id, CASE WHEN doc_id % 2 = 0 THEN doc_id ELSE -1 END AS input_tokens FROM documents")
def p2_unwrap_record(spark, sf_dir):
    """The request's own model, else the envelope's; keys that the engine adds win over the request's."""
    k = F.col("doc_id") % 3
    request = F.when(k == 0, _json(model="mine", call_type="x")).otherwise(_json(model="", call_type="x"))
    e = _variant(request=request, response='{"object":"response"}', requested_model=F.when(k == 1, "asked"), request_id=F.concat(F.lit("r"), "d"), input=F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    df = response.unwrap(_docs(spark, sf_dir).select("doc_id", e.alias("envelope")))
    get = lambda path, kind="string": F.try_variant_get("record", path, kind)
    return df.select("doc_id", get("$.model").alias("model"), get("$.call_type").alias("call_type"), get("$._provenance.request_id").alias("request_id"), F.coalesce(get("$._provenance.input_tokens", "bigint"), F.lit(-1)).alias("input_tokens"))


@query("SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'a' WHEN 1 THEN 'response' WHEN 2 THEN 'c' WHEN 3 THEN 'd' END AS id, CASE WHEN doc_id % 7 IN (0, 2, 3, 5) THEN 'completed' WHEN doc_id % 7 = 1 THEN 'completed' END AS status FROM documents")
def p3_dispatch(spark, sf_dir):
    """Which of the shapes a response text has."""
    texts = (
        '{"object":"response","id":"a","status":"completed"}',
        'event: response.completed\ndata: {"response":{"id":"response","status":"completed"}}',
        '{"object":"chat.completion","id":"c","choices":[]}',
        '{"object":"chat.completion.chunk","id":"d","choices":[]}',
        '{"object":"other"}',
        '{"object":"response.compaction","output":[]}',
        "plain words",
    )
    df = response.parse_responses(_docs(spark, sf_dir).select("doc_id", _pick(texts, F.col("doc_id")).alias("s")), "s")
    return df.select("doc_id", F.try_variant_get("response", "$.id", "string").alias("id"), F.try_variant_get("response", "$.status", "string").alias("status"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'data: ' || doc_id WHEN 1 THEN ' ping' ELSE 'data: x' END AS stream FROM documents")
def p4_stream_comments(spark, sf_dir):
    k = F.col("doc_id") % 3
    s = F.when(k == 0, F.concat(F.lit(" : ping\n: pong\n\n\n: more\n\ndata: "), "d")).when(k == 1, ":: ping").otherwise("data: x")
    return _docs(spark, sf_dir).select("doc_id", response.without_comments(s).alias("stream"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'm' || doc_id END AS model, CASE WHEN doc_id % 3 = 0 THEN 'incomplete' ELSE 'completed' END AS status, CAST(CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 2 END AS BIGINT) AS n_items FROM documents")
def p6_event_stream(spark, sf_dir):
    """Finished items count; only without any does the completed snapshot's output."""
    d, said = F.col("doc_id"), lambda kind, body: F.concat(F.lit(f"event: {kind}\ndata: "), body, F.lit("\n\n"))
    item = lambda name: said("response.output_item.done", _json(type="response.output_item.done", item=F.struct(F.lit("function_call").alias("type"), F.lit(name).alias("name"))))
    begun = F.when(d % 2 == 0, said("response.created", F.to_json(F.struct(F.lit("response.created").alias("type"), F.struct(F.concat(F.lit("m"), "d").alias("model")).alias("response"))))).otherwise("")
    ended = F.when(d % 3 == 0, said("response.completed", _json(response=F.struct(F.lit("incomplete").alias("status"), F.array(F.struct(F.lit("message").alias("type"))).alias("output"))))).otherwise(F.when(d % 5 == 0, said("response.completed", _json(response=F.struct(F.lit("completed").alias("status"), F.array(F.struct(F.lit("message").alias("type"))).alias("output"))))).otherwise(""))
    items = F.when(d % 5 == 0, "").otherwise(F.concat(item("a"), item("b")))
    df = response.parse_responses(_docs(spark, sf_dir).select("doc_id", F.concat(begun, items, ended, F.lit("event: response.created\n")).alias("s")), "s")
    out = jsonx.items(jsonx.field(F.col("response"), "output"))
    return df.select("doc_id", F.try_variant_get("response", "$.model", "string").alias("model"), F.try_variant_get("response", "$.status", "string").alias("status"), F.size(out).cast("long").alias("n_items"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'output_text' WHEN 1 THEN 'text' WHEN 2 THEN 'reasoning,function_call' ELSE '' END AS kinds, CASE WHEN doc_id % 5 = 0 THEN 'incomplete' ELSE 'completed' END AS status FROM documents")
def p9_completion(spark, sf_dir):
    """A chat completion's message as output items; text hides calls."""
    k = F.col("doc_id") % 4
    calls = '"tool_calls":[{"id":"1","function":{"name":"f","arguments":"{}"}}]'
    bodies = (f'{{"content":"hi",{calls}}}', '{"content":["s",{"type":"text","text":"x"}]}', f'{{"content":null,"reasoning_content":"r",{calls}}}', "{}")
    finish = F.when(F.col("doc_id") % 5 == 0, "length").otherwise("stop")
    s = F.concat(F.lit('{"object":"chat.completion","choices":[{"finish_reason":"'), finish, F.lit('","message":'), _pick(bodies, k), F.lit("}]}"))
    df = response.parse_responses(_docs(spark, sf_dir).select("doc_id", s.alias("s")), "s")
    kinds = F.transform(jsonx.items(jsonx.field(F.col("response"), "output")), lambda x: F.try_variant_get(x, "$.type", "string"))
    return df.select("doc_id", F.array_join(kinds, ",").alias("kinds"), F.try_variant_get("response", "$.status", "string").alias("status"))


@query("SELECT doc_id, CASE doc_id % 2 WHEN 0 THEN 'b' || doc_id ELSE 'inner' END AS id FROM documents")
def p11_data_lines(spark, sf_dir):
    """A stream of whole responses without event names: the last one holds."""
    last = F.when(F.col("doc_id") % 2 == 0, _json(object="response", id=F.concat(F.lit("b"), "d"))).otherwise('{"response":{"id":"inner"}}')
    s = F.concat(F.lit('data: {"object":"response","id":"a"}\n\ndata: broken\n\ndata: '), last, F.lit("\n\ndata: [DONE]"))
    df = response.parse_responses(_docs(spark, sf_dir).select("doc_id", s.alias("s")), "s")
    return df.select("doc_id", F.try_variant_get("response", "$.id", "string").alias("id"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'anthropic_messages' WHEN 1 THEN 'bedrock_converse' WHEN 2 THEN 'openai_chat' ELSE 'openai_responses' END AS format, 'm' || doc_id AS model, CAST(CASE doc_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 0 END AS BIGINT) AS n_tools, CAST(CASE WHEN doc_id % 4 = 3 THEN 1 ELSE 2 END AS BIGINT) AS n_messages, 'told' AS system_prompt FROM documents")
def n7_extract(spark, sf_dir):
    """Four platforms' records as trajectories."""
    said = '"messages":[{"role":"system","content":"told"},{"role":"user","content":"x"}]'
    shapes = (
        f'{{"response":{{"type":"message","model":"@"}},"tools":[{{}}],{said}}}',
        f'{{"response":{{"stopReason":"x"}},"modelId":"@","toolConfig":{{"tools":[1,2]}},{said}}}',
        f'{{"response":{{"object":"chat.completion"}},"model":"@","tools":[],"functions":[1,2,3],{said}}}',
        '{"response":{"object":"response"},"model":"@","input":"ask","instructions":[{"text":"told"},{"text":""}]}',
    )
    r = F.parse_json(F.replace(_pick(shapes, F.col("doc_id")), F.lit("@"), F.concat(F.lit("m"), "d")))
    df = normalize.normalize(_docs(spark, sf_dir).select("doc_id", r.alias("record")))
    return df.select("doc_id", "format", "model", F.col("n_tools").cast("long").alias("n_tools"), F.col("n_messages").cast("long").alias("n_messages"), "system_prompt")


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN text WHEN 1 THEN text || chr(10) || 'two' WHEN 2 THEN '' ELSE text || chr(10) || 'o' END AS joined FROM documents WHERE text <> ''")
def n10_content_text(spark, sf_dir):
    """Content of a message: text, blocks of several keys, nothing."""
    return _contents(_docs(spark, sf_dir))


def _contents(docs: DataFrame) -> DataFrame:
    t = F.col("t")
    block = lambda **kw: F.struct(*((kw[k] if isinstance(kw.get(k), Column) else F.lit(kw.get(k)).cast("string")).alias(k) for k in ("text", "output", "content")))
    v = (
        F.when(F.col("doc_id") % 4 == 0, t.cast("variant"))
        .when(F.col("doc_id") % 4 == 1, F.to_variant_object(F.array(block(text=t, output="no"), block(text=""), block(content="two"))))
        .when(F.col("doc_id") % 4 == 2, F.parse_json(F.lit("null")))
        .otherwise(F.to_variant_object(F.array(block(text=t), block(output="o", content="c"))))
    )
    return docs.where("t <> ''").select("doc_id", v.alias("v")).select("doc_id", normalize.content_text(F.col("v")).alias("joined"))


@query("""SELECT doc_id, 'session_' || md5(replace(replace(replace(replace('[{"function":{"description":"","name":"f","parameters":{}},"type":"function"}]' || 'systemstold' || 'user' || coalesce(text, '') || 'tool' || 'r' || doc_id, ' ', ''), chr(10), ''), chr(13), ''), chr(9), '')) AS session_id FROM documents""")
def h2_canonical_session(spark, sf_dir):
    """Exact ids of conversations in typed blocks: empty blocks go, tool results become turns, the first answer ends the opening."""
    return _opening_ids(_docs(spark, sf_dir))


def _opening_ids(docs: DataFrame) -> DataFrame:
    block = lambda kind, **kw: F.struct(F.lit(kind).alias("type"), *((kw[k] if isinstance(kw.get(k), Column) else F.lit(kw.get(k)).cast("string")).alias(k) for k in ("text", "thinking", "content", "tool_use_id")))
    first = F.to_variant_object(F.struct(F.lit("user").alias("role"), F.array(block("text", text=F.col("t")), block("text", text="(no content)"), block("tool_result", content=F.concat(F.lit("r"), "d"), tool_use_id="1")).alias("content")))
    then = _variant(role="assistant", content="late")
    df = docs.select("doc_id", F.lit("anthropic_messages").alias("format"), F.array(F.parse_json(F.lit('{"name":"f"}'))).alias("tools"), F.array(first, then).alias("messages"), F.lit(None).cast("variant").alias("response"), F.lit("s told").alias("system_prompt"))
    return session.identify(df).select("doc_id", "session_id")


@query("SELECT doc_id, 'session_' || md5('[]' || 'tool' || left(repeat('x', CAST(doc_id % 3 * 800 AS BIGINT)), 1000) || 'assistantreason' || CASE WHEN doc_id % 2 = 0 THEN 'end' ELSE 'open' END) AS session_id FROM documents")
def h5_tool_cut_and_thinking(spark, sf_dir):
    """Long tool outputs are cut; thinking is told from the answer. An assistant turn at the start is part of the opening."""
    answer = F.when(F.col("doc_id") % 2 == 0, "<think> reason </think> so <answer> end </answer>").otherwise("<think> reason </think> open")
    said = F.array(F.struct(F.lit("tool").alias("role"), F.repeat(F.lit("x"), (F.col("doc_id") % 3 * 800).cast("int")).alias("content")))
    once = F.array(F.struct(F.lit("assistant").alias("role"), answer.alias("content")))
    # two openings whose texts add up: the tool's and the assistant's
    both = F.explode(F.array(F.struct(F.lit(0).alias("k"), said.alias("m")), F.struct(F.lit(1).alias("k"), once.alias("m")))).alias("x")
    df = _docs(spark, sf_dir).select("doc_id", F.lit("unknown").alias("format"), F.array().cast("array<variant>").alias("tools"), F.lit(None).cast("variant").alias("response"), F.lit("").alias("system_prompt"), both)
    df = session.with_text(df.select("*", "x.k", F.transform("x.m", F.to_variant_object).alias("messages")))
    parts = df.groupBy("doc_id").agg(F.max(F.when(F.col("k") == 0, F.col("session_text"))).alias("a"), F.max(F.when(F.col("k") == 1, F.col("session_text"))).alias("b"))
    return parts.select("doc_id", session.session_hash(F.concat("a", F.substr("b", F.lit(3)))).alias("session_id"))


_PLAIN_SQL = "replace(replace(replace(replace({}, ' ', ''), chr(10), ''), chr(13), ''), chr(9), '')"


def _answered(docs: DataFrame, fmt: str, response_of) -> DataFrame:
    """Ids of conversations that the response alone makes up (even documents) or that a question opens."""
    asked = F.when(F.col("doc_id") % 2 == 1, F.array(_variant(role="user", content="ask"))).otherwise(F.array().cast("array<variant>"))
    df = docs.select("doc_id", F.lit(fmt).alias("format"), F.array().cast("array<variant>").alias("tools"), asked.alias("messages"), response_of.alias("response"), F.lit("").alias("system_prompt"))
    return session.identify(df).select("doc_id", "session_id")


@query(f"""SELECT doc_id, 'session_' || md5('[]' || CASE WHEN doc_id % 2 = 1 THEN 'userask' ELSE 'assistant' || {_PLAIN_SQL.format("text")} || 'tail' END) AS session_id FROM documents WHERE trim(text) <> ''""")
def h1_bedrock_session(spark, sf_dir):
    """The answer of a Converse response: blocks without a type are texts."""
    content = F.array(F.struct(F.col("t").alias("text")), F.struct(F.lit("tail").alias("text")))
    docs = _docs(spark, sf_dir).where("trim(t) <> ''")
    return _answered(docs, "bedrock_converse", F.to_variant_object(F.struct(F.struct(F.struct(content.alias("content")).alias("message")).alias("output"))))


@query(f"""SELECT doc_id, 'session_' || md5('[]' || CASE WHEN doc_id % 2 = 1 THEN 'userask' ELSE 'assistantwhy' || {_PLAIN_SQL.format("text")} || '[{{"function":{{"arguments":{{"a":1.5,"b":[' || doc_id || ']}},"name":"f"}},"type":"function"}}]' END) AS session_id FROM documents WHERE text <> ''""")
def h1_responses_session(spark, sf_dir):
    """The answer of a Responses object: reasoning, text and a call whose arguments are a JSON text."""
    block = lambda kind: F.array(F.struct(F.lit(kind).alias("type"), F.when(F.lit(kind == "summary_text"), F.lit("why")).otherwise(F.col("t")).alias("text")))
    reasoning = F.to_variant_object(F.struct(F.lit("reasoning").alias("type"), block("summary_text").alias("summary")))
    message = F.to_variant_object(F.struct(F.lit("message").alias("type"), block("output_text").alias("content")))
    call = _variant(type="function_call", call_id="c", name="f", arguments=F.concat(F.lit('{"b": ['), "d", F.lit('], "a": 1.50}')))
    return _answered(_docs(spark, sf_dir).where("t <> ''"), "openai_responses", F.to_variant_object(F.struct(F.lit("response").alias("object"), F.array(reasoning, message, call).alias("output"))))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'r' || doc_id WHEN doc_id % 3 = 1 THEN 's' || doc_id ELSE 'unknown-session' END AS id, CASE WHEN doc_id % 2 = 0 THEN 'mine' ELSE 'gpt-5.5' END AS model FROM documents")
def e2_session_meta(spark, sf_dir):
    k = F.col("doc_id") % 3
    origin = F.struct(F.when(k == 0, F.concat(F.lit("r"), "d")).alias("request_id"), F.when(k == 1, F.concat(F.lit("s"), "d")).alias("response_id"))
    df = _docs(spark, sf_dir).select("doc_id", _variant(_provenance=origin, model=F.when(F.col("doc_id") % 2 == 0, "mine")).alias("record"))
    df = export.trace_events(df, "2025-01-01T00:00:00.000Z").select("doc_id", F.get("events", F.lit(0))["payload"].alias("p"))
    return df.select("doc_id", F.try_variant_get("p", "$.id", "string").alias("id"), F.try_variant_get("p", "$.model", "string").alias("model"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'input_text' ELSE 'output_text' END || ',kept,' || CASE WHEN doc_id % 2 = 0 THEN 'input_text' ELSE 'output_text' END AS kinds FROM documents")
def e4_content_blocks(spark, sf_dir):
    """Strings and untyped texts get the type of their role, typed blocks stay, the rest goes."""
    v = F.parse_json(F.lit('["plain", {"type": "kept"}, {"text": "x"}, {"other": 1}, 5]'))
    role = F.when(F.col("doc_id") % 2 == 0, "developer").otherwise("assistant")
    df = _docs(spark, sf_dir).select("doc_id", v.alias("v"), role.alias("role"))
    kinds = F.transform(export.content_blocks(F.col("v"), F.col("role")), lambda b: F.try_variant_get(b, "$.type", "string"))
    return df.select("doc_id", F.array_join(kinds, ",").alias("kinds"))


_ITEMS = (
    '{"type":"message","role":"user","content":"x","phase":"p"}',
    '{"type":"custom_tool_call","id":"i","name":"f"}',
    '{"type":"function_call_output","call_id":"c","output":"o"}',
    '{"type":"reasoning","summary":[]}',
    '{"role":"user","content":"x"}',
    '{"type":"web_search"}',
    '{"type":"message","content":"x"}',
)


@query("SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'message' WHEN 1 THEN 'custom_tool_call' WHEN 2 THEN 'function_call_output' WHEN 3 THEN 'reasoning' WHEN 4 THEN 'message' END AS kind, CASE doc_id % 7 WHEN 1 THEN 'i' WHEN 2 THEN 'c' END AS call_id, CASE WHEN doc_id % 7 = 0 THEN 'p' END AS phase FROM documents")
def e5_input_items(spark, sf_dir):
    df = _docs(spark, sf_dir).select("doc_id", F.parse_json(_pick(_ITEMS, F.col("doc_id"))).alias("i")).select("doc_id", export.input_payload(F.col("i")).alias("p"))
    return df.select("doc_id", *(F.try_variant_get("p", f"$.{k}", "string").alias(n) for k, n in (("type", "kind"), ("call_id", "call_id"), ("phase", "phase"))))


@query("SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'message' WHEN 1 THEN 'function_call' WHEN 2 THEN 'function_call_output' WHEN 3 THEN 'reasoning' WHEN 5 THEN 'web_search' WHEN 6 THEN 'message' END AS kind, CASE doc_id % 7 WHEN 0 THEN 'user' WHEN 4 THEN 'user' WHEN 6 THEN 'assistant' END AS role FROM documents")
def e6_output_items(spark, sf_dir):
    df = _docs(spark, sf_dir).select("doc_id", F.parse_json(_pick(_ITEMS, F.col("doc_id"))).alias("i")).select("doc_id", export.output_payload(F.col("i")).alias("p"))
    return df.select("doc_id", *(F.try_variant_get("p", f"$.{k}", "string").alias(n) for k, n in (("type", "kind"), ("role", "role"))))


@query("SELECT page_id, strftime(make_date(2025, 1, CAST(page_id % 28 + 1 AS INT)), '%Y%m%d') || '/' || left(translate(url, ':/\\<>|', '______'), 180) || '.jsonl' AS path FROM pages")
def f4_manifest_path(spark, sf_dir):
    day = F.date_format(F.make_date(F.lit(2025), F.lit(1), (F.col("page_id") % 28 + 1).cast("int")), "yyyyMMdd")
    return table(spark, sf_dir, "pages").select("page_id", F.concat_ws("/", day, export.trace_name(F.col("url"))).alias("path"))


@query("SELECT doc_id, n_chars, 'document' AS kind, 5000 AS limit_bytes FROM documents WHERE n_chars > 5000")
def s13_size_guard(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("source_file"), F.when(F.col("n_chars") > 5000, "document").alias("problem"), F.col("n_chars").alias("size_bytes"))
    return delivery.size_warnings(lines, 5000).select(F.col("source_file").alias("doc_id"), F.col("size_bytes").alias("n_chars"), "kind", "limit_bytes")


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 20")
def t1_top_sources(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source").limit(20)


@query("SELECT DISTINCT role FROM conversations")
def u2_distinct(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("role").distinct()


@query("SELECT CAST(regexp_extract(props, ':\\s*(-?\\d+)', 1) AS BIGINT) AS k, count(*) AS n FROM events WHERE props IS NOT NULL GROUP BY 1")
def s4_text_lines(spark, sf_dir):
    """JSON lines written as compressed text, read splittably and parsed strictly."""
    path = new_path(spark, "lines")
    table(spark, sf_dir, "events").select("props").where("props IS NOT NULL").write.option("compression", "gzip").text(path)
    v = jsonx.parse(F.col("raw"))
    return delivery.text_lines(spark, path, "*.txt.gz").select(F.try_variant_get(v, "$.k", "bigint").alias("k")).groupBy("k").agg(F.count("*").alias("n"))


@query(
    """WITH i AS (SELECT DISTINCT conv_id, role, left(text, 120) AS k FROM conversations)
 SELECT 'valid' AS route, 'c' || conv_id AS session_key, CAST(count(*) + 2 + CASE WHEN conv_id % 2 = 0 OR conv_id % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_events FROM i GROUP BY conv_id"""
)
def k1_trace_sink(spark, sf_dir):
    """Trace lines through the bulk sink and back: a folder a route and session, a line an event."""
    stamp, path = "2025-01-01T00:00:00.000Z", new_path(spark, "sink")
    df = export.validate(export.trace_events(_records(spark, sf_dir), stamp)).withColumn("session_key", F.concat(F.lit("c"), "conv_id"))
    sinks.bulk(export.trace_lines(df, stamp, ["route", "session_key"]), path)
    return spark.read.text(path).groupBy("route", "session_key").agg(F.count_if(F.get_json_object("value", "$.type").isNotNull()).alias("n_events"))


@query("SELECT conv_id, CAST(count(*) AS BIGINT) AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles FROM (SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id, role, left(text, 120) ORDER BY turn) = 1) GROUP BY conv_id")
def k9_training_rows(spark, sf_dir):
    """Training rows of valid traces."""
    from .clean import training_rows

    df = export.validate(export.trace_events(_records(spark, sf_dir), "2025-01-01T00:00:00.000Z")).withColumn("session_key", F.col("conv_id"))
    rows = training_rows(df)
    return rows.select(F.col("session_key").alias("conv_id"), F.col("messages_count").cast("long").alias("n_messages"), F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"))
