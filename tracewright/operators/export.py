"""Flattening a record into ordered trace events, their validation and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import field, first_truthy, items, listed, no_items, objects, present, scalar, string, text_of, truthy, variant
from ..functions.text import KEY_CUT, file_name, working_directory

# Fixed values of the trace format.
DEFAULT_MODEL, DEFAULT_CWD, NO_SESSION = "gpt-5.5", "/workspace", "unknown-session"
CALLS, OUTPUTS = ("function_call", "custom_tool_call"), ("function_call_output", "custom_tool_call_output")


def _empty() -> Column:
    return scalar("")


def content_blocks(content: Column, role: Column) -> Column:
    """Content as typed blocks; what has neither type nor text goes."""
    named = F.when(role.isin("user", "developer"), "input_text").otherwise("output_text")
    block = lambda text: variant(F.struct(named.alias("type"), text.alias("text")))

    def one(b: Column) -> Column:
        keys = F.map_keys(F.try_variant_get(b, "$", "map<string,variant>"))
        return F.when(string(b).isNotNull(), block(string(b))).when(F.array_contains(keys, "type"), b).when(F.array_contains(keys, "text"), block(F.try_variant_get(b, "$.text", "variant")))

    return F.when(string(content).isNotNull(), F.array(block(string(content)))).when(items(content).isNotNull(), F.filter(F.transform(items(content), one), lambda x: x.isNotNull())).otherwise(no_items())


def _message(item: Column, role: Column) -> Column:
    plain = F.struct(F.lit("message").alias("type"), role.alias("role"), content_blocks(field(item, "content"), role).alias("content"))
    phased = F.struct(F.lit("message").alias("type"), role.alias("role"), content_blocks(field(item, "content"), role).alias("content"), field(item, "phase").alias("phase"))
    return F.when(truthy(field(item, "phase")).isNotNull(), variant(phased)).otherwise(variant(plain))


def _call(item: Column, kind: Column) -> Column:
    call_id = F.coalesce(first_truthy(field(item, "call_id"), field(item, "id")), _empty())
    return variant(F.struct(kind.alias("type"), F.coalesce(field(item, "name"), _empty()).alias("name"), call_id.alias("call_id"), F.coalesce(field(item, "arguments"), _empty()).alias("arguments")))


def input_payload(item: Column) -> Column:
    """Payload of an input item; null for an item of unknown type."""
    kind, role = string(field(item, "type")), string(field(item, "role"))
    call_id = F.coalesce(first_truthy(field(item, "call_id"), field(item, "id")), _empty())
    output = variant(F.struct(kind.alias("type"), call_id.alias("call_id"), F.coalesce(field(item, "output"), _empty()).alias("output")))
    return (
        F.when((kind == "message") & role.isNotNull(), _message(item, role))
        .when(kind.isin(*CALLS), _call(item, kind))
        .when(kind.isin(*OUTPUTS), output)
        .when(kind == "reasoning", item)
        .when(present(field(item, "type")).isNull() & role.isNotNull(), _message(item, role))
    )


def output_payload(item: Column) -> Column:
    """Payload of an output item; calls of either kind become function calls, unknown items stay."""
    kind, role = string(field(item, "type")), F.coalesce(string(field(item, "role")), F.lit("assistant"))
    return F.when(kind == "message", _message(item, role)).when(kind.isin(*CALLS), _call(item, F.lit("function_call"))).otherwise(item)


def event_key(payload: Column) -> Column:
    """Key by which a repeated item is known."""
    kind = string(field(payload, "type"))
    joined = lambda v: F.when(items(v).isNotNull(), F.array_join(F.transform(objects(items(v)), lambda b: F.coalesce(text_of(field(b, "text")), F.lit(""))), " ")).otherwise(F.coalesce(text_of(truthy(v)), F.lit("")))
    shown = lambda v: F.coalesce(text_of(v), F.lit("None"))
    return (
        F.when(kind.isin(*CALLS), F.concat(kind, F.lit(":"), shown(F.coalesce(truthy(field(payload, "call_id")), field(payload, "name")))))
        .when(kind.isin(*OUTPUTS), F.concat(kind, F.lit(":"), shown(field(payload, "call_id"))))
        .when(kind == "message", F.concat(F.lit("message:"), F.coalesce(text_of(field(payload, "role")), F.lit("assistant")), F.lit(":"), F.left(joined(field(payload, "content")), F.lit(KEY_CUT))))
        .when(kind == "reasoning", F.concat(F.lit("reasoning:"), F.left(joined(field(payload, "summary")), F.lit(KEY_CUT))))
        .otherwise(F.to_json(payload))
    )


def guess_cwd(record: Column) -> Column:
    texts = F.flatten(
        F.transform(objects(listed(field(record, "input"))), lambda i: F.concat(F.array(string(field(i, "content"))), F.transform(objects(listed(field(i, "content"))), lambda b: string(field(b, "text")))))
    )
    return F.coalesce(F.get(F.filter(F.transform(texts, working_directory), lambda x: x.isNotNull()), F.lit(0)), F.lit(DEFAULT_CWD))


def trace_events(df: DataFrame, stamp: str, record: str = "record") -> DataFrame:
    """df with events: array of (type, payload) in order: session_meta, turn_context, items without repeats, token counts. stamp: export time."""
    r = F.col(record)
    text = lambda v, other: F.coalesce(text_of(v), F.lit(other))
    sid = text(first_truthy(field(r, "_provenance", "request_id"), field(r, "_provenance", "response_id")), NO_SESSION)
    told = F.coalesce(first_truthy(field(r, "instructions"), field(r, "system")), _empty())
    df = df.withColumns({"_cwd": guess_cwd(r), "_model": text(truthy(field(r, "model")), DEFAULT_MODEL)})
    meta = F.struct(sid.alias("id"), F.lit(stamp).alias("timestamp"), F.col("_cwd").alias("cwd"), F.lit("codex_exec").alias("originator"), F.lit("exec").alias("source"), F.lit("openai").alias("model_provider"), F.col("_model").alias("model"), F.struct(told.alias("text")).alias("base_instructions"))
    context = F.struct(F.col("_cwd").alias("cwd"), F.col("_model").alias("model"))
    df = df.withColumns({"_given": F.transform(objects(listed(field(r, "input"))), input_payload), "_made": F.transform(objects(listed(field(r, "response", "output"))), output_payload)})
    df = df.withColumn("_items", F.concat(F.filter("_given", lambda p: p.isNotNull()), F.col("_made")))
    df = df.withColumn("_keys", F.transform("_items", event_key))
    df = df.withColumn("_items", F.filter("_items", lambda p, i: F.array_position("_keys", F.get("_keys", i)) == i + 1))
    n_in, n_out = (F.try_variant_get(r, f"$._provenance.{k}_tokens", "bigint") for k in ("input", "output"))
    a, b = F.coalesce(n_in, F.lit(0)), F.coalesce(n_out, F.lit(0))
    usage = F.struct(F.lit("token_count").alias("type"), F.struct(F.struct(a.alias("input_tokens"), b.alias("output_tokens"), (a + b).alias("total_tokens")).alias("total_token_usage")).alias("info"))
    event = lambda kind, payload: F.struct(F.lit(kind).alias("type"), payload.alias("payload"))
    counted = F.when(n_in.isNotNull() | n_out.isNotNull(), F.array(event("event_msg", variant(usage)))).otherwise(F.array().cast("array<struct<type:string,payload:variant>>"))
    events = F.concat(F.array(event("session_meta", variant(meta)), event("turn_context", variant(context))), F.transform("_items", lambda p: event("response_item", p)), counted)
    return df.withColumn("trace_session", sid).withColumn("events", events).drop("_cwd", "_model", "_given", "_made", "_items", "_keys")


def role_of(payload: Column) -> Column:
    """Role an item speaks in: its message role, assistant for calls, tool for their outputs."""
    kind = string(field(payload, "type"))
    return F.when(kind == "message", string(field(payload, "role"))).when(kind.isin(*CALLS), "assistant").when(kind.isin(*OUTPUTS), "tool")


def validate(df: DataFrame) -> DataFrame:
    """df with messages_count, tools_count, last_relevant_role, route and error.

    Our rule, as the library that judges traces is not at hand: invalid without session_meta first or without a message,
    incomplete if the last of assistant, model and tool roles is tool, valid otherwise.
    """
    roles = F.filter(F.transform(F.filter("events", lambda e: e["type"] == "response_item"), lambda e: role_of(e["payload"])), lambda x: x.isNotNull())
    df = df.withColumn("_roles", roles)
    last = F.try_element_at(F.filter("_roles", lambda x: x.isin("assistant", "model", "tool")), F.lit(-1))
    df = df.withColumns({"messages_count": F.size("_roles"), "last_relevant_role": last})
    bad = (F.coalesce(F.get("events", F.lit(0))["type"], F.lit("")) != "session_meta") | (F.size("_roles") == 0)
    df = df.withColumn("route", F.when(bad, "invalid").when(last == "tool", "incomplete").otherwise("valid"))
    return df.withColumn("error", F.when(bad, "no_messages").when(F.col("route") == "incomplete", "trace_not_complete")).drop("_roles")


def trace_lines(df: DataFrame, stamp: str, keys: list[str]) -> DataFrame:
    """keys, seq, line: one JSON event a row, ready for a text sink."""
    rows = df.select(*keys, F.posexplode("events").alias("seq", "e"))
    line = F.to_json(variant(F.struct(F.lit(stamp).alias("timestamp"), F.col("e.type").alias("type"), F.col("e.payload").alias("payload"))))
    return rows.select(*keys, "seq", line.alias("line"))


def trace_name(key: Column) -> Column:
    return F.concat(file_name(key), F.lit(".jsonl"))


