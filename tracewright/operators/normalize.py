"""Platform detection and normalisation: a record (VARIANT) becomes the columns of a trajectory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import any_of, field, first_truthy, has, is_object, items, listed, objects, string, text_of
from ..functions.text import scan_trim

SYSTEM_ROLES = ("system", "developer")
CALLS = ("function_call", "custom_tool_call")


def response_of(record: Column) -> Column:
    r = field(record, "response")
    return F.when(is_object(r), r).otherwise(record)


def detect_format(record: Column, response: Column) -> Column:
    """One of four provider formats or unknown; the order of tests matters."""
    obj, output = string(field(response, "object")), field(response, "output")
    first = F.get(items(field(response, "choices")), F.lit(0))
    hint = F.lower(string(field(record, "call_type")))
    messages = items(field(record, "messages"))
    blocks = F.flatten(F.transform(objects(messages), lambda m: listed(field(m, "content"))))
    sniffed = F.exists(blocks, lambda b: any_of(string(field(b, "type")).isin("text", "tool_use", "tool_result", "thinking")))
    return (
        F.when(obj == "response", "openai_responses")
        .when(items(output).isNotNull() & has(response, "status") & ~has(response, "choices"), "openai_responses")
        .when(obj == "chat.completion", "openai_chat")
        .when(has(first, "message") | has(first, "finish_reason") | has(first, "delta"), "openai_chat")
        .when(has(response, "stopReason"), "bedrock_converse")
        .when(is_object(field(response, "output", "message")), "bedrock_converse")
        .when(string(field(response, "type")) == "message", "anthropic_messages")
        .when(has(response, "stop_reason") & items(field(response, "content")).isNotNull(), "anthropic_messages")
        .when(hint.contains("anthropic"), "anthropic_messages")
        .when(hint.contains("bedrock") & hint.contains("converse"), "bedrock_converse")
        .when(hint.contains("responses"), "openai_responses")
        .when(hint.contains("openai") | hint.contains("chat_completion") | hint.contains("chat-completion"), "openai_chat")
        .when((F.size(messages) > 0) & sniffed, "anthropic_messages")
        .when(F.size(messages) > 0, "openai_chat")
        .otherwise("unknown")
    )


def joined_text(value: Column, keys: tuple[str, ...] = ("text",)) -> Column:
    """A string, or the non-empty texts of a list of strings and blocks, a line each; of a block's keys the first that is a string."""
    part = lambda b: F.coalesce(string(b), *(string(field(b, k)) for k in keys))
    return F.coalesce(string(value), F.array_join(F.filter(F.transform(items(value), part), lambda x: x != ""), "\n"), F.lit(""))


def content_text(content: Column) -> Column:
    """Text of a message's content; scalars that are no string in their JSON form."""
    part = lambda b: F.coalesce(string(b), *(string(field(b, k)) for k in ("text", "output", "content")))
    blocks = F.array_join(F.filter(F.transform(items(content), part), lambda x: x != ""), "\n")
    return F.coalesce(string(content), blocks, F.nullif(F.to_json(content), F.lit("null")), F.lit(""))


def system_prompt_of(record: Column, messages: Column) -> Column:
    direct = [F.nullif(joined_text(field(record, k)), F.lit("")) for k in ("system", "system_prompt", "instructions")]
    spoken = F.filter(objects(messages), lambda m: any_of(string(field(m, "role")).isin(*SYSTEM_ROLES)))
    texts = F.filter(F.transform(spoken, lambda m: joined_text(field(m, "content"))), lambda x: x != "")
    return F.coalesce(*direct, F.get(texts, F.lit(0)), F.lit(""))


def stop_reason_of(fmt: Column, response: Column) -> Column:
    status, why = text_of(field(response, "status")), text_of(field(response, "incomplete_details", "reason"))
    last = F.try_element_at(items(field(response, "output")), F.lit(-1))
    responses = (
        F.when(string(field(last, "type")).isin(*CALLS), "tool_calls")
        .when(status == "completed", "stop")
        .when((status == "incomplete") & (why == "max_output_tokens"), "length")
        .when((status == "incomplete") & (why == "content_filter"), "content_filter")
    )
    return (
        F.when(fmt == "anthropic_messages", text_of(field(response, "stop_reason")))
        .when(fmt == "bedrock_converse", text_of(field(response, "stopReason")))
        .when(fmt == "openai_chat", text_of(field(F.get(items(field(response, "choices")), F.lit(0)), "finish_reason")))
        .when(fmt == "openai_responses", responses)
    )


def _message_has_call(m: Column) -> Column:
    block = lambda b: any_of(string(field(b, "type")).isin("tool_use", "toolUse"), is_object(field(b, "toolUse")))
    return any_of(F.size(items(field(m, "tool_calls"))) > 0, is_object(field(m, "function_call")), F.exists(listed(field(m, "content")), block))


def has_tool_call(fmt: Column, messages: Column, response: Column) -> Column:
    """Whether some assistant turn, in the request or the response, called a tool (four shapes)."""
    call = lambda x: any_of(string(field(x, "type")).isin(*CALLS))
    message = field(F.get(items(field(response, "choices")), F.lit(0)), "message")
    turns = F.filter(objects(messages), lambda m: any_of(string(field(m, "role")) == "assistant"))
    used = lambda b: any_of(string(field(b, "type")) == "tool_use")
    return any_of(
        (fmt == "openai_responses") & F.exists(messages, call),
        F.exists(turns, _message_has_call),
        F.size(items(field(message, "tool_calls"))) > 0,
        is_object(field(message, "function_call")),
        F.exists(listed(field(response, "content")), used),
        F.exists(listed(field(response, "output", "message", "content")), lambda b: has(b, "toolUse") | used(b)),
        F.exists(listed(field(response, "output")), call),
    )


def assistant_texts_of(messages: Column, response: Column) -> Column:
    """Non-empty assistant texts: of the request, then of each place a response may hold one."""
    said = lambda m: any_of(string(field(m, "role")) == "assistant")
    text = lambda m: content_text(field(m, "content"))
    output = F.filter(objects(listed(field(response, "output"))), lambda m: said(m) & any_of(string(field(m, "type")) == "message"))
    one = F.array(F.when(is_object(field(F.get(items(field(response, "choices")), F.lit(0)), "message")), content_text(field(F.get(items(field(response, "choices")), F.lit(0)), "message", "content"))), content_text(field(response, "content")), F.when(is_object(field(response, "output", "message")), content_text(field(response, "output", "message", "content"))))
    return F.filter(F.concat(F.transform(F.filter(objects(messages), said), text), one, F.transform(output, text)), lambda x: x != "")


def scan_text_of(messages: Column, prompt: Column) -> Column:
    """Texts of all but tool messages, then the system prompt; both ends of long ones."""
    spoken = F.filter(objects(messages), lambda m: ~any_of(string(field(m, "role")) == "tool"))
    texts = F.filter(F.transform(spoken, lambda m: content_text(field(m, "content"))), lambda x: x != "")
    parts = F.concat(F.transform(texts, lambda x: scan_trim(x)), F.when(prompt != "", F.array(scan_trim(prompt))).otherwise(F.array().cast("array<string>")))
    return F.array_join(parts, "\n")


def normalize(df: DataFrame, record: str = "record") -> DataFrame:
    """df with the columns of a trajectory, computed from a VARIANT column in steps so that each is evaluated once."""
    r = F.col(record)
    df = df.withColumn("response", response_of(r))
    df = df.withColumn("format", detect_format(r, F.col("response")))
    fmt, response = F.col("format"), F.col("response")
    df = df.withColumns({"_in": field(r, "input"), "_said": listed(field(r, "messages"))})
    alone = F.when(string(F.col("_in")).isNotNull(), F.array(F.to_variant_object(F.struct(F.lit("user").alias("role"), string(F.col("_in")).alias("content")))))
    messages = F.when(fmt == "openai_responses", F.coalesce(alone, items(F.col("_in")), F.col("_said"))).otherwise(F.col("_said"))
    tools = F.when(fmt == "bedrock_converse", field(r, "toolConfig", "tools")).when(fmt == "openai_chat", first_truthy(field(r, "tools"), field(r, "functions"))).otherwise(field(r, "tools"))
    named = F.when(fmt == "bedrock_converse", first_truthy(field(r, "model"), field(r, "modelId"), field(response, "model"))).otherwise(first_truthy(field(r, "model"), field(response, "model")))
    model = F.coalesce(F.when(fmt == "unknown", string(field(r, "model"))).otherwise(text_of(named)), F.lit(""))
    df = df.withColumns({"messages": messages, "tools": listed(tools), "model": model, "stop_reason": stop_reason_of(fmt, response)}).drop("_in", "_said")
    df = df.withColumn("_m", objects(F.col("messages")))
    df = df.withColumns({"system_prompt": system_prompt_of(r, F.col("_m")), "n_tools": F.size("tools"), "n_messages": F.size("messages"), "has_tool_call": has_tool_call(fmt, F.col("messages"), response), "assistant_texts": assistant_texts_of(F.col("_m"), response)})
    recovered = F.when(F.col("system_prompt").rlike(r"\S"), F.lit("")).otherwise(system_prompt_of(response, F.col("_m")))
    return df.withColumns({"recovered_prompt": recovered, "scan_text": scan_text_of(F.col("_m"), F.col("system_prompt"))}).drop("_m")
