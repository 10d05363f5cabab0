"""Quality rules R1 to R7 over a normalised trajectory; all are evaluated and every failing reason is kept.

A rule is a function from a prefix-free set of columns to a reason or null. RULES is the extension point.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import folded, strip

# Model families, accepted stop reasons, least transcript, traffic markers.
OPUS = r"(?i)(?:^|[/.\-_])opus[-_](\d+)(?:(?:[-_.])(\d{1,2}))?(?:[-_.@:]|$)"
OPUS_LEGACY = r"(?i)(?:^|[/.\-_])3[-_]opus(?:[-_.@:]|$)"
GPT5 = r"(?i)(?:^|[/.\-_])gpt[-_]?5(?:$|[-_.@:])"
GPT5_SMALL = r"(?i)(?:^|[/.\-_])gpt[-_]?5[-_](?:mini|nano)(?:$|[-_.@:])"
GPT45 = r"(?i)gpt[-_]?4[-_.]5\b"
OPUS_LEAST = (4, 5)
ACCEPTED = {"anthropic_messages": ("end_turn",), "bedrock_converse": ("end_turn", "stop_sequence"), "openai_chat": ("stop",), "openai_responses": ("stop",)}
ACCEPTED_ELSE = ("end_turn", "stop")
MORE_MESSAGES_THAN = 5
SILENT = ("[SLIENT]", "[SILENT]")
FINGERPRINTS = ("[openclaw heartbeat poll]", "[heartbeat:chill]", "read heartbeat.md", "continue the openclaw runtime event")
POLLS = ("openclaw heartbeat poll", "read heartbeat.md", "inside openclaw")
ALIVE = "heartbeat_ok"


def _holds(text: Column, needles: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | text.contains(n)
    return out


def is_opus(model: Column) -> Column:
    """Opus from OPUS_LEAST on; a date after the major version is no minor version."""
    major = F.regexp_extract(model, OPUS, 1).try_cast("long")
    minor = F.coalesce(F.regexp_extract(model, OPUS, 2).try_cast("int"), F.lit(0))
    new = (major > OPUS_LEAST[0]) | ((major == OPUS_LEAST[0]) & (minor >= OPUS_LEAST[1]))
    return F.coalesce(model.rlike(OPUS) & ~model.rlike(OPUS_LEGACY) & new, F.lit(False))


def is_gpt5(model: Column) -> Column:
    return F.coalesce(model.rlike(GPT5) & ~model.rlike(GPT5_SMALL) & ~model.rlike(GPT45), F.lit(False))


def model_match(model: Column) -> Column:
    return F.when(~(is_opus(model) | is_gpt5(model)), F.lit("model_not_target_family"))


def has_tools(n_tools: Column) -> Column:
    return F.when(F.coalesce(n_tools, F.lit(0)) == 0, F.lit("no_tools"))


def min_messages(n_messages: Column) -> Column:
    return F.when(F.coalesce(n_messages, F.lit(0)) <= MORE_MESSAGES_THAN, F.lit(f"messages_le_{MORE_MESSAGES_THAN}"))


def tool_call(has_tool_call: Column) -> Column:
    return F.when(~F.coalesce(has_tool_call, F.lit(False)), F.lit("no_assistant_tool_call"))


def stop_reason(fmt: Column, reason: Column) -> Column:
    fine = F.lit(False)
    for name, values in ACCEPTED.items():
        fine = fine | ((fmt == name) & reason.isin(*values))
    fine = fine | (~fmt.isin(*ACCEPTED) & reason.isin(*ACCEPTED_ELSE))
    return F.when(reason.isNull(), F.lit("stop_reason_missing")).when(~fine, F.concat(F.lit("stop_reason_"), reason))


def system_prompt(prompt: Column, recovered: Column) -> Column:
    blank = (strip(F.coalesce(prompt, F.lit(""))) == "") & (strip(F.coalesce(recovered, F.lit(""))) == "")
    return F.when(blank, F.lit("no_system_prompt"))


def heartbeat(scan_text: Column, assistant_texts: Column) -> Column:
    """Keep-alive traffic; scan_text as written, assistant_texts in order."""
    low = F.lower(scan_text)
    last = folded(F.try_element_at(assistant_texts, F.lit(-1)))
    polled = _holds(low, POLLS) | (F.size(F.filter(assistant_texts, lambda t: folded(t) == ALIVE)) >= 2)
    traffic = (
        _holds(low, FINGERPRINTS)
        | ((last == ALIVE) & polled)
        | last.startswith("evomap heartbeat completed successfully")
        | (last.startswith("evomap heartbeat result") & _holds(last, ("http status", "http_status")))
        | (last.startswith("<heartbeat>") & last.contains("<decision>dont_notify"))
    )
    return F.when(_holds(scan_text, SILENT), F.lit("silent_keepalive_marker")).when(traffic, F.lit("heartbeat_non_task_traffic"))


#: Rule name and the reason column it computes from the columns of a trajectory.
RULES: list[tuple[str, Callable[[], Column]]] = [
    ("R1_model_match", lambda: model_match(F.col("model"))),
    ("R2_has_tools", lambda: has_tools(F.col("n_tools"))),
    ("R3_min_messages", lambda: min_messages(F.col("n_messages"))),
    ("R4_assistant_has_tool_call", lambda: tool_call(F.col("has_tool_call"))),
    ("R5_stop_reason", lambda: stop_reason(F.col("format"), F.col("stop_reason"))),
    ("R6_has_system_prompt", lambda: system_prompt(F.col("system_prompt"), F.col("recovered_prompt"))),
    ("R7_no_heartbeat_traffic", lambda: heartbeat(F.col("scan_text"), F.col("assistant_texts"))),
]


def reasons(rules=None) -> Column:
    return F.array_compact(F.array(*(make() for _, make in rules or RULES)))


def evaluate(df: DataFrame, rules=None) -> DataFrame:
    """df with reasons (in rule order) and passed."""
    return df.withColumn("reasons", reasons(rules)).withColumn("passed", F.size("reasons") == 0)
