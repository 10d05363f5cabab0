"""Response texts (JSON or server-sent events of several shapes) to one response object, as a VARIANT column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import any_of, field, has, is_object, items, listed, no_items, objects, parse, scalar, string, text_of, truthy, variant
from ..functions.text import strip

EVENTS = ("response.created", "response.completed", "response.output_item.done")
CHUNK = "chat.completion.chunk"


def without_comments(text: Column) -> Column:
    """A stream without the comment blocks that open it."""
    cut = F.regexp_replace(strip(text), r"^(?::(?s:.*?)\n\n\s*)+", "")
    return F.when(cut.startswith(":"), F.regexp_replace(cut, "^:+", "")).otherwise(cut)


def sse_blocks(text: Column) -> Column:
    """Array of (event, data): of each blank-line block the last event name and the last data line that is an object."""

    def lines(block: Column, name: str) -> Column:
        return F.transform(F.filter(F.split(block, "\n"), lambda x: x.startswith(name)), lambda x: strip(F.substr(x, F.lit(len(name) + 1))))

    def one(block: Column) -> Column:
        data = F.filter(F.transform(lines(block, "data:"), parse), is_object)
        return F.struct(F.try_element_at(lines(block, "event:"), F.lit(-1)).alias("event"), F.try_element_at(data, F.lit(-1)).alias("data"))

    return F.filter(F.transform(F.split(text, "\n\n"), one), lambda b: b["event"].isNotNull() | b["data"].isNotNull())


def every_data_line(text: Column) -> Column:
    """All data lines of a stream that are objects."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.startswith("data:"))
    return F.filter(F.transform(lines, lambda x: parse(strip(F.substr(x, F.lit(6))))), is_object)


def _reasoning(text: Column) -> Column:
    return variant(F.struct(F.lit("reasoning").alias("type"), F.array(F.struct(F.lit("summary_text").alias("type"), text.alias("text"))).alias("summary")))


def _call(name: Column, call_id: Column, arguments: Column) -> Column:
    return variant(F.struct(F.lit("function_call").alias("type"), name.alias("name"), call_id.alias("call_id"), arguments.alias("arguments")))


def _optional(condition: Column, item: Column) -> Column:
    return F.when(condition, F.array(item)).otherwise(no_items())


def _last(values: Column) -> Column:
    return F.try_element_at(F.filter(F.transform(values, truthy), lambda x: x.isNotNull()), F.lit(-1))


def _response(**parts: Column) -> Column:
    return variant(F.struct(F.lit("response").alias("object"), *(v.alias(k) for k, v in parts.items())))


def add_chunks(df: DataFrame, chunks: str, out: str) -> DataFrame:
    """out: one response from streamed chunks: texts concatenated, tool calls merged by their index."""
    df = df.withColumn("_own", F.filter(chunks, lambda c: any_of(string(field(c, "object")) == CHUNK)))
    df = df.withColumn("_choices", F.flatten(F.transform("_own", lambda c: objects(listed(field(c, "choices"))))))
    df = df.withColumn("_deltas", objects(F.transform("_choices", lambda c: field(c, "delta"))))
    said = lambda k: F.array_join(F.transform("_deltas", lambda d: text_of(truthy(field(d, k)))), "")
    pieces = F.transform(
        objects(F.flatten(F.transform("_deltas", lambda d: listed(field(d, "tool_calls"))))),
        lambda t: F.struct(F.coalesce(F.try_variant_get(t, "$.index", "int"), F.lit(0)).alias("i"), text_of(truthy(field(t, "id"))).alias("id"), text_of(truthy(field(t, "function", "name"))).alias("name"), text_of(field(t, "function", "arguments")).alias("arguments")),
    )
    finish = text_of(_last(F.transform("_choices", lambda c: field(c, "finish_reason"))))
    df = df.withColumns({"_thought": said("reasoning_content"), "_text": said("content"), "_pieces": pieces, "_finish": finish, **{f"_{k}": _last(F.transform("_own", lambda c: field(c, k))) for k in ("id", "model", "usage")}})
    slots = F.transform(F.array_sort(F.array_distinct(F.transform("_pieces", lambda p: p["i"]))), lambda i: F.filter("_pieces", lambda p: p["i"] == i))
    joined = lambda mine, k: F.array_join(F.transform(mine, lambda p: p[k]), "")
    last_id = lambda mine: F.coalesce(F.try_element_at(F.filter(F.transform(mine, lambda p: p["id"]), lambda x: x.isNotNull()), F.lit(-1)), F.lit(""))
    calls = F.transform(slots, lambda mine: _call(joined(mine, "name"), last_id(mine), joined(mine, "arguments")))
    message = variant(F.struct(F.lit("message").alias("type"), F.lit("assistant").alias("role"), F.array(F.struct(F.lit("output_text").alias("type"), F.col("_text").alias("text"))).alias("content")))
    output = F.concat(_optional(F.col("_thought") != "", _reasoning(F.col("_thought"))), _optional(F.col("_text") != "", message), calls)
    status = F.when(F.col("_finish") == "length", "incomplete").otherwise("completed")
    value = F.when(F.col(chunks).isNotNull(), _response(id=F.col("_id"), model=F.col("_model"), status=status, output=output, usage=F.col("_usage")))
    return df.withColumn(out, value).drop("_own", "_choices", "_deltas", "_thought", "_text", "_pieces", "_finish", "_id", "_model", "_usage")


def from_completion(payload: Column) -> Column:
    """A chat completion: string content is the only output item and hides tool calls."""
    choice = F.get(items(field(payload, "choices")), F.lit(0))
    message = field(choice, "message")
    content = field(message, "content")
    fn = lambda t, k: F.coalesce(field(t, "function", k), scalar(""))
    calls = F.transform(objects(listed(field(message, "tool_calls"))), lambda t: _call(fn(t, "name"), F.coalesce(field(t, "id"), scalar("")), fn(t, "arguments")))
    thought = text_of(truthy(field(message, "reasoning_content")))
    output = (
        F.when(string(content) != "", F.array(variant(F.struct(F.lit("output_text").alias("type"), string(content).alias("text")))))
        .when(items(content).isNotNull(), objects(items(content)))
        .otherwise(F.concat(_optional(thought.isNotNull(), _reasoning(thought)), calls))
    )
    status = F.when(text_of(field(choice, "finish_reason")) == "length", "incomplete").otherwise("completed")
    return _response(id=field(payload, "id"), model=field(payload, "model"), status=status, output=output, usage=field(payload, "usage"))


def add_events(df: DataFrame, blocks: str, out: str) -> DataFrame:
    """out: the response of a stream of events: finished items, or those of a completed snapshot if there were none."""
    typed = F.transform(F.filter(blocks, lambda b: b["data"].isNotNull()), lambda b: F.struct(F.coalesce(text_of(truthy(field(b["data"], "type"))), b["event"]).alias("t"), b["data"].alias("d")))
    df = df.withColumn("_typed", typed)
    of = lambda *names: F.transform(F.filter("_typed", lambda b: b["t"].isin(*names)), lambda b: b["d"])
    done = F.transform(of(EVENTS[2]), lambda d: F.coalesce(truthy(field(d, "item")), field(d, "output_item")))
    whole = lambda data: objects(F.transform(data, lambda d: field(d, "response")))
    df = df.withColumns({"_done": objects(done), "_snaps": whole(of(EVENTS[1])), "_heads": whole(of(EVENTS[0], EVENTS[1]))})
    filled = F.filter(F.transform("_snaps", lambda s: objects(listed(field(s, "output")))), lambda o: F.size(o) > 0)
    df = df.withColumns({"_snap": F.try_element_at("_snaps", F.lit(-1)), "_full": F.get(filled, F.lit(0)), **{f"_{k}": _last(F.transform("_heads", lambda h: field(h, k))) for k in ("id", "model")}})
    output = F.when(F.size("_done") > 0, F.col("_done")).otherwise(F.coalesce(F.col("_full"), no_items()))
    snap = F.col("_snap")
    status = F.when(has(snap, "status"), field(snap, "status")).otherwise(scalar("completed"))
    value = _response(id=F.col("_id"), model=F.col("_model"), status=status, output=output, usage=field(snap, "usage"), incomplete_details=field(snap, "incomplete_details"))
    return df.withColumn(out, F.when(F.col(blocks).isNotNull(), value)).drop("_typed", "_done", "_snaps", "_heads", "_snap", "_full", "_id", "_model")


def parse_responses(df: DataFrame, text: str, out: str = "response") -> DataFrame:
    """df with out: the response object of a text column, null where there is none to be read."""
    n, p = F.col("_n"), F.col("_p")
    df = df.withColumn("_n", without_comments(F.col(text)))
    df = df.withColumn("_p", F.when(n.startswith("{"), parse(n))).withColumn("_o", string(field(p, "object")))
    df = df.withColumn("_b", F.when(~n.startswith("{") & (n != ""), sse_blocks(n)))
    df = df.withColumn("_c", F.filter(F.transform("_b", lambda b: b["data"]), lambda d: d.isNotNull()))
    streamed = F.exists("_b", lambda b: b["data"].isNotNull() & any_of(text_of(field(b["data"], "type")).startswith("response."), b["event"].isin(*EVENTS)))
    shape = lambda values: string(field(F.get(values, F.lit(0)), "object"))
    df = df.withColumns({"_s": F.coalesce(streamed, F.lit(False)), "_oc": shape("_c")})
    # single data lines matter only where blocks tell no shape
    df = df.withColumn("_l", F.when(F.col("_b").isNotNull() & ~F.col("_s") & ~any_of(F.col("_oc") == CHUNK), every_data_line(n)))
    df = df.withColumn("_ol", shape("_l"))
    chunks = F.when(F.col("_o") == CHUNK, F.array(p)).when(F.col("_s"), None).when(F.col("_oc") == CHUNK, F.col("_c")).when(F.col("_ol") == CHUNK, F.col("_l"))
    df = df.withColumns({"_k": chunks, "_e": F.when(F.col("_s"), F.col("_b")), "_last": F.try_element_at("_l", F.lit(-1))})
    df = add_events(add_chunks(df, "_k", "_fc"), "_e", "_fe")
    empty = _response(status=F.lit("completed"), output=no_items())
    tail = field(F.col("_last"), "response")
    value = (
        F.when(F.col("_o") == "response", p)
        .when(F.col("_o") == "response.compaction", _response(status=F.lit("completed"), output=listed(field(p, "output"))))
        .when(F.col("_o") == "chat.completion", from_completion(p))
        .when(F.col("_fc").isNotNull(), F.col("_fc"))
        .when(F.col("_fe").isNotNull(), F.col("_fe"))
        .when(F.col("_b").isNull() | ((F.size("_b") == 0) & ~n.startswith("data:")), None)
        .when(F.col("_ol") == "response", F.when(is_object(tail), tail).otherwise(F.col("_last")))
        .otherwise(empty)
    )
    return df.withColumn(out, value).drop("_n", "_p", "_o", "_b", "_l", "_c", "_s", "_oc", "_ol", "_k", "_e", "_last", "_fc", "_fe")


def unwrap(df: DataFrame, envelope: str = "envelope") -> DataFrame:
    """df with failure (null if none), request, response and record: the unwrapped L1 object of a delivery envelope."""
    e = F.col(envelope)
    df = df.withColumn("_q", string(field(e, "request"))).withColumn("request", parse(F.col("_q")))
    df = parse_responses(df.withColumn("_r", text_of(field(e, "response"))), "_r")
    failure = (
        F.when(F.col("_q").isNull(), "request_not_string")
        .when(F.col("request").isNull(), "request_json_error")
        .when(~is_object(F.col("request")), "request_not_object")
        .when(F.col("response").isNull(), "response_parse_error")
    )
    model = F.coalesce(truthy(field(F.col("request"), "model")), truthy(field(e, "model")), truthy(field(e, "requested_model")), scalar(""))
    origin = F.struct(*(field(e, a).alias(b) for a, b in (("request_id", "request_id"), ("response_id", "response_id"), ("usage_log_id", "usage_log_id"), ("logid", "logid"), ("trajectory_state", "trajectory_state"), ("stop_reason", "source_stop_reason"), ("input", "input_tokens"), ("output", "output_tokens"))))
    own = F.map_filter(F.try_variant_get(F.col("request"), "$", "map<string,variant>"), lambda k, v: ~k.isin("model", "response", "call_type", "_provenance"))
    added = F.create_map(F.lit("model"), model, F.lit("response"), F.col("response"), F.lit("call_type"), scalar("openai_responses"), F.lit("_provenance"), variant(origin))
    df = df.withColumn("failure", failure)
    return df.withColumn("record", F.when(F.col("failure").isNull(), variant(F.map_concat(own, added)))).drop("_q", "_r")


def session_key(envelope: Column) -> Column:
    """The first id of an envelope, made safe for a file name; its log id as it is; else unknown."""
    ids = F.coalesce(*(truthy(field(envelope, k)) for k in ("request_id", "response_id", "usage_log_id")))
    return F.coalesce(F.translate(text_of(ids), ":/\\", "___"), text_of(truthy(field(envelope, "logid"))), F.lit("unknown"))
