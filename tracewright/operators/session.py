"""Session identity: md5 of the tools and the opening of a trajectory.

The opening is every message before the first answer (an answer that stands first belongs to it). It is cut out of the
VARIANT messages before anything else, so neither the rest of a conversation nor, as a rule, the response is read. What is
left becomes turns of one shape (role, thought, body, calls), printed and hashed, by column expressions alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.jsonx import any_of, field, first_truthy, is_object, items, listed, no_items, objects, parse, present, scalar, string, truthy, variant
from ..functions.text import TOOL_CUT, strip, without_space

#: Formats whose messages are lists of typed blocks.
TYPED = ("anthropic_messages", "bedrock_converse")
#: Fixed value: a text block with nothing in it says so.
NOTHING = "(no content)"
_TURN = "array<struct<role:string,thought:variant,body:variant,calls:variant>>"


def _turn(role: Column, body: Column, thought: Column | None = None, calls: Column | None = None) -> Column:
    empty = F.lit(None).cast("variant")
    return F.struct(role.alias("role"), (empty if thought is None else thought).alias("thought"), body.alias("body"), (empty if calls is None else calls).alias("calls"))


def _kind(block: Column) -> Column:
    """A block's type; text if it has none."""
    return F.when(field(block, "type").isNull(), F.lit("text")).otherwise(F.coalesce(string(field(block, "type")), F.lit("")))


def telling(blocks: Column) -> Column:
    """Blocks without the texts and thoughts that have nothing in them."""
    said = lambda b, k: strip(F.coalesce(string(field(b, k)), F.lit("")))
    blank = lambda b: F.when(string(field(b, "type")) == "text", said(b, "text").isin("", NOTHING)).when(string(field(b, "type")) == "thinking", said(b, "thinking") == "")
    return F.filter(blocks, lambda b: ~any_of(blank(b)))


def _only_results(blocks: Column) -> Column:
    """Whether a message of blocks holds results of tools and nothing else, so that it speaks in no role of its own."""
    return any_of((F.size(blocks) > 0) & F.forall(blocks, lambda b: _kind(b) == "tool_result"))


def _result(block: Column) -> Column:
    body = field(block, "content")
    texts = F.transform(F.filter(objects(items(body)), lambda x: any_of(string(field(x, "type")) == "text")), lambda x: F.coalesce(string(field(x, "text")), F.lit("")))
    return _turn(F.lit("tool"), F.when(items(body).isNotNull(), scalar(F.array_join(texts, "\n"))).otherwise(body))


def _called(name: Column, arguments: Column) -> Column:
    given = F.struct(F.coalesce(name, scalar("")).alias("name"), F.coalesce(arguments, F.parse_json(F.lit("{}"))).alias("arguments"))
    return variant(F.struct(F.lit("function").alias("type"), given.alias("function")))


def _joined(values: Column, gap: str) -> Column:
    return F.when(F.size(values) > 0, scalar(F.array_join(values, gap)))


def turns_of_blocks(role: Column, blocks: Column) -> Column:
    """A message of typed blocks as turns: what it says, then a turn for each result of a tool."""
    of = lambda kind: F.filter(blocks, lambda b: _kind(b) == kind)
    texts = F.transform(of("text"), lambda b: F.coalesce(string(field(b, "text")), F.lit("")))
    thoughts = F.transform(of("thinking"), lambda b: string(field(b, "thinking")))
    calls = F.transform(of("tool_use"), lambda b: _called(field(b, "name"), field(b, "input")))
    mixed = F.exists(blocks, lambda b: ~_kind(b).isin("text", "thinking", "tool_use", "tool_result"))
    body = F.when(mixed, variant(F.filter(blocks, lambda b: _kind(b) != "thinking"))).otherwise(_joined(texts, "\n"))
    own = F.array(_turn(role, body, _joined(thoughts, "\n\n"), F.when(F.size(calls) > 0, variant(calls))))
    return F.concat(F.when(_only_results(blocks), F.array().cast(_TURN)).otherwise(own), F.transform(of("tool_result"), _result))


def _spoken(message: Column, typed: Column) -> Column:
    return F.struct(message.alias("m"), string(field(message, "role")).alias("role"), F.when(typed, telling(items(field(message, "content")))).alias("blocks"))


def answer_of(fmt: Column, response: Column) -> Column:
    """The message that a response adds to a conversation, in its format's shape; null if it adds none."""
    blocks = F.coalesce(present(field(response, "content")), field(response, "output", "message", "content"))
    typed = F.when(F.size(telling(items(blocks))) > 0, variant(F.struct(F.lit("assistant").alias("role"), blocks.alias("content"))))
    chat = field(F.get(items(field(response, "choices")), F.lit(0)), "message")
    output = objects(items(field(response, "output")))
    of = lambda kind: F.filter(output, lambda x: any_of(string(field(x, "type")) == kind))
    parts = lambda values, *kinds: F.transform(F.filter(objects(values), lambda b: any_of(string(field(b, "type")).isin(*kinds))), lambda b: F.coalesce(string(field(b, "text")), F.lit("")))
    texts = F.flatten(F.transform(of("message"), lambda x: F.when(string(field(x, "content")).isNotNull(), F.array(string(field(x, "content")))).otherwise(parts(listed(field(x, "content")), "output_text", "text"))))
    thoughts = F.flatten(F.transform(of("reasoning"), lambda x: parts(listed(field(x, "summary")), "summary_text", "text")))
    arguments = lambda x: F.coalesce(parse(string(field(x, "arguments"))), field(x, "arguments"))
    calls = F.transform(of("function_call"), lambda x: _called(field(x, "name"), arguments(x)))
    made = F.struct(F.lit("assistant").alias("role"), _joined(texts, "\n").alias("content"), _joined(thoughts, "\n\n").alias("reasoning_content"), F.when(F.size(calls) > 0, variant(calls)).alias("tool_calls"))
    responses = F.when(F.size(F.concat(texts, thoughts)) + F.size(calls) > 0, variant(made))
    return F.when(fmt.isin(*TYPED), typed).when(fmt == "openai_chat", F.when(is_object(chat), chat)).when(fmt == "openai_responses", responses)


def _thought_apart(turn: Column) -> Column:
    """An assistant's tagged thinking told from its answer."""
    text = string(turn["body"])
    inside = lambda x, tag: strip(F.get(F.split(F.get(F.split(x, f"<{tag}>"), F.lit(1)), f"</{tag}>"), F.lit(0)))
    tagged = lambda x, tag: x.contains(f"<{tag}>") & x.contains(f"</{tag}>")
    rest = strip(F.get(F.split(text, "</think>"), F.lit(1)))
    said = F.when(tagged(rest, "answer"), inside(rest, "answer")).otherwise(rest)
    apart = any_of((turn["role"] == "assistant") & tagged(text, "think") & (inside(text, "think") != ""))
    return F.when(apart, _turn(turn["role"], scalar(said), scalar(inside(text, "think")), turn["calls"])).otherwise(turn)


def add_opening(df: DataFrame) -> DataFrame:
    """A normalised trajectory with opening: array of (role, thought, body, calls)."""
    fmt = F.col("format")
    typed, chosen = fmt.isin(*TYPED), F.col("_all")
    df = df.withColumn("_all", F.transform(objects("messages"), lambda m: _spoken(m, fmt.isin(*TYPED))))
    told = (fmt != "unknown") & (F.col("system_prompt") != "") & ~F.exists(chosen, lambda x: any_of(x["role"] == "system"))
    df = df.withColumn("_told", F.coalesce(told, F.lit(False)))
    ends = lambda x, first: any_of((x["role"] == "assistant") & ~_only_results(x["blocks"])) & ~first
    at = F.array_position(F.transform(chosen, lambda x, i: ends(x, (i == 0) & ~F.col("_told"))), True)
    df = df.withColumn("_at", at)
    # the response is only looked at where no message ends the opening
    df = df.withColumn("_reply", F.when(F.col("_at") == 0, answer_of(fmt, F.col("response"))))
    reply = _spoken(F.col("_reply"), typed)
    late = F.col("_reply").isNull() | ends(reply, (F.size(chosen) == 0) & ~F.col("_told"))
    df = df.withColumn("_all", F.when(F.col("_at") > 0, F.slice("_all", F.lit(1), (F.col("_at") - 1).cast("int"))).when(late, chosen).otherwise(F.concat(chosen, F.array(reply))))

    def turns(x: Column) -> Column:
        role = F.when(field(x["m"], "role").isNotNull(), x["role"]).otherwise(F.when(typed, "user").otherwise(""))
        plain = F.when(typed, _turn(role, field(x["m"], "content"))).otherwise(_turn(role, field(x["m"], "content"), field(x["m"], "reasoning_content"), field(x["m"], "tool_calls")))
        return F.when(x["blocks"].isNotNull(), turns_of_blocks(role, x["blocks"])).otherwise(F.array(plain))

    prompt = F.when(F.col("_told"), F.array(_turn(F.lit("system"), scalar(F.col("system_prompt"))))).otherwise(F.array().cast(_TURN))
    df = df.withColumn("_turns", F.concat(prompt, F.flatten(F.transform("_all", turns))))
    return df.withColumn("opening", F.transform("_turns", _thought_apart)).drop("_all", "_told", "_at", "_reply", "_turns")


def tools_in_chat_shape(fmt: Column, tools: Column) -> Column:
    def one(t: Column) -> Column:
        given = first_truthy(field(t, "input_schema"), field(t, "parameters"))
        named = F.struct(*(F.coalesce(field(t, k), scalar("")).alias(k) for k in ("name", "description")), F.coalesce(given, F.parse_json(F.lit("{}"))).alias("parameters"))
        return variant(F.struct(F.lit("function").alias("type"), named.alias("function")))

    return F.when(fmt.isin(*TYPED), F.transform(tools, one)).otherwise(tools)


#: ASCII characters that sort behind the backslash of an escaped character, and stand-ins that sort behind all others.
_LATE = "".join(map(chr, range(0x5D, 0x7F)))
_LATER = "".join(chr(0x10FF00 + ord(c)) for c in _LATE)


def _sorted_list(values: Column) -> Column:
    """A JSON list in the order that its elements' texts have when all beyond ASCII is escaped."""
    keyed = F.array_sort(F.transform(values, lambda v: F.struct(F.translate(F.to_json(v), _LATE, _LATER).alias("k"), F.to_json(v).alias("v"))))
    return F.concat(F.lit("["), F.array_join(F.transform(keyed, lambda x: x["v"]), ","), F.lit("]"))


def _printed(turn: Column) -> Column:
    """role, thought, body and calls in a row; null where one of them has no text."""
    body = F.coalesce(string(turn["body"]), F.when(F.size(items(turn["body"])) > 0, F.to_json(turn["body"])), F.when(truthy(turn["body"]).isNull(), ""))
    bare = F.transform(items(turn["calls"]), lambda c: variant(F.map_filter(F.try_variant_get(c, "$", "map<string,variant>"), lambda k, _: k != "id")))
    calls = F.when(F.size(bare) > 0, _sorted_list(bare)).when(F.size(bare) == 0, "").when(truthy(turn["calls"]).isNull(), "")
    thought = F.coalesce(string(turn["thought"]), F.when(truthy(turn["thought"]).isNull(), ""))
    return F.concat(turn["role"], thought, F.when(turn["role"] == "tool", F.left(body, F.lit(TOOL_CUT))).otherwise(body), calls)


def with_text(df: DataFrame) -> DataFrame:
    """df (a normalised trajectory) with session_text: tools and opening in a row, without spaces; null where there is nothing to hash.

    JSON inside it is as VARIANT keeps it: keys sorted, numbers in plain form (1.0 as 1).
    """
    df = add_opening(df.withColumn("_tools", F.coalesce(tools_in_chat_shape(F.col("format"), F.col("tools")), no_items())))
    pieces = F.transform("opening", _printed)
    text = F.when((F.size(pieces) > 0) & F.forall(pieces, lambda x: x.isNotNull()), F.concat(_sorted_list(F.col("_tools")), F.array_join(pieces, "")))
    return df.withColumn("session_text", without_space(text)).drop("_tools", "opening")


def identify(df: DataFrame) -> DataFrame:
    """df with session_id; null where there is nothing to hash."""
    return with_text(df).withColumn("session_id", session_hash(F.col("session_text"))).drop("session_text")


def prefix_rows(turns: DataFrame, group: str, order: str, role: str) -> DataFrame:
    """Rows of turns up to the first assistant turn; an assistant turn at the very start is included and the next ends it."""
    w = Window.partitionBy(group)
    first = F.min(order).over(w)
    stop = F.min(F.when((F.col(role) == "assistant") & (F.col(order) > F.col("_first")), F.col(order))).over(w)
    return turns.withColumn("_first", first).withColumn("_stop", stop).where(F.col("_stop").isNull() | (F.col(order) < F.col("_stop"))).drop("_first", "_stop")


def session_hash(text: Column) -> Column:
    return F.concat(F.lit("session_"), F.md5(text.cast("binary")))
