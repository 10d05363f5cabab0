"""The text under a session id, for every message format."""

import json

import pytest
from pyspark.sql import functions as F

from tracewright.operators import session

USER, LATE = {"role": "user", "content": "ask"}, {"role": "assistant", "content": "late"}
THINK = "a <think> why </think> so <answer> yes </answer> end"
CALL = {"id": "1", "type": "function", "function": {"name": "f", "arguments": "{}"}}
BLOCKS = [
    {"type": "text", "text": " "},
    {"type": "text", "text": "(no content)"},
    {"type": "text", "text": "one"},
    {"text": "two"},
    {"type": "thinking", "thinking": "hm"},
    {"type": "thinking", "thinking": ""},
    {"type": "tool_use", "id": "t", "name": "g", "input": {"b": 1, "a": [2.50]}},
]
RESULTS = [{"type": "tool_result", "tool_use_id": "t", "content": [{"type": "text", "text": "r1"}, {"type": "image"}, {"type": "text", "text": "r2"}]}, {"type": "tool_result", "content": "x" * 1200}]
G = '[{"function":{"arguments":{"a":[2.5],"b":1},"name":"g"},"type":"function"}]'

#: format, tools, messages, response, system prompt, text (null where there is nothing to hash)
CASES = [
    ("openai_chat", [], [USER, LATE, USER], {}, "", "[]userask"),
    ("openai_chat", [], [LATE, USER, LATE], {}, "", "[]assistantlateuserask"),
    ("openai_chat", [], [LATE, USER], {}, "sys", "[]systemsys"),
    ("openai_chat", [], [{"role": "system", "content": "own"}, USER], {}, "sys", "[]systemownuserask"),
    ("openai_chat", [], [], {"choices": [{"message": {"role": "assistant", "content": THINK, "tool_calls": [CALL]}}]}, "", '[]assistantwhyyes[{"function":{"arguments":"{}","name":"f"},"type":"function"}]'),
    ("openai_chat", [], [USER], {"choices": [{"message": LATE}]}, "", "[]userask"),
    ("openai_chat", [], [USER], {"choices": [{"message": {"role": "user", "content": "odd"}}]}, "", "[]useraskuserodd"),
    ("openai_chat", [{"b": 1.0, "a": "\u00e9"}, {"a": 2}], [USER], {}, "", '[{"a":"\u00e9","b":1},{"a":2}]userask'),
    ("openai_chat", [{"a": "z"}, {"a": "\u00e9"}, {"a": "Z"}, {"a": "z\n"}], [USER], {}, "", '[{"a":"Z"},{"a":"\u00e9"},{"a":"z"},{"a":"z\\n"}]userask'),
    ("openai_chat", [], [{"role": "tool", "content": "x" * 2000}, {"content": "no role"}, {"role": "user", "content": [{"text": "a b"}]}], {}, "", "[]tool" + "x" * 1000 + 'noroleuser[{"text":"ab"}]'),
    ("openai_chat", [], [{"role": "user", "content": {"a": 1}}], {}, "", None),
    ("openai_chat", [], [{"role": None, "content": "x"}], {}, "", None),
    ("openai_chat", [], ["no object"], {}, "", None),
    ("unknown", [], [USER], {"choices": [{"message": LATE}]}, "sys", "[]userask"),
    ("anthropic_messages", [{"name": "f", "input_schema": {"type": "object"}}], [{"role": "user", "content": BLOCKS}], {}, "", '[{"function":{"description":"","name":"f","parameters":{"type":"object"}},"type":"function"}]userhmone\ntwo' + G),
    ("anthropic_messages", [], [USER, {"role": "user", "content": [*BLOCKS, *RESULTS]}, LATE], {}, "", "[]useraskuserhmone\ntwo" + G + "toolr1\nr2tool" + "x" * 1000),
    ("anthropic_messages", [], [USER, {"role": "user", "content": RESULTS}], {"content": [{"type": "text", "text": "end"}]}, "", "[]userasktoolr1\nr2tool" + "x" * 1000),
    ("anthropic_messages", [], [USER, {"role": "assistant", "content": RESULTS[:1]}, USER, LATE, USER], {}, "", "[]userasktoolr1\nr2userask"),
    ("anthropic_messages", [], [{"role": "user", "content": [{"type": "image", "z": 1, "a": 2}, {"type": "thinking", "thinking": "hm"}, {"type": "text", "text": "t"}]}], {}, "", '[]userhm[{"a":2,"type":"image","z":1},{"text":"t","type":"text"}]'),
    ("anthropic_messages", [], [{"content": "x", "tool_calls": [CALL], "reasoning_content": "r"}], {}, "", "[]userx"),
    ("anthropic_messages", [], [], {"content": [{"type": "text", "text": "end"}]}, "", "[]assistantend"),
    ("anthropic_messages", [], [], {"content": [{"type": "text", "text": " "}]}, "", None),
    ("bedrock_converse", [], [], {"output": {"message": {"content": [{"text": "end"}]}}}, "", "[]assistantend"),
    ("bedrock_converse", [], [], {"output": {"message": {"content": RESULTS[:1]}}}, "", "[]toolr1\nr2"),
    ("bedrock_converse", [], [], {"output": {"message": {"content": [{"text": "end"}]}}}, "sys", "[]systemsys"),
    ("openai_responses", [], [], {"output": [{"type": "reasoning", "summary": [{"type": "summary_text", "text": "why"}]}, {"type": "message", "content": [{"type": "output_text", "text": "a"}, {"type": "x"}]}, {"type": "message", "content": "b"}, {"type": "function_call", "name": "f", "call_id": "c", "arguments": '{"b": 1, "a": 2}'}, {"type": "function_call", "name": "e", "arguments": "broken {"}]}, "", '[]assistantwhya\nb[{"function":{"arguments":"broken{","name":"e"},"type":"function"},{"function":{"arguments":{"a":2,"b":1},"name":"f"},"type":"function"}]'),
    ("openai_responses", [], [USER], {"output": [{"type": "message", "content": "b"}]}, "", "[]userask"),
    ("openai_responses", [], [], {"output": []}, "", None),
]


@pytest.fixture(scope="module")
def records(spark):
    rows = [(i, f, json.dumps(tools), json.dumps(messages), json.dumps(response), prompt) for i, (f, tools, messages, response, prompt, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, format string, tools string, messages string, response string, system_prompt string")
    listed = lambda c: F.try_variant_get(F.parse_json(c), "$", "array<variant>").alias(c)
    return df.select("i", "format", listed("tools"), listed("messages"), F.parse_json("response").alias("response"), "system_prompt")


def test_texts(records):
    got = {r.i: r.session_text for r in session.with_text(records).collect()}
    for i, case in enumerate(CASES):
        assert got[i] == (None if case[-1] is None else case[-1].replace("\n", "")), case


def test_ids_are_md5_of_the_text(records):
    import hashlib

    for r in session.identify(records).collect():
        text = CASES[r.i][-1]
        assert r.session_id == (None if text is None else "session_" + hashlib.md5(text.replace("\n", "").encode()).hexdigest())
