import json

from pyspark.sql import functions as F

from tests.samples import TOOLS
from tracewright import cli
from tracewright.operators import dedup, response
from tracewright.plans import platforms
from tracewright.streaming import longest

TURNS = [{"role": "user", "content": f"say {i}"} if i % 2 == 0 else {"role": "assistant", "content": f"said {i}"} for i in range(6)]
CHAT = {"model": "gpt-5", "tools": TOOLS, "messages": [{"role": "system", "content": "s"}, *TURNS, {"role": "assistant", "tool_calls": [{"id": "1"}]}], "response": {"object": "chat.completion", "choices": [{"message": {"role": "assistant", "content": "end"}, "finish_reason": "stop"}]}}
CLAUDE = {"model": "claude-opus-4-5", "system": "s", "tools": TOOLS, "messages": [*TURNS, {"role": "assistant", "content": [{"type": "tool_use", "id": "t", "name": "f", "input": {}}]}], "response": {"type": "message", "stop_reason": "end_turn", "content": [{"type": "text", "text": "x"}]}}
BEDROCK = {"modelId": "us.anthropic.claude-opus-4-6-v1:0", "system": [{"text": "s"}], "toolConfig": {"tools": TOOLS}, "messages": [{"role": "user", "content": "other"}, *TURNS[1:], {"role": "assistant", "content": [{"toolUse": {"name": "f"}}]}], "response": {"stopReason": "stop_sequence", "output": {"message": {"content": [{"text": "x"}]}}}}


def write(folder, **records):
    folder.mkdir(parents=True)
    for name, r in records.items():
        (folder / f"{name}.json").write_text(r if isinstance(r, str) else json.dumps(r))


def test_each_platform_passes_and_repeats_are_demoted(spark, tmp_path):
    longer = CHAT | {"messages": [*CHAT["messages"], {"role": "user", "content": "more"}]}
    write(tmp_path / "in", chat=CHAT, claude=CLAUDE, bedrock=BEDROCK, longer=longer, bad="[1]", none={"a": 1})
    df = platforms.judge_files(spark, str(tmp_path / "in"))
    got = {r.source_file.rsplit("/", 1)[1]: (r.format, r.passed, r.reasons) for r in df.collect()}
    assert got["longer.json"] == ("openai_chat", True, [])
    assert got["chat.json"] == ("openai_chat", False, ["session_id_duplicate"])
    assert got["claude.json"] == ("anthropic_messages", True, []) and got["bedrock.json"] == ("bedrock_converse", True, [])
    assert got["bad.json"][0] == "parse_error" and got["none.json"][0] == "unknown"
    s = platforms.summary(df)
    assert (s["scanned"], s["kept"], s["dedup_dropped"], s["parse_errors"]) == (6, 3, 1, 1)
    assert s["dedup_stats"] == {"unique_sessions": 3, "duplicate_groups": 1, "would_collapse": 1}
    assert cli.main(["filter", str(tmp_path / "in"), "--output", str(tmp_path / "kept"), "--report", str(tmp_path / "r.json")]) == 0
    assert sorted(p.name for p in (tmp_path / "kept").iterdir()) == ["bedrock.json", "claude.json", "longer.json"]


def test_response_shapes(spark):
    done = 'event: response.output_item.done\ndata: {"type":"response.output_item.done","item":{"type":"function_call","name":"f"}}'
    rows = [
        (": hello\n\nevent: response.created\ndata: {\"type\":\"response.created\",\"response\":{\"id\":\"r1\",\"model\":\"m\"}}\n\n" + done, "r1", "completed", ["function_call"]),
        ('event: response.completed\ndata: {"type":"response.completed","response":{"id":"r2","status":"incomplete","output":[{"type":"message"}]}}', "r2", "incomplete", ["message"]),
        ('{"object":"chat.completion","id":"c","choices":[{"finish_reason":"length","message":{"content":null,"tool_calls":[{"id":"1","function":{"name":"f","arguments":"{}"}}]}}]}', "c", "incomplete", ["function_call"]),
        ('{"object":"chat.completion","id":"d","choices":[{"message":{"content":"hi","tool_calls":[{"id":"1"}]}}]}', "d", "completed", ["output_text"]),
        ('{"object":"response.compaction","output":[{"type":"x"}]}', None, "completed", ["x"]),
        ('{"object":"other"}', None, None, None),
        ('data: {"object":"response","id":"z","status":"completed","output":[]}', "z", "completed", []),
        ("event: a\r\ndata: {}\r\n\r\n", None, "completed", []),
        ("neither", None, None, None),
        ("  ", None, None, None),
        (None, None, None, None),
    ]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, t string")
    out = response.parse_responses(df, "t").select("i", F.try_variant_get("response", "$.id", "string"), F.try_variant_get("response", "$.status", "string"), F.transform(F.try_variant_get("response", "$.output", "array<variant>"), lambda x: F.try_variant_get(x, "$.type", "string")))
    assert [tuple(r)[1:] for r in out.orderBy("i").collect()] == [r[1:] for r in rows]


def test_dedup_equals_a_loop(spark):
    import random

    rnd = random.Random(5)
    rows = [(i, f"s{rnd.randrange(9)}", rnd.randrange(6)) for i in range(200)]
    df = spark.createDataFrame(rows, "ord bigint, sid string, m int")
    best, dropped = {}, set()
    for i, s, m in rows:
        if s in best and best[s][0] >= m:
            dropped.add(i)
        else:
            best[s] = (m, i)
    for parts in (1, 7):
        shuffled = df.repartition(parts, F.rand(1))
        assert {r.ord for r in dedup.dropped_in_order(shuffled, "sid", "m", ["ord"]).where("dropped").collect()} == dropped
        assert {r.ord for r in dedup.winners(shuffled, "sid", "m", ["ord"]).where("winner").collect()} == {i for _, i in best.values()}


def test_streamed_batches_end_like_one_batch(spark, tmp_path):
    rows = [(f"s{i % 5}", i, (i * 7) % 11) for i in range(60)]
    df = spark.createDataFrame(rows, "session_id string, ord bigint, n_messages bigint")
    for k in range(3):
        df.where(F.col("ord") % 3 == k).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    longest.keep_longest(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {(r.session_id, r.ord) for r in longest.current(spark, str(tmp_path / "out")).collect()}
    assert got == {(r.session_id, r.ord) for r in dedup.winners(df, "session_id", "n_messages", ["ord"]).where("winner").collect()}


def test_stateful_stream_emits_each_new_longest(spark, tmp_path):
    rows = [(f"s{i % 3}", i, (i * 5) % 7) for i in range(30)]
    df = spark.createDataFrame(rows, "session_id string, ord bigint, n_messages bigint")
    for k in range(2):
        df.where((F.col("ord") >= 15 * k) & (F.col("ord") < 15 * k + 15)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = longest.longest_so_far(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
    q.awaitTermination()
    best, expected = {}, set()
    for s, o, n in rows:
        if n > best.get(s, -1):
            best[s] = n
            expected.add((s, o, n))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == expected
