"""Delivery records to test with."""

import json

TOOLS = [{"type": "function", "name": "shell", "description": "run", "parameters": {"type": "object"}}, {"type": "function", "name": "read", "description": "read", "parameters": {}}]
INPUT = [
    {"type": "message", "role": "developer", "content": [{"type": "input_text", "text": "You are a coder. <cwd> /src/app </cwd>"}]},
    {"type": "message", "role": "user", "content": [{"type": "input_text", "text": "Fix the test"}]},
    {"type": "function_call", "name": "shell", "arguments": "{}", "call_id": "c1"},
    {"type": "function_call_output", "call_id": "c1", "output": "ok"},
    {"type": "message", "role": "assistant", "content": [{"type": "output_text", "text": "Looking"}]},
    {"type": "message", "role": "user", "content": [{"type": "input_text", "text": "Go on"}]},
]


def answer(output=None, status="completed"):
    output = output or [{"type": "message", "role": "assistant", "content": [{"type": "output_text", "text": "Done"}]}]
    return json.dumps({"object": "response", "status": status, "model": "gpt-5.5", "output": output})


def envelope(request_id="client:pass-1", inp=None, response=None, tools=None, instructions="Be brief", model="gpt-5.5", **more):
    request = {"model": model, "instructions": instructions, "tools": TOOLS if tools is None else tools, "input": INPUT if inp is None else inp}
    return {"request": json.dumps(request), "response": response or answer(), "request_id": request_id, "trajectory_state": "root", "input": 10, "output": 5, **more}


def write_lines(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))
