"""Tool-call linking against a plain walk of each conversation."""

import json
import random
from collections import Counter

from tablekit.llm import tool_calls as T

SCHEMA = "conv_id long, turn long, kind string, call_id string, name string, payload string, after string, level int"
TOOLS = {"f": {"type": "object", "properties": {"x": {"type": "integer", "minimum": 0}, "s": {"type": "string", "maxLength": 5},
                                                "l": {"type": "array", "items": {"enum": ["a", "b"]}}}, "required": ["x"],
               "additionalProperties": False}}


def brute(events):
    calls, results = {}, {}
    for c, t, kind, i, n, p, a, _ in events:
        key = (c, i)
        if kind == "call":
            calls[key] = min(calls.get(key, (t, n, p, a)), (t, n, p, a), key=lambda v: (v[0], v[1] or "", v[2] or ""))
        elif kind == "result":
            results[key] = min(results.get(key, (t, p)), (t, p))
    out = {}
    for key, (t, n, p, a) in calls.items():
        seen, level, cur = set(), 0, key
        while True:
            up = (cur[0], calls[cur][3])
            if up[1] is None or up not in calls:
                break
            if up in seen:
                level = -1
                break
            seen.add(up)
            cur, level = up, level + 1
        try:
            value = json.loads(p) if p is not None else None
            errors = "unknown tool" if n not in TOOLS else "; ".join(T.schema_errors(value, TOOLS[n])) or None
        except ValueError:
            value, errors = None, "$: no JSON"
        status = "cycle" if level < 0 else "invalid" if errors else "ok" if key in results else "unanswered"
        body = {"id": key[1], "name": n, "arguments": value, "result": results.get(key, (0, None))[1], "status": status, "after": a}
        out[key] = (level, t, status, errors, T.canonical(body))
    for key, (t, p) in results.items():
        if key not in calls:
            out[key] = (0, t, "orphan", None, T.canonical({"id": key[1], "name": None, "arguments": None, "result": p, "status": "orphan", "after": None}))
    return out


def events():
    rnd = random.Random(4)
    out = []
    payloads = ['{"x": 1}', '{"s":"é", "x":0}', '{"x":-1}', '{"x":"1"}', "[1", '{"l":["a","z"],"x":2}', '{"y":1}', None, "3", '{"x":true}', '{"s":"toolong","x":1}']
    for c in range(30):
        for k in range(rnd.randint(1, 12)):
            after = f"c{rnd.randrange(k)}" if k and rnd.random() < 0.8 else None
            out.append((c, 2 * k, "call", f"c{k}", rnd.choice(["f", "f", "g"]), rnd.choice(payloads), after, 9))
            if rnd.random() < 0.8:
                out.append((c, 2 * k + 1, "result", f"c{k}", None, f"r{k} \"q\" é", None, 9))
    # a chain, a cycle, a tail behind it, a call after itself, orphans, repeats, an unknown parent
    out += [(99, k, "call", f"k{k}", "f", '{"x":1}', f"k{k - 1}" if k else None, 0) for k in range(40)]
    out += [(98, 1, "call", "a", "f", '{"x":1}', "b", 0), (98, 2, "call", "b", "f", '{"x":1}', "a", 0), (98, 3, "call", "d", "f", '{"x":1}', "b", 0),
            (98, 4, "call", "e", "f", '{"x":1}', "e", 0), (97, 1, "result", "zz", None, "", None, 0), (97, 5, "call", "q", "f", '{"x":1}', "none", 0)]
    return out + out[:5] + [(0, 50, "call", "c0", "f", '{"x":7}', None, 0), (0, 51, "system", None, None, None, None, 0)]


def test_equals_a_plain_walk(spark):
    rows = events()
    got = T.link_tool_calls(spark.createDataFrame(rows, SCHEMA), TOOLS).collect()
    assert {(r["conv_id"], r["call_id"]): (r["level"], r["turn"], r["status"], r["errors"], r["json"]) for r in got} == brute(rows)
    assert len(got) == len(brute(rows))


def test_levels_order_topologically(spark):
    got = T.link_tool_calls(spark.createDataFrame(events(), SCHEMA), TOOLS).collect()
    level = {(r["conv_id"], r["call_id"]): r["level"] for r in got}
    for r in got:
        up = json.loads(r["json"])["after"]
        if r["level"] > 0:
            assert level[r["conv_id"], up] < r["level"]


def test_plain_chat_and_edges(spark):
    chat = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "Hi é"), (1, 2, "assistant", "yo"), (1, 3, "user", ""), (2, 0, "user", None),
                                  (None, 0, "user", "x"), (3, 5, "assistant", "alone"), (1, 1, "user", "Hi é")], "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): r for r in T.link_tool_calls(T.events_from_chat(chat), T.REPLY_SCHEMA).collect()}
    assert json.loads(got[1, 1]["json"]) == {"after": None, "arguments": {"n_chars": 4, "text": "Hi é"}, "id": "call-1-1", "name": "reply",
                                             "result": "yo", "status": "ok"}
    assert got[1, 3]["status"] == "invalid" and got[1, 3]["level"] == 1 and got[3, 5]["status"] == "orphan"
    assert got[2, 0]["status"] == "invalid" and got[None, 0]["status"] == "unanswered"
    empty = T.events_from_chat(chat.limit(0))
    assert T.link_tool_calls(empty, T.REPLY_SCHEMA).count() == 0


def test_rows_without_ids_all_stay(spark):
    rows = [(None, 2 * k, "call", f"c{k % 2}", "f", '{"x":1}', None, 0) for k in range(5)]
    rows += [(None, None, "result", None, None, f"r{k}", None, 0) for k in range(4)]
    rows += [(7, None, "call", None, "f", '{"x":-1}', "c0", 0)] * 3 + [(7, None, "result", None, None, "same", None, 0)] * 2
    rows += [(7, 0, "call", "c0", "f", '{"x":1}', None, 0), (7, None, "result", "c0", None, "late", None, 0), (8, None, "call", "c", None, None, None, 0)]
    got = T.link_tool_calls(spark.createDataFrame(rows, SCHEMA), TOOLS).collect()
    assert Counter((r["conv_id"], r["call_id"], r["status"]) for r in got) == {
        (None, "c0", "unanswered"): 3, (None, "c1", "unanswered"): 2, (None, None, "orphan"): 4,
        (7, None, "invalid"): 3, (7, None, "orphan"): 2, (7, "c0", "ok"): 1, (8, "c", "invalid"): 1}
    assert sorted(r["turn"] for r in got if r["conv_id"] is None and r["call_id"]) == [0, 2, 4, 6, 8]
    assert sorted(json.loads(r["json"])["result"] for r in got if r["status"] == "orphan") == ["r0", "r1", "r2", "r3", "same", "same"]
    chat = spark.createDataFrame([(None, k, "user" if k % 2 else "assistant", f"t{k}") for k in range(6)] + [(1, None, "user", "a"), (1, None, "user", "b")],
                                 "conv_id long, turn long, role string, text string")
    linked = T.link_tool_calls(T.events_from_chat(chat), T.REPLY_SCHEMA)
    assert Counter((r["conv_id"], r["status"]) for r in linked.collect()) == {(None, "unanswered"): 3, (None, "orphan"): 3, (1, "unanswered"): 2}


def test_texts_that_are_no_json_and_lone_surrogates(spark):
    import json
    payloads = ['{"x": NaN}', '{"x": 1e999}', '{"x": -Infinity}', '{"x": "\\ud800"}', '{"\\udfff": 1}', '{"x": 1, "x": 2}', '{"x": "\\ud83d\\ude00"}']
    rows = [("c", i, "call", f"id{i}", "t", p, None) for i, p in enumerate(payloads)]
    frame = spark.createDataFrame(rows, "conv_id string, turn int, kind string, call_id string, name string, payload string, after string")
    got = {r["turn"]: r for r in T.link_tool_calls(frame, {"t": {"type": "object", "additionalProperties": False, "properties": {"x": {}}}}).collect()}
    assert [got[i]["errors"] for i in range(3)] == ["$: no JSON"] * 3
    assert json.loads(got[3]["json"])["arguments"] == {"x": "\ud800"} and got[3]["errors"] is None
    assert "\\udfff" in got[4]["errors"] and got[4]["status"] == "invalid"
    assert json.loads(got[5]["json"])["arguments"] == {"x": 2}
    assert "\U0001f600" in got[6]["json"]
