"""Chat formatting: tool-call linking.

Calls and results meet in a hash join on (conversation, call id); calls are
put in topological order of their dependencies; arguments are validated
against the tool's schema; each linked call is one canonical JSON object
(keys sorted, no blanks, non-ASCII as is).

The unit is the call, not the conversation: a conversation with a third of
all rows is spread like any other.  Levels (the longest chain of calls below)
come from pointer jumping over the dependency edges: each round doubles the
chain that is known, so a chain of n calls takes log2(n) rounds, each written
to the shared scratch folder.  Calls that never reach a root are on, or
behind, a cycle.

Events: conv_id, turn, kind (call or result), call_id, name, payload (JSON
text of the arguments, or the result text), after (id of the call that this
one depends on, or null).

Defined results: repeated calls of one id keep the first by (turn, name,
payload), repeated results the first by (turn, payload); a call without a
result has status ``unanswered``, a result without a call stays as an
``orphan``; ``after`` naming no call of the conversation counts as none;
arguments that are no JSON object, or break the schema, get the errors'
text; NaN, Infinity and numbers beyond a double are no JSON, of keys that an
object repeats the last counts, and lone surrogates stay escaped; unknown tools get ``unknown tool``; null ids (of conversation or call)
link nothing and repeat nothing, so each such call stays, ``unanswered`` at
best, and each such result stays as an ``orphan``; empty texts are values like
others; extra columns are ignored; empty tables work.
"""

from __future__ import annotations

import json
import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablekit.session import discard, materialize

_TYPES = {
    "string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}


def schema_errors(value, schema: dict, at: str = "$") -> list[str]:
    """Where ``value`` breaks ``schema`` (JSON Schema: type, enum, const,
    properties, required, additionalProperties, items, lengths, limits)."""
    kinds = schema.get("type")
    if kinds is not None:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        if not any(isinstance(value, _TYPES[k]) and not (isinstance(value, bool) and k in ("integer", "number")) for k in kinds):
            return [f"{at}: not {' or '.join(kinds)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not one of the choices")
    if "const" in schema and value != schema["const"]:
        out.append(f"{at}: not the constant")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in sorted(schema.get("required", [])) if k not in value]
        for k in sorted(value):
            if k in known:
                out += schema_errors(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: unexpected")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += schema_errors(x, schema["items"], f"{at}[{i}]")
    if isinstance(value, str | list):
        unit = "Length" if isinstance(value, str) else "Items"
        if len(value) < schema.get(f"min{unit}", 0):
            out.append(f"{at}: too short")
        if len(value) > schema.get(f"max{unit}", len(value)):
            out.append(f"{at}: too long")
    if isinstance(value, int | float) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            out.append(f"{at}: too small")
        if value > schema.get("maximum", value):
            out.append(f"{at}: too large")
    return out


def _plain(text: str) -> str:
    """Lone surrogates, which no UTF-8 text can hold, as escapes."""
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value) -> str:
    return _plain(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def _number(text: str) -> float:
    value = float(text)
    if not math.isfinite(value):
        raise ValueError(f"{text} is too large")
    return value


def _no_json(text: str):
    raise ValueError(f"{text} is no JSON")


def parse(payload: str):
    """A JSON text; NaN, Infinity and numbers beyond a double are none."""
    return json.loads(payload, parse_constant=_no_json, parse_float=_number)


def _checked(schemas: dict[str, dict]):
    """UDF (name, payload) -> arguments as canonical JSON, and the errors."""
    @F.pandas_udf("arguments string, errors string")
    def check(names: pd.Series, payloads: pd.Series) -> pd.DataFrame:
        out = []
        for name, payload in zip(names, payloads):
            try:
                value = parse(payload) if payload is not None else None
            except (ValueError, RecursionError):
                out.append((None, "$: no JSON"))
                continue
            schema = schemas.get(name)
            errors = ["unknown tool"] if schema is None else schema_errors(value, schema)
            out.append((canonical(value), _plain("; ".join(errors)) or None))
        return pd.DataFrame(out, columns=["arguments", "errors"])

    return check


def topological_levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level): calls (conv_id, call_id, after) with the
    length of the chain of calls that must come first; -1 on or behind a cycle."""
    ids = calls.select("conv_id", "call_id")
    up = ids.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"))
    # (call, farthest known ancestor, steps to it, whether that is a root)
    cur = (calls.join(up, (F.col("conv_id") == F.col("c")) & (F.col("after") == F.col("i")), "left")
           .select("conv_id", "call_id", F.col("i").alias("up"), F.when(F.col("i").isNull(), 0).otherwise(1).cast("long").alias("level")))
    cur = materialize(cur, "levels")
    n = None
    while True:
        open_ = cur.where(F.col("up").isNotNull())
        left = open_.count()
        if left == 0:
            return cur.select("conv_id", "call_id", "level")
        # a call whose chain is not done after as many steps as there are open calls is on or behind a cycle
        if n is not None and steps > n:
            return cur.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("level")).otherwise(-1).alias("level"))
        n, steps = (left, 1) if n is None else (left, steps * 2)
        over = cur.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), F.col("up").alias("next"), F.col("level").alias("more"))
        jumped = (open_.join(over, (F.col("conv_id") == F.col("c")) & (F.col("up") == F.col("i")))
                  .select("conv_id", "call_id", F.col("next").alias("up"), (F.col("level") + F.col("more")).alias("level")))
        done, cur = cur, materialize(cur.where(F.col("up").isNull()).unionByName(jumped), "levels")
        discard(done)


def _first(rows: DataFrame, order: list[Column]) -> DataFrame:
    best = Window.partitionBy("conv_id", "call_id").orderBy(*order)
    return rows.withColumn("nth", F.row_number().over(best)).where("nth = 1").drop("nth")


def link_tool_calls(events: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call (and per orphan result): conv_id, level, turn,
    call_id, name, status, errors, json.  (level, turn, call_id) is a
    topological order of each conversation."""
    events = events.select("conv_id", "turn", "kind", "call_id", "name", "payload", "after")
    has_id = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    named = events.where(has_id)
    calls = _first(named.where("kind = 'call'"), [F.col("turn"), F.col("name"), F.col("payload")]).drop("kind")
    results = (_first(named.where("kind = 'result'"), [F.col("turn"), F.col("payload")])
               .select("conv_id", "call_id", F.col("turn").alias("r_turn"), F.col("payload").alias("result"), F.lit(True).alias("has_result")))
    levels = topological_levels(calls.select("conv_id", "call_id", "after"))
    linked = (calls.withColumn("is_call", F.lit(True)).join(results, ["conv_id", "call_id"], "full")
              .join(levels, ["conv_id", "call_id"], "left")
              .withColumn("is_call", F.coalesce("is_call", F.lit(False)))
              .withColumn("has_result", F.coalesce("has_result", F.lit(False))))
    # rows without ids meet nothing, so they pass the windows and joins by
    call = F.col("kind") == "call"
    alone = events.where(~has_id & F.col("kind").isin("call", "result")).select(
        "conv_id", "call_id", *[F.when(call, F.col(c)).alias(c) for c in ("turn", "name", "payload", "after")],
        call.alias("is_call"), F.when(~call, F.col("turn")).alias("r_turn"), F.when(~call, F.col("payload")).alias("result"),
        (~call).alias("has_result"), F.lit(None).cast("long").alias("level"))
    linked = linked.unionByName(alone)
    linked = linked.withColumn("checked", _checked(schemas)(F.col("name"), F.col("payload")))
    errors = F.when(F.col("is_call"), F.col("checked.errors"))
    status = (F.when(~F.col("is_call"), "orphan").when(F.col("level") == -1, "cycle").when(errors.isNotNull(), "invalid")
              .when(~F.col("has_result"), "unanswered").otherwise("ok"))
    return _written(linked.withColumn("errors", errors).withColumn("status", status))


def _written(linked: DataFrame) -> DataFrame:
    @F.pandas_udf("string")
    def write(call: pd.Series, name: pd.Series, arguments: pd.Series, result: pd.Series, status: pd.Series, after: pd.Series) -> pd.Series:
        clean = lambda x: None if x is None or x != x else x
        rows = [canonical({"id": clean(c), "name": clean(n), "arguments": json.loads(a) if a else None, "result": clean(r),
                           "status": s, "after": clean(d)}) for c, n, a, r, s, d in zip(call, name, arguments, result, status, after)]
        return pd.Series(rows, dtype=object)

    body = write("call_id", "name", F.col("checked.arguments"), "result", "status", "after")
    return linked.select("conv_id", F.coalesce("level", F.lit(0)).cast("long").alias("level"), F.coalesce("turn", "r_turn").alias("turn"),
                         "call_id", "name", "status", "errors", body.alias("json"))


def events_from_chat(chat: DataFrame) -> DataFrame:
    """Tool events of a plain chat (conv_id, turn, role, text): a user turn is
    a call of the tool ``reply`` with the whole text as its argument, the
    assistant turn after it is that call's result, and each call comes after
    the call two turns before.  System turns set no call."""
    ident = lambda t: F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), t.cast("string"))
    turn = F.col("turn")
    asked = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("text"), F.length(F.coalesce("text", F.lit(""))).alias("n_chars")))
    user = F.col("role") == "user"
    return chat.where(F.col("role").isin("user", "assistant")).select(
        "conv_id", "turn", F.when(user, "call").otherwise("result").alias("kind"),
        F.when(F.col("conv_id").isNotNull() & turn.isNotNull(), ident(F.when(user, turn).otherwise(turn - 1))).alias("call_id"),
        F.when(user, "reply").alias("name"), F.when(user, asked).otherwise(F.coalesce("text", F.lit(""))).alias("payload"),
        F.when(user & (turn >= 2), ident(turn - 2)).alias("after"))


# The schema of the tool that plain chats call.
REPLY_SCHEMA = {
    "reply": {
        "type": "object",
        "properties": {"text": {"type": "string", "minLength": 1}, "n_chars": {"type": "integer", "minimum": 1}},
        "required": ["text", "n_chars"],
        "additionalProperties": False,
    },
}
