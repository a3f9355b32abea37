"""Chat formatting: tool calls linked to results, ordered, validated and serialised.

A call is a message with an identifier, a tool's name and arguments; a result
names the call it answers; a call may name one earlier call whose result it
needs (`after`). Results are hash-joined to calls by conversation and
identifier, after calls are reduced to one row per identifier, so repeated
identifiers never multiply. Calls are ordered topologically by the length of
their chain of needs, found by doubling pointers: a chain of a thousand calls
takes ten joins, and a conversation that fills a third of the table is spread
over tasks like any other. Arguments are checked against the tool's schema and
messages are written as canonical JSON (keys sorted, no white space, no escapes
that are not needed).

Defined cases: of calls with one identifier that with the smallest turn, then
text, need, tool and arguments, is the call, the others are marked `repeated`
(calls alike in all of these are not told apart: none of them is marked); a result without a call
is `orphan`; a need that no call meets counts as none but is an error; calls
that need each other in a circle get level -1. A message without conversation,
turn or identifier links with nothing. Null texts are JSON nulls. Arguments that
are no JSON, say NaN, repeat a name, hold half a character, a number beyond range
or nesting over `DEEPEST`, are an error of their row and null in its record.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import saved

KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}


def errors_in(value: Any, schema: dict, at: str = "") -> list[str]:
    """Where a value breaks a schema: type, enum, required, properties, lengths, bounds, items."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    fits = lambda k: k in KINDS and isinstance(value, KINDS[k]) and not (isinstance(value, bool) and k in ("integer", "number"))
    if kinds and not any(map(fits, kinds)):
        return [f"{at or '.'}: not {' or '.join(kinds)}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at or '.'}: not allowed")
    if isinstance(value, str):
        if not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
            found.append(f"{at or '.'}: length")
    elif isinstance(value, (int, float)) and not isinstance(value, bool):
        if not schema.get("minimum", value) <= value <= schema.get("maximum", value):
            found.append(f"{at or '.'}: out of bounds")
    elif isinstance(value, list):
        for i, item in enumerate(value):
            found += errors_in(item, schema.get("items", {}), f"{at}[{i}]")
    elif isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{name}: missing" for name in schema.get("required", []) if name not in value]
        for name in sorted(value):
            if name in known:
                found += errors_in(value[name], known[name], f"{at}.{name}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{name}: unknown")
    return found


#: Arguments nested deeper are an error of their row.
DEEPEST = 100


def canonical(value: Any) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False, default=str)


def _once(pairs: list[tuple[str, Any]]) -> dict:
    found = dict(pairs)
    if len(found) < len(pairs):
        raise ValueError("a name stands twice in one object")
    return found


def _no_number(text: str) -> Any:
    raise ValueError(f"{text} is no JSON")


def _real(text: str) -> float:
    value = float(text)
    if value in (float("inf"), float("-inf")):
        raise ValueError("a number is too large")
    return value


def parsed(text: str) -> Any:
    """JSON that can be written again: ValueError for what is no JSON, for names
    that stand twice, numbers out of range, characters that no UTF-8 has, and
    nesting over `DEEPEST`.
    """
    depth = deepest = 0
    # An upper bound of the nesting, brackets in texts among them, before any recursion.
    for sign in text:
        depth += (sign in "[{") - (sign in "]}")
        deepest = max(deepest, depth)
    if deepest > DEEPEST:
        raise ValueError("nested too deep")
    value = json.loads(text, object_pairs_hook=_once, parse_constant=_no_number, parse_float=_real)
    try:
        canonical(value).encode()
    except UnicodeEncodeError as fault:
        raise ValueError("half a character") from fault
    return value


def levels(calls: DataFrame) -> DataFrame:
    """conv, call_id, level: how many calls must come before (0: none), -1 in or behind a circle.

    `calls` (conv, call_id, after) has one row per identifier; `after` null: no need.
    """
    now = saved(calls.select("conv", "call_id", F.col("after").alias("to"), F.when(F.col("after").isNull(), 0).otherwise(1).alias("steps")), "needs")
    rounds, longest = 0, max(1, now.count())
    while not now.where("to IS NOT NULL").isEmpty() and (1 << rounds) <= 2 * longest:
        ahead = now.select("conv", F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("steps").alias("more"))
        moved = now.where("to IS NOT NULL").join(ahead, ["conv", "to"], "left")
        moved = moved.select("conv", "call_id", F.col("next").alias("to"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"))
        now = saved(moved.unionByName(now.where("to IS NULL")), "needs")
        rounds += 1
    return now.select("conv", "call_id", F.when(F.col("to").isNull(), F.col("steps")).otherwise(-1).cast("long").alias("level"))


def format_chats(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per message: conv, turn, role, call_id, linked, repeated, level, n_errors, errors, json.

    `messages` has conv, turn, role, text and, null where they do not apply,
    call_id and tool (a call), arguments (JSON text), after (a call it needs) and
    answers (the call a result belongs to). `schemas`: of each tool's arguments.
    """
    rows = messages.select(
        "conv", F.col("turn").cast("long").alias("turn"), "role", "text", F.col("call_id").cast("string").alias("call_id"),
        "tool", "arguments", F.col("after").cast("string").alias("after"), F.col("answers").cast("string").alias("answers"),
    )
    calls = rows.where("call_id IS NOT NULL AND conv IS NOT NULL")
    single = saved(
        calls.groupBy("conv", "call_id").agg(
            F.min(F.struct("turn", "text", "after", "tool", "arguments")).alias("one"), F.count(F.lit(1)).alias("n"),
        ).select("conv", "call_id", "one.turn", "one.text", "one.tool", "one.arguments", "one.after", "n"),
        "calls",
    )
    there = single.select("conv", F.col("call_id").alias("after"))
    needs = single.where("after IS NOT NULL").join(there, ["conv", "after"], "left_semi").select("conv", "call_id", "after")
    ordered = levels(
        single.select("conv", "call_id").join(needs, ["conv", "call_id"], "left").select("conv", "call_id", "after")
    )
    facts = saved(
        single.join(ordered, ["conv", "call_id"]).join(needs.select("conv", "call_id", F.lit(True).alias("met")), ["conv", "call_id"], "left")
        .select(
            "conv", F.col("call_id").alias("key"), "level", F.col("turn").alias("call_turn"), F.col("text").alias("call_text"),
            F.col("tool").alias("call_tool"), F.when(F.col("n") > 1, F.col("after")).alias("call_after"),
            F.when(F.col("n") > 1, F.col("arguments")).alias("call_arguments"), (F.col("n") > 1).alias("several"),
            (F.col("after").isNotNull() & F.col("met").isNull()).alias("unmet"),
        ),
        "call-facts",
    )
    answered = saved(
        rows.where("answers IS NOT NULL AND conv IS NOT NULL").select("conv", F.col("answers").alias("key")).distinct().withColumn("answered", F.lit(True)),
        "answered",
    )
    facts = facts.join(answered, ["conv", "key"], "left")
    keyed = rows.withColumn("key", F.coalesce("call_id", "answers"))
    linkable = F.col("key").isNotNull() & F.col("conv").isNotNull()
    joined = keyed.where(linkable).join(saved(facts, "linked-calls"), ["conv", "key"], "left")
    plain = keyed.where(~linkable)
    for name, kind in joined.dtypes:
        if name not in plain.columns:
            plain = plain.withColumn(name, F.lit(None).cast(kind))
    whole = joined.unionByName(plain.select(*joined.columns))
    out = pa.schema(
        [
            ("turn", pa.int64()), ("role", pa.string()), ("call_id", pa.string()), ("linked", pa.bool_()), ("repeated", pa.bool_()),
            ("level", pa.int64()), ("n_errors", pa.int64()), ("errors", pa.list_(pa.string())), ("json", pa.string()),
        ]
    )
    conv_kind = dict(whole.dtypes)["conv"]

    def each(r: dict) -> tuple:
        call, found, repeated = r["call_id"], [], False
        record: dict[str, Any] = {"conversation": r["conv"], "turn": r["turn"], "role": r["role"]}
        if call is not None:
            repeated = bool(r["several"]) and any(r[c] != r[f"call_{c}"] for c in ("turn", "text", "after", "tool", "arguments"))
            try:
                arguments = parsed(r["arguments"]) if r["arguments"] is not None else {}
            except ValueError:
                arguments, found = None, [".: not JSON"]
            if r["tool"] not in schemas:
                found.append("tool: unknown")
            elif not found:
                found = errors_in(arguments, schemas[r["tool"]])
            if r["unmet"]:
                found.append("after: no such call")
            if r["level"] == -1:
                found.append("after: circle")
            record["call"] = {"id": call, "name": r["tool"], "arguments": arguments, "level": r["level"]}
            linked = bool(r["answered"])
        elif r["answers"] is not None:
            linked = r["level"] is not None
            record |= {"answers": r["answers"], "content": r["text"]}
            if not linked:
                found.append("answers: no such call")
        else:
            linked = False
            record["content"] = r["text"]
        return r["turn"], r["role"], r["key"], linked, repeated, r["level"], len(found), found, canonical(record)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [each(r) for r in batch.to_pylist()]
            columns = list(zip(*made, strict=True)) or [[]] * len(out)
            arrays = [batch.column("conv"), *(pa.array(c, t) for c, t in zip(columns, out.types, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=["conv", *out.names])

    ddl = (
        f"conv {conv_kind}, turn long, role string, call_id string, linked boolean, repeated boolean, level long, "
        "n_errors long, errors array<string>, json string"
    )
    return whole.mapInArrow(over, ddl)


def exchange_calls(conversations: DataFrame, shortest: int = 20) -> DataFrame:
    """Chat turns as tool traffic: a user's turn calls `reply`, the assistant's next turn answers it.

    The call is named after its turn, needs the user's turn two before it where
    that is one, and passes the question; a question under `shortest` characters
    breaks the schema of `reply`.
    """
    turn = F.col("turn").cast("long")
    name = lambda at: F.concat(F.lit("t"), at.cast("string"))
    asks, says = F.col("role") == "user", F.col("role") == "assistant"
    arguments = F.to_json(F.struct(F.col("text").alias("question"), turn.alias("turn")), {"ignoreNullFields": "false"})
    return conversations.select(
        F.col("conv_id").alias("conv"), turn.alias("turn"), "role", "text",
        F.when(asks, name(turn)).alias("call_id"), F.when(asks, F.lit("reply")).alias("tool"), F.when(asks, arguments).alias("arguments"),
        F.when(asks & (turn >= 2), name(turn - 2)).alias("after"), F.when(says, name(turn - 1)).alias("answers"),
    )


def reply_schema(shortest: int = 20) -> dict[str, dict]:
    question = {"type": "string", "minLength": shortest}
    return {
        "reply": {
            "type": "object", "required": ["question", "turn"], "additionalProperties": False,
            "properties": {"question": question, "turn": {"type": "integer", "minimum": 0}},
        }
    }
