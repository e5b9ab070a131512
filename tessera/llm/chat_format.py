"""Chat formatting: tool-call linking.

Calls in assistant messages and results in tool messages are hash-joined by conversation and
identifier, put in topological order (a result after its call, a call after the results it
refers to), validated against the tools' schemas, and serialised as canonical JSON, one line
per message.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored

#: The tools of turns_as_calls(): a turn as a call of one tool.
TURN_TOOLS = {
    "reply": {
        "type": "object",
        "properties": {"turn": {"type": "integer", "minimum": 0}, "prompt": {"type": "string", "minLength": 1}, "after": {"type": "object"}},
        "required": ["turn", "prompt"],
        "additionalProperties": False,
    }
}


_LONE = re.compile("[\ud800-\udfff]")


def _quoted(text: str) -> str:
    """A JSON string; half of a surrogate pair, which no encoding holds, stays an escape."""
    return _LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", json.dumps(text, ensure_ascii=False))


def _whole(text: str | None) -> str | None:
    """Text for a column: half of a surrogate pair becomes U+FFFD."""
    return None if text is None else _LONE.sub("\ufffd", text)


def _number(x: float) -> str:
    """The shortest digits that give x: plain from 1e-6 up to below 1e21, else with an exponent."""
    if not math.isfinite(x):
        raise ValueError("not a JSON number")
    if x == 0:
        return "0"
    sign, digits, exponent = ("-" if x < 0 else ""), *f"{abs(x)!r}e0".split("e")[:2]
    whole, _, rest = digits.partition(".")
    rest = "" if rest == "0" else rest
    point = len(whole) + int(exponent)
    digits = whole + rest
    point -= len(digits) - len(digits.lstrip("0"))
    digits = digits.strip("0")
    if len(digits) <= point <= 21:
        return sign + digits + "0" * (point - len(digits))
    if 0 < point <= 21:
        return f"{sign}{digits[:point]}.{digits[point:]}"
    if -6 < point <= 0:
        return f"{sign}0.{'0' * -point}{digits}"
    mantissa = digits[0] + (f".{digits[1:]}" if digits[1:] else "")
    return f"{sign}{mantissa}e{'+' if point > 0 else '-'}{abs(point - 1)}"


def canonical(value: Any) -> str:
    """JSON without spaces, keys sorted by UTF-16 units; equal numbers are written alike:
    integers in full, others by _number().
    """
    if isinstance(value, dict):
        order = sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{_quoted(k)}:{canonical(value[k])}" for k in order) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, str):
        return _quoted(value)
    if isinstance(value, float):
        return _number(value)
    return json.dumps(value)


_TYPES = {
    "object": lambda x: isinstance(x, dict),
    "array": lambda x: isinstance(x, list),
    "string": lambda x: isinstance(x, str),
    "integer": lambda x: isinstance(x, int) and not isinstance(x, bool) or isinstance(x, float) and x.is_integer(),
    "number": lambda x: isinstance(x, (int, float)) and not isinstance(x, bool),
    "boolean": lambda x: isinstance(x, bool),
    "null": lambda x: x is None,
}


def schema_errors(value: Any, schema: dict, at: str = "$") -> list[str]:
    """What in value does not fit the JSON schema (type, enum, const, bounds, lengths,
    required, properties, additionalProperties, items), in a fixed order.
    """
    out = []
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds or []
    if kinds and not any(_TYPES[k](value) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in enum")
    if "const" in schema and value != schema["const"]:
        out.append(f"{at}: not the constant")
    if _TYPES["number"](value):
        out += [f"{at}: {word}" for key, word, wrong in (("minimum", "too small", lambda a, b: a < b), ("maximum", "too large", lambda a, b: a > b)) if key in schema and wrong(value, schema[key])]
    if isinstance(value, (str, list)):
        unit = "Length" if isinstance(value, str) else "Items"
        if len(value) < schema.get(f"min{unit}", 0):
            out.append(f"{at}: too short")
        if len(value) > schema.get(f"max{unit}", math.inf):
            out.append(f"{at}: too long")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in sorted(schema.get("required", [])) if k not in value]
        for k in sorted(value):
            if k in known:
                out += schema_errors(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and isinstance(schema.get("items"), dict):
        for i, x in enumerate(value):
            out += schema_errors(x, schema["items"], f"{at}[{i}]")
    return out


def references(value: Any) -> list[str]:
    """Identifiers of calls whose results the arguments refer to: {"$result": id} anywhere."""
    found: list[str] = []
    todo = [value]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            if set(x) == {"$result"} and isinstance(x["$result"], str):
                found.append(x["$result"])
            else:
                todo += x.values()
        elif isinstance(x, list):
            todo += x
    return sorted(set(found))


EVENT_SCHEMA = (
    "conv_id long, turn long, part int, role string, kind string, call_id string, name string, "
    "body string, refs array<string>, errors array<string>"
)


def _parse(role: str | None, text: str | None, tools: dict) -> Iterator[tuple]:
    """(kind, call_id, name, body, refs, errors) of a message's events."""
    try:
        data = json.loads(text) if text and text.lstrip()[:1] == "{" else None
    except (ValueError, RecursionError):
        data = None
    if role == "assistant" and isinstance(data, dict) and isinstance(data.get("tool_calls"), list):
        if isinstance(data.get("content"), str):
            yield "text", None, None, canonical(data["content"]), [], []
        for call in data["tool_calls"]:
            call = call if isinstance(call, dict) else {}
            name, args = call.get("name"), call.get("arguments")
            try:
                args = json.loads(args) if isinstance(args, str) else args
                body, errors = canonical(args), []
            except (ValueError, RecursionError):
                args, body, errors = None, "null", ["$: not JSON"]
            if not errors:
                errors = schema_errors(args, tools[name]) if isinstance(name, str) and name in tools else ["unknown tool"]
            ident = call.get("id")
            if not isinstance(ident, str):
                ident, errors = None, ["no id", *errors]
            yield "call", _whole(ident), _whole(name) if isinstance(name, str) else None, body, [_whole(x) for x in references(args)], [_whole(x) for x in errors]
    elif role == "tool" and isinstance(data, dict) and isinstance(data.get("tool_call_id"), str):
        try:
            body = canonical(data.get("content"))
        except (ValueError, RecursionError):
            body = "null"
        yield "result", _whole(data["tool_call_id"]), None, body, [], []
    else:
        yield "text", None, None, canonical(text), [], []


def events(messages: DataFrame, tools: dict) -> DataFrame:
    """EVENT_SCHEMA rows: each message's text, calls and results.  No shuffle."""
    names = [c.split()[0] for c in EVENT_SCHEMA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv, turn, role, text in zip(batch["conv_id"].astype("Int64"), batch["turn"].astype("Int64"), batch["role"], batch["text"], strict=True):
                for part, event in enumerate(_parse(role, text, tools)):
                    out.append((conv, turn, part, role, *event))
            frame = pd.DataFrame(out, columns=names)
            yield frame.astype({"conv_id": "Int64", "turn": "Int64", "part": "int32"})

    slim = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return slim.mapInPandas(run, EVENT_SCHEMA)


def turns_as_calls(conversations: DataFrame) -> DataFrame:
    """Messages in which each user turn is asked of the tool reply, and the assistant's next
    turn is its result: how a plain conversation becomes a tool-use one.

    A call's identifier is c<conv>-<turn>.  Logs of tool use are not always in order, so of
    sixteen numbers that follow from conversation and turn six stand for a flaw.  Calls: 1 an
    argument out of its bounds, 3 a reference to the result of the next exchange, 5 the
    identifier of the exchange before, 7 a reference to its own result.  Results: 2 an
    identifier of no call, 4 a place before the call.  System turns stay as they are, a null
    turn or conversation too.
    """
    ident = lambda back: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") + F.lit(back)).cast("string"))
    flaw = F.pmod(31 * F.col("conv_id") + 7 * F.col("turn"), F.lit(16))
    after = F.when(flaw == 3, ident(2)).when(flaw == 7, ident(0))
    # to_json leaves null fields out
    arguments = F.struct(
        F.when(flaw == 1, F.lit(-1)).otherwise(F.col("turn")).alias("turn"),
        F.coalesce("text", F.lit("")).alias("prompt"),
        F.when(after.isNotNull(), F.struct(after.alias("$result"))).alias("after"),
    )
    call = F.to_json(F.struct(F.array(F.struct(F.when(flaw == 5, ident(-2)).otherwise(ident(0)).alias("id"), F.lit("reply").alias("name"), arguments.alias("arguments"))).alias("tool_calls")))
    nobody = F.concat(F.lit("x"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    result = F.to_json(F.struct(F.when(flaw == 2, nobody).otherwise(ident(-1)).alias("tool_call_id"), F.coalesce("text", F.lit("")).alias("content")))
    whole = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    asks, answers = whole & (F.col("role") == "user"), whole & (F.col("role") == "assistant")
    return conversations.select(
        "conv_id",
        F.when(answers & (flaw == 4), F.col("turn") - 2).otherwise(F.col("turn")).alias("turn"),
        F.when(asks, "assistant").when(answers, "tool").otherwise(F.col("role")).alias("role"),
        F.when(asks, call).when(answers, result).otherwise(F.col("text")).alias("text"),
    )


def _order(linked: DataFrame, edges: DataFrame) -> DataFrame | None:
    """(row, at: struct(t, d), cyclic) of the events of conversations in which one stands
    before what it depends on; None if there are none.

    linked: (row, conv_id, turn, part); edges: (conv_id, before row, after row).  An event's
    place is its own turn and part, or behind the latest place of those it depends on,
    directly or not: the greatest of (turn, part + number of steps) over all paths to it.
    Paths are doubled, so a chain of n events takes log2(n) rounds; a round holds, for each
    event, those it depends on over 2 ** k steps.  A path of as many steps as there are
    events goes round a cycle: what such a path leads to has no order and stays in its place.
    """
    own = linked.select("row", "conv_id", F.struct(F.col("turn").alias("t"), F.col("part").alias("d")).alias("at"))
    a, b = own.select(F.col("row").alias("before"), F.col("at").alias("x")), own.select(F.col("row").alias("after"), F.col("at").alias("y"))
    late = stored(edges.join(a, "before").join(b, "after").where("x >= y").select("conv_id").distinct(), small=True)
    if late.isEmpty():
        return None
    steps, jumps = 1, stored(edges.join(late, "conv_id", "left_semi").select("before", "after").distinct())
    keys = stored(own.join(late, "conv_id", "left_semi"))
    most = keys.groupBy("conv_id").count().agg(F.max("count")).first()[0]
    keys = keys.select("row", "at", F.col("at").alias("own"))
    while not jumps.isEmpty() and steps < 2 * most:
        far = jumps.join(keys.select(F.col("row").alias("before"), "at"), "before")
        far = far.groupBy(F.col("after").alias("row")).agg(F.max(F.struct(F.col("at.t").alias("t"), (F.col("at.d") + steps).cast("int").alias("d"))).alias("to"))
        keys = stored(keys.join(far, "row", "left").select("row", F.greatest("at", "to").alias("at"), "own"))
        jumps = stored(jumps.alias("p").join(jumps.alias("q"), F.col("p.after") == F.col("q.before")).select("p.before", "q.after").distinct())
        steps *= 2
    stuck = jumps.select(F.col("after").alias("row")).distinct().withColumn("stuck", F.lit(True))
    out = keys.join(stuck, "row", "left").withColumn("cyclic", F.coalesce("stuck", F.lit(False)))
    return out.select("row", F.when(F.col("cyclic"), F.col("own")).otherwise(F.col("at")).alias("at"), "cyclic")


def format_chat(messages: DataFrame, tools: dict | None = None) -> DataFrame:
    """(conv_id, order_turn, order_depth, turn, part, kind, call_id, status, json), a row per
    text, call and result; sorted by the first five columns a conversation is in
    topological order.  Rows, not conversations, are the unit of work, so a conversation of
    any length is spread.

    messages: (conv_id, turn, role, text).  An assistant text of the form
    {"tool_calls": [{"id", "name", "arguments"}], "content"} holds calls, a tool text of the
    form {"tool_call_id", "content"} a result; any other text is a text.  Status of a call:
    duplicate (an identifier that an earlier call of the conversation has), cyclic (it waits
    for itself), invalid (arguments do not fit the tool's schema, or unknown tool), unanswered
    or ok; of a result: orphan (no such call), duplicate (not the first for its call), cyclic
    or ok.

    Null text is JSON null, a null role is kept, a null turn sorts first and a null
    conv_id is a conversation whose calls and results are not linked.  Of repeated messages
    one is the first and the others are duplicates.  Ties within a turn go by part, then by
    a hash.  Half of a surrogate pair stays an escape in JSON and is U+FFFD in identifiers.  No
    rows give no rows; other columns are not read.
    """
    tools = TURN_TOOLS if tools is None else tools
    salt = F.xxhash64("conv_id", "turn", "part", "role", "call_id", "body")
    rows = stored(events(messages, tools).withColumns({"salt": salt, "row": F.monotonically_increasing_id()}))
    place = F.struct("turn", "part", "salt", "row")
    linked = rows.where("call_id is not null and conv_id is not null")
    ends = linked.groupBy("conv_id", "call_id").agg(
        F.min(F.when(F.col("kind") == "call", place)).alias("call"),
        F.min(F.when(F.col("kind") == "result", place)).alias("result"),
    )
    ends = stored(ends.select("conv_id", "call_id", F.col("call.row").alias("call_row"), F.col("result.row").alias("result_row")))
    answered = ends.where("call_row is not null and result_row is not null")
    refs = linked.where("kind = 'call' and size(refs) > 0").select("conv_id", F.col("row").alias("after"), F.explode("refs").alias("call_id"))
    # identifiers are hashed; their table has a row for each, so it is the side that is built
    edges = answered.select("conv_id", F.col("call_row").alias("before"), F.col("result_row").alias("after")).union(
        refs.join(answered.hint("shuffle_hash"), ["conv_id", "call_id"]).select("conv_id", F.col("result_row").alias("before"), "after")
    )
    moved = _order(linked.select("row", "conv_id", "turn", "part"), edges)
    texts = rows.where("call_id is null or conv_id is null").withColumns({"call_row": F.lit(None).cast("long"), "result_row": F.lit(None).cast("long")})
    out = texts.unionByName(linked.join(ends.hint("shuffle_hash"), ["conv_id", "call_id"], "left"))
    if moved is None:
        out = out.withColumns({"order_turn": F.col("turn"), "order_depth": F.col("part"), "cyclic": F.lit(False)})
    else:
        out = out.join(moved, "row", "left")
        own = F.struct(F.col("turn").alias("t"), F.col("part").alias("d"))
        out = out.withColumns({"at": F.coalesce("at", own), "cyclic": F.coalesce("cyclic", F.lit(False))})
        out = out.withColumns({"order_turn": F.col("at.t"), "order_depth": F.col("at.d")})
    first = F.coalesce(F.col("row") == F.when(F.col("kind") == "call", F.col("call_row")).otherwise(F.col("result_row")), F.lit(False))
    status = (
        F.when(F.col("kind") == "text", "ok")
        .when((F.col("kind") == "result") & F.col("call_row").isNull(), "orphan")
        .when(F.col("call_id").isNotNull() & F.col("conv_id").isNotNull() & ~first, "duplicate")
        .when(F.col("cyclic"), "cyclic")
        .when(F.size("errors") > 0, "invalid")
        .when((F.col("kind") == "call") & F.col("result_row").isNull(), "unanswered")
        .otherwise("ok")
    )
    out = out.withColumn("status", status)
    text = lambda c: F.coalesce(F.regexp_extract(F.to_json(F.struct(F.col(c).alias("x"))), r'(?s)^\{"x":(.*)\}$', 1), F.lit("null"))
    quoted = lambda c: F.when(F.col(c).isNull(), F.lit("null")).otherwise(text(c))
    problems = F.to_json(F.when(F.col("errors").isNull(), F.array().cast("array<string>")).otherwise(F.col("errors")))
    line = (
        F.when(F.col("kind") == "text", F.concat(F.lit('{"content":'), F.col("body"), F.lit(',"role":'), quoted("role"), F.lit("}")))
        .when(
            F.col("kind") == "call",
            F.concat(F.lit('{"arguments":'), F.col("body"), F.lit(',"errors":'), problems, F.lit(',"id":'), quoted("call_id"), F.lit(',"name":'), quoted("name"), F.lit(',"role":"assistant","status":"'), F.col("status"), F.lit('"}')),
        )
        .otherwise(F.concat(F.lit('{"content":'), F.col("body"), F.lit(',"role":"tool","status":"'), F.col("status"), F.lit('","tool_call_id":'), quoted("call_id"), F.lit("}")))
    )
    return out.select("conv_id", "order_turn", "order_depth", "turn", "part", "kind", "call_id", "status", line.alias("json"))
