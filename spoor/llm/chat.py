"""Chat formatting: tool calls linked with their results.

Calls and results meet by a hash join on the call's identifier. A call may name the call
it comes after; its depth in that order is found by doubling pointers, in as many rounds
as the logarithm of the longest chain, and sorting by depth is a topological order.
Arguments are checked against the tool's schema, and each call with its result becomes
one canonical JSON text: sorted keys, no spaces, characters unescaped.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.llm.tables import written

_KINDS = {
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
}


def schema_errors(arguments: object, schema: dict) -> list[str]:
    """What is wrong with arguments, by a schema {properties, required}; a property may
    have type, enum, minLength, maxLength, minimum and maximum. In order of the names."""
    if not isinstance(arguments, dict):
        return ["arguments: no object"]
    found = [f"{name}: missing" for name in sorted(schema.get("required", ())) if name not in arguments]
    for name in sorted(arguments):
        rule, value = schema["properties"].get(name), arguments[name]
        if rule is None:
            found.append(f"{name}: unknown")
        elif "type" in rule and not _KINDS[rule["type"]](value):
            found.append(f"{name}: no {rule['type']}")
        elif "enum" in rule and value not in rule["enum"]:
            found.append(f"{name}: not allowed")
        elif isinstance(value, str) and len(value) < rule.get("minLength", 0):
            found.append(f"{name}: too short")
        elif isinstance(value, str) and len(value) > rule.get("maxLength", len(value)):
            found.append(f"{name}: too long")
        elif isinstance(value, (int, float)) and value < rule.get("minimum", value):
            found.append(f"{name}: too small")
        elif isinstance(value, (int, float)) and value > rule.get("maximum", value):
            found.append(f"{name}: too large")
    return found


def canonical(value: object) -> str:
    """JSON with sorted keys and without spaces. Characters stand as they are, unless one
    of them is half of a surrogate pair, which UTF-8 does not have."""
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    try:
        text.encode()
    except UnicodeEncodeError:
        text = json.dumps(value, sort_keys=True, separators=(",", ":"), allow_nan=False)
    return text


def _refuse(name: str) -> None:
    raise ValueError(name)


def checked(call_id: str | None, name: str | None, arguments: str | None, result: str | None, schemas: dict) -> tuple:
    """(errors, message) of a call; the message is null if its arguments are no JSON."""
    try:
        value = json.loads(arguments if arguments is not None else "null", parse_constant=_refuse)
        message = canonical({"arguments": value, "id": call_id, "name": name, "result": result})
    except (ValueError, RecursionError):
        return ["arguments: no JSON"], None
    if name not in schemas:
        return ["tool: unknown"], message
    return schema_errors(value, schemas[name]), message


def depths(calls: DataFrame) -> DataFrame:
    """(call_id, depth, order) for calls (call_id, after), call_id unique and not null.

    order: 'ok', 'unknown' where ``after`` names no call (depth 0 then), or 'cycle',
    without a depth, for calls on a cycle and all that come after one.
    """
    known = calls.select(F.col("call_id").alias("k_id"))
    state = written(
        calls.join(known, calls["after"] == known["k_id"], "left").select(
            "call_id",
            F.col("k_id").alias("up"),
            F.when(F.col("k_id").isNull(), 0).otherwise(1).cast("long").alias("depth"),
            (F.col("after").isNotNull() & F.col("k_id").isNull()).alias("unknown"),
        )
    )
    total, open_ = state.select(F.count("*"), F.count("up")).first()
    rounds = 0
    while open_ and rounds <= total.bit_length():
        above = state.select(F.col("call_id").alias("a_id"), F.col("up").alias("a_up"), F.col("depth").alias("a_depth"))
        moved = state.filter("up IS NOT NULL").join(above, F.col("up") == F.col("a_id"))
        state = written(
            state.filter("up IS NULL").unionByName(
                moved.select("call_id", F.col("a_up").alias("up"), (F.col("depth") + F.col("a_depth")).alias("depth"), "unknown")
            )
        )
        open_ = state.select(F.count("up")).first()[0]
        rounds += 1
    return state.select(
        "call_id",
        F.when(F.col("up").isNull(), F.col("depth")).alias("depth"),
        F.when(F.col("up").isNotNull(), "cycle").when(F.col("unknown"), "unknown").otherwise("ok").alias("order"),
    )


def linked(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row for each call: (thread, place, call_id, depth, calls, results, status, errors, message).

    calls: thread, place, call_id, name, arguments (JSON), after; results: call_id, place,
    content. Of calls with one identifier the first by place (null first), name and
    arguments counts, and ``calls`` tells how many there are; likewise ``results``. A call
    without an identifier has no result and comes at depth 0, status 'missing id'; results
    without a call are rows of their own, 'orphan', with a null place and message. Other
    statuses, the first that holds: 'cycle', 'unknown predecessor', 'invalid',
    'unanswered', 'ok'. Other columns are ignored; empty tables are fine.
    """
    first = F.struct("place", "name", "arguments", "after", "thread")
    asked = written(
        calls.filter("call_id IS NOT NULL").groupBy("call_id")
        .agg(F.min(first).alias("c"), F.count("*").alias("calls"))
        .select("call_id", "c.*", "calls")
    )
    answered = (
        results.filter("call_id IS NOT NULL").groupBy(F.col("call_id").alias("r_id"))
        .agg(F.min(F.struct("place", "content")).alias("r"), F.count("*").alias("results"))
        .select("r_id", F.col("r.content").alias("content"), "results")
    )
    ordered = depths(asked.select("call_id", "after")).withColumnsRenamed({"call_id": "d_id"})
    met = asked.join(answered, F.col("call_id") == F.col("r_id"), "full").join(
        ordered, F.col("call_id") == F.col("d_id"), "left"
    )
    columns = ("thread", "place", "call_id", "r_id", "name", "arguments", "content", "depth", "calls", "results", "order")
    lone = calls.filter("call_id IS NULL").select(
        "thread", "place", "call_id", F.lit(None).cast("string").alias("r_id"), "name", "arguments",
        F.lit(None).cast("string").alias("content"), F.lit(0).cast("long").alias("depth"),
        F.lit(1).cast("long").alias("calls"), F.lit(None).cast("long").alias("results"), F.lit("missing").alias("order"),
    )
    whole = met.select(*columns).unionByName(lone).select(
        F.col("thread").cast("long"), F.col("place").cast("long"), *columns[2:]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for thread, place, call, other, name, arguments, content, depth, n_calls, n_results, order in zip(
                *(c.to_pylist() for c in batch.columns)
            ):
                if call is None and order is None:
                    rows.append((thread, place, other, None, 0, n_results, "orphan", [], None))
                    continue
                errors, message = checked(call, name, arguments, content, schemas)
                status = (
                    "missing id" if order == "missing"
                    else "cycle" if order == "cycle"
                    else "unknown predecessor" if order == "unknown"
                    else "invalid" if errors
                    else "ok" if n_results
                    else "unanswered"
                )
                rows.append((thread, place, call, depth, n_calls, n_results or 0, status, errors, message))
            columns_ = list(zip(*rows)) or [()] * 9
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns_, kinds)], names)

    names = ["thread", "place", "call_id", "depth", "calls", "results", "status", "errors", "message"]
    return whole.mapInArrow(
        run,
        "thread long, place long, call_id string, depth long, calls long, results long, status string,"
        " errors array<string>, message string",
    )


TURN_SCHEMAS = {
    "answer": {
        "properties": {"text": {"type": "string", "minLength": 40}, "turn": {"type": "integer", "minimum": 0}},
        "required": ["text", "turn"],
    },
    "instruct": {"properties": {"text": {"type": "string"}, "turn": {"type": "integer"}}, "required": ["text"]},
}


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) of conversations (conv_id, turn, role, text): what a user says is
    a call of 'answer' that comes after the user's words two turns before, what the
    assistant says next is its result; a system turn is a call of 'instruct'."""
    identifier = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    calls = conversations.filter("role IN ('user', 'system') AND conv_id IS NOT NULL AND turn IS NOT NULL").select(
        F.col("conv_id").alias("thread"),
        F.col("turn").alias("place"),
        identifier.alias("call_id"),
        F.when(F.col("role") == "user", "answer").otherwise("instruct").alias("name"),
        F.to_json(F.struct("text", "turn")).alias("arguments"),
        F.when(
            (F.col("role") == "user") & (F.col("turn") >= 2),
            F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - 2).cast("string")),
        ).alias("after"),
    )
    results = conversations.filter("role = 'assistant'").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string")).alias("call_id"),
        F.col("turn").alias("place"),
        F.col("text").alias("content"),
    )
    return calls, results
