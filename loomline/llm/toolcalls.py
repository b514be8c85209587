"""Operator 2: linking tool calls to their results.

Turns are parsed for calls, {"tool_calls": [{"id", "name", "arguments",
"depends_on"}]}, and results, {"tool_call_id", "content"}.  Calls and results
are hash-joined by (conversation, identifier).  The join is shuffled by both
keys, so that a conversation that holds a third of all rows is spread by its
identifiers.  Arguments are validated against the tool's schema (types,
required and unknown members, enumerations, ranges).  Calls are ordered
topologically by their dependencies, which are explicit identifiers or, by
"$<id>" strings, implied in the arguments; levels are found by rounds of joins
on (conversation, identifier), with chains halved each round and no conversation
gathered in one task.  Output is canonical JSON: members sorted by code point,
no spaces, shortest numbers, UTF-8, so equal calls have equal digests.

Defined results: turns that are not JSON objects of these kinds carry no call
or result (NaN and Infinity are no JSON); numbers beyond a double make arguments
`invalid` and are shown as text; half of a surrogate pair is shown as U+FFFD; a
call without an identifier gets "<turn>.<index>"; of calls with the same
identifier the first (turn, index) counts and every other that differs from it
is a row of its own, `duplicate`, likewise `duplicate_result`; `copies` counts
rows that are equal as a whole, `duplicates` all calls and results of the
identifier after the first; a call without result is `unanswered`, a result
without call `orphan`; arguments that are no object or break the schema are
`invalid`, of an unknown tool `unknown_tool`; calls on a cycle or behind one
have a null level and are `cyclic`; dependencies that name no call of the
conversation are ignored; null conversations form one; null text carries
nothing; an empty identifier is one like any other; an empty table gives an
empty result; other columns are ignored; a schema with a keyword that the
validator does not know, a value that is not the keyword's, or a reference that
leads nowhere or in a circle is an error, before any row is read.
"""

from __future__ import annotations

import json
import math
import re
import sys
from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import staged, table

TURN = "conv_id long, turn long, idx int, id string, name string, arguments string, depends array<string>, verdict string, content string"
#: Of an edge: leads to a call that is not settled, to a settled one, round a cycle.
OPEN, ENDED, LOOSE = 0, 1, 2
#: Identifiers whose first call or result is broadcast, at most.
HOT_IDS = 20_000
#: Schemas of the tools that the conversations query derives from plain turns.
TURN_TOOLS = {
    "reply": {"type": "object", "required": ["prompt", "turn"], "additionalProperties": False, "properties": {
        "prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}, "after": {"type": "string"}}},
    "configure": {"type": "object", "required": ["instructions"], "additionalProperties": False, "properties": {"instructions": {"type": "string", "minLength": 1}}},
}


def canonical(value: object) -> str:
    """Canonical JSON: sorted members, no spaces, integral numbers without fraction."""

    def plain(v: object) -> object:
        if isinstance(v, dict):
            return {k: plain(v[k]) for k in sorted(v)}
        if isinstance(v, list):
            return [plain(x) for x in v]
        if isinstance(v, Beyond):
            raise ValueError("no JSON number that a double holds")
        if isinstance(v, float):
            if not math.isfinite(v):
                raise ValueError("no JSON number")
            return int(v) if v == int(v) and abs(v) < 1 << 53 else v
        return v

    return json.dumps(plain(value), ensure_ascii=False, separators=(",", ":"), allow_nan=False)


_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


#: Keywords that the validator follows, and those that say nothing about a value.
KEYWORDS = {
    "type", "enum", "const", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf", "minLength", "maxLength", "pattern", "minItems", "maxItems", "uniqueItems", "items",
    "properties", "required", "additionalProperties", "minProperties", "maxProperties", "anyOf", "allOf", "oneOf", "not", "$ref", "definitions", "$defs",
}
NOTES = {"title", "description", "default", "examples", "$schema", "$id", "$comment"}


LARGEST = int(sys.float_info.max)


class Beyond(str):
    """The digits of a whole number that no double holds."""

    __slots__ = ()


def _whole_number(digits: str) -> int | Beyond:
    # longer ones are not even converted: that takes quadratic time, and is refused beyond some thousand digits
    if len(digits) > 310 or abs(number := int(digits)) > LARGEST:
        return Beyond(digits)
    return number


def _is_number(value: object) -> bool:
    return isinstance(value, int | float) and not isinstance(value, bool)


def _is_schema(value: object) -> bool:
    return isinstance(value, dict | bool)


def _is_count(value: object) -> bool:
    return _is_number(value) and value == int(value) and value >= 0


#: What the value of a keyword must be.
VALUES: dict[str, Callable[[object], bool]] = {
    **dict.fromkeys(("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"), lambda v: _is_number(v) and abs(v) <= LARGEST), "multipleOf": lambda v: _is_number(v) and 0 < v <= LARGEST,
    **dict.fromkeys(("minLength", "maxLength", "minItems", "maxItems", "minProperties", "maxProperties"), _is_count),
    **dict.fromkeys(("anyOf", "allOf", "oneOf"), lambda v: isinstance(v, list) and bool(v)), **dict.fromkeys(("items", "not", "additionalProperties"), _is_schema),
    **dict.fromkeys(("properties", "definitions", "$defs"), lambda v: isinstance(v, dict)), "enum": lambda v: isinstance(v, list), "const": lambda v: True, "uniqueItems": lambda v: isinstance(v, bool),
    "required": lambda v: isinstance(v, list) and all(isinstance(x, str) for x in v), "pattern": lambda v: isinstance(v, str), "$ref": lambda v: isinstance(v, str) and v.startswith("#"),
    "type": lambda v: bool(v) and all(isinstance(x, str) and (x in _TYPES or x in ("number", "integer")) for x in (v if isinstance(v, list) else [v])),
}


def _inner(schema: dict) -> Iterator[object]:
    """Schemas inside this one."""
    yield from (schema[k] for k in ("items", "not", "additionalProperties") if k in schema)
    yield from (x for k in ("anyOf", "allOf", "oneOf") for x in schema.get(k, ()))
    yield from (x for k in ("properties", "definitions", "$defs") for x in schema.get(k, {}).values())


def check_schema(schema: object) -> None:
    """Raises ValueError for what `breaks` cannot follow: unknown keywords, values of the wrong kind, references that lead nowhere or in a circle."""
    todo = [schema]
    every: list[dict] = []
    while todo:
        one = todo.pop()
        if not _is_schema(one):
            raise ValueError("a schema is an object or a boolean")
        if isinstance(one, bool):
            continue
        if unknown := set(one) - KEYWORDS - NOTES:
            raise ValueError(f"schema keywords that are not supported: {sorted(unknown)}")
        if wrong := [k for k, v in one.items() if k in VALUES and not VALUES[k](v)]:
            raise ValueError(f"schema keywords with a value that is not theirs: {wrong}")
        if "pattern" in one:
            try:
                re.compile(one["pattern"])
            except re.error as error:
                raise ValueError(f"no pattern: {one['pattern']!r}") from error
        if "$ref" in one and not _is_schema(_target(schema, one["$ref"])):
            raise ValueError(f"a reference to no schema: {one['$ref']!r}")
        every.append(one)
        todo += _inner(one)
    # schemas that look at the same value as the one that names them must not come back to it
    done: set[int] = set()
    for start in every:
        path, open_ = [(start, iter(_same_value(start, schema)))], {id(start)}
        while path and id(start) not in done:
            one, rest = path[-1]
            following = next(rest, None)
            if following is None:
                path.pop()
                open_.discard(id(one))
                done.add(id(one))
            elif id(following) in open_:
                raise ValueError("references in a circle")
            elif id(following) not in done:
                path.append((following, iter(_same_value(following, schema))))
                open_.add(id(following))


def _same_value(schema: dict, root: object) -> list[dict]:
    found = [x for k in ("anyOf", "allOf", "oneOf") for x in schema.get(k, ())] + [schema[k] for k in ("not",) if k in schema] + [_target(root, schema[k]) for k in ("$ref",) if k in schema]
    return [x for x in found if isinstance(x, dict)]


def _target(root: object, ref: str) -> object:
    """What a reference leads to; ValueError if nothing."""
    try:
        for step in ref.lstrip("#").strip("/").split("/") if ref not in ("#", "#/") else ():
            root = root[int(step)] if isinstance(root, list) else root[step.replace("~1", "/").replace("~0", "~")]
    except (KeyError, IndexError, TypeError, ValueError) as error:
        raise ValueError(f"a reference to nothing: {ref!r}") from error
    return root


def _same(a: object, b: object) -> bool:
    """Equal as JSON: 1 and 1.0 are, 1 and true are not."""
    try:
        return canonical(a) == canonical(b)
    except ValueError:
        return False


def breaks(value: object, schema: dict | bool, root: object = None) -> bool:
    """Whether value breaks the schema."""
    root = schema if root is None else root
    if isinstance(schema, bool):
        return not schema
    again = lambda v, s: breaks(v, s, root)
    if "$ref" in schema and again(value, _target(root, schema["$ref"])):
        return True
    kind = schema.get("type")
    number = _is_number(value)
    if isinstance(value, Beyond) or number and not -LARGEST <= value <= LARGEST:
        return True
    if kind:
        kinds = kind if isinstance(kind, list) else [kind]
        if not any((k == "number" and number) or (k == "integer" and number and value == int(value)) or (k in _TYPES and isinstance(value, _TYPES[k])) for k in kinds):
            return True
    if ("enum" in schema and not any(_same(value, x) for x in schema["enum"])) or ("const" in schema and not _same(value, schema["const"])):
        return True
    if any(again(value, s) for s in schema.get("allOf", ())) or ("anyOf" in schema and all(again(value, s) for s in schema["anyOf"])):
        return True
    if ("oneOf" in schema and sum(not again(value, s) for s in schema["oneOf"]) != 1) or ("not" in schema and not again(value, schema["not"])):
        return True
    if number:
        if value < schema.get("minimum", -math.inf) or value > schema.get("maximum", math.inf) or value <= schema.get("exclusiveMinimum", -math.inf) or value >= schema.get("exclusiveMaximum", math.inf):
            return True
        # as decimals: 0.3 is a multiple of 0.1
        return "multipleOf" in schema and Fraction(repr(value)) % Fraction(repr(schema["multipleOf"])) != 0
    if isinstance(value, str):
        return not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", math.inf) or ("pattern" in schema and not re.search(schema["pattern"], value))
    if isinstance(value, list):
        if not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", math.inf) or ("items" in schema and any(again(x, schema["items"]) for x in value)):
            return True
        return bool(schema.get("uniqueItems")) and any(_same(x, y) for i, x in enumerate(value) for y in value[:i])
    if isinstance(value, dict):
        known, more = schema.get("properties", {}), schema.get("additionalProperties", True)
        if not schema.get("minProperties", 0) <= len(value) <= schema.get("maxProperties", math.inf) or any(k not in value for k in schema.get("required", ())):
            return True
        return any(again(v, known[k] if k in known else more) for k, v in value.items())
    return False


def references(value: object) -> Iterator[str]:
    if isinstance(value, str) and value.startswith("$") and len(value) > 1:
        yield value[1:]
    elif isinstance(value, dict | list):
        for v in value.values() if isinstance(value, dict) else value:
            yield from references(v)


@cache
def _schemas(text: str) -> dict:
    return json.loads(text)


def _whole(text: str | None) -> str | None:
    """text without halves of surrogate pairs, which UTF-8 cannot hold."""
    return None if text is None else re.sub("[\ud800-\udfff]", "\ufffd", text)


def _shown(value: object) -> tuple[str, bool]:
    """Canonical JSON of value, or of its text where it has none; whether it has."""
    try:
        return canonical(value), True
    except (ValueError, RecursionError):
        return canonical(str(value)), False


def _calls(turn: int | None, doc: dict, schemas: dict) -> Iterator[tuple]:
    calls = doc.get("tool_calls")
    for i, call in enumerate(calls if isinstance(calls, list) else []):
        if not isinstance(call, dict):
            continue
        name, args = call.get("name"), call.get("arguments", {})
        if isinstance(args, str):
            try:
                args = _loads(args)
            except (ValueError, RecursionError):
                pass
        shown, fine = _shown(args)
        verdict = "ok"
        if not isinstance(name, str) or name not in schemas:
            verdict = "unknown_tool"
        elif not fine or not isinstance(args, dict) or breaks(args, schemas[name]):
            verdict = "invalid"
        after = call.get("depends_on")
        depends = sorted({x for x in (after if isinstance(after, list) else []) if isinstance(x, str)} | (set(references(args)) if fine else set()))
        ident = call.get("id")
        ident = str(ident) if isinstance(ident, str | int) and not isinstance(ident, bool) else f"{turn}.{i}"
        yield i, _whole(ident), _whole(name) if isinstance(name, str) else None, _whole(shown), [_whole(x) for x in depends], verdict, None


def _results(doc: dict) -> Iterator[tuple]:
    ident = doc.get("tool_call_id")
    if isinstance(ident, str | int) and not isinstance(ident, bool):
        yield None, _whole(str(ident)), None, None, None, None, _whole(_shown(doc.get("content"))[0])


def _no_number(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


def _loads(text: str) -> object:
    return json.loads(text, parse_constant=_no_number, parse_int=_whole_number)


def _parsed(text: str | None) -> dict:
    if not text or not text.lstrip().startswith("{"):
        return {}
    try:
        doc = _loads(text)
    except (ValueError, RecursionError):
        return {}
    return doc if isinstance(doc, dict) else {}


def parse(turns: DataFrame, schemas: dict) -> tuple[DataFrame, DataFrame]:
    """Distinct calls and results of turns (conv_id, turn, text), with the number of copies of each; texts are parsed once."""
    for schema in schemas.values():
        check_schema(schema)
    told = json.dumps(schemas, sort_keys=True)
    names = [f.split()[0] for f in TURN.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, turn, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                doc = _parsed(text)
                rows += [(conv, turn, *x) for found in (_calls(turn, doc, _schemas(told)), _results(doc)) for x in found]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    found = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "text").mapInArrow(run, TURN)
    # equal rows become one before anything is joined, once a task before the shuffle
    distinct = staged(found.groupBy(*names).agg(F.count(F.lit(1)).alias("copies")))
    return distinct.where("verdict is not null").drop("content"), distinct.where("verdict is null").select("conv_id", "turn", "id", "content", "copies")


def levels(calls: DataFrame) -> DataFrame:
    """(conv, id, level): 0 for calls that wait for none, else one more than the latest they wait for.

    Each round first shortens edges: an edge to a call that waits for just one
    other is led on to that one, and the lengths add up, so a chain of n calls
    takes log2 n rounds; then calls all of whose edges end at settled calls are
    settled.  An edge longer than there are edges runs round a cycle and is cut
    loose; calls on or behind cycles are never settled and do not appear."""
    edges = calls.select("conv", "id", F.explode("depends").alias("on"))
    real = edges.join(calls.select("conv", F.col("id").alias("on")), ["conv", "on"]).select("conv", "id", "on").distinct()
    # an edge that has ended names no call any more: on is null
    edges = staged(real.withColumn("w", F.lit(1).cast("long")).withColumn("state", F.lit(OPEN)))
    total = edges.count()
    new = calls.join(edges.select("conv", "id").distinct(), ["conv", "id"], "left_anti").select("conv", "id", F.lit(0).cast("long").alias("level"))
    if not total:
        return new
    settled, state = [staged(new)], (total, total)
    while state[0]:
        ends = settled[-1].select("conv", F.col("id").alias("on"), F.col("level").alias("end"))
        # an edge to a settled call ends there for good, and its length is the level that it asks for
        over = F.col("end").isNotNull()
        ended = edges.join(ends, ["conv", "on"], "left").select(
            "conv", "id", F.when(~over, F.col("on")).alias("on"), (F.col("w") + F.coalesce("end", F.lit(0))).alias("w"), F.when(over, ENDED).otherwise(F.col("state")).alias("state")
        )
        single = ended.groupBy("conv", "id").agg(F.count(F.lit(1)).alias("n"), F.first(F.struct("on", "w", "state")).alias("next")).where("n = 1").select("conv", F.col("id").alias("on"), "next")
        led = ended.join(single, ["conv", "on"], "left").select(
            "conv", "id", F.when(F.col("next").isNull(), F.col("on")).otherwise(F.col("next.on")).alias("on"), (F.col("w") + F.coalesce("next.w", F.lit(0))).alias("w"), F.coalesce("next.state", "state").alias("state")
        )
        # longer than there are edges: it runs round a cycle
        loose = F.col("w") > total + 1
        led = led.select("conv", "id", F.when(~loose, F.col("on")).alias("on"), F.least("w", F.lit(total + 2)).alias("w"), F.when(loose, LOOSE).otherwise(F.col("state")).alias("state"))
        led = staged(led.groupBy("conv", "id", "on", "state").agg(F.max("w").alias("w")))
        new = staged(led.groupBy("conv", "id").agg(F.max("w").alias("level"), F.max(F.col("state") != ENDED).alias("waits")).where("not waits").select("conv", "id", "level"))
        edges = staged(led.join(new, ["conv", "id"], "left_anti"))
        settled.append(new)
        before, state = state, tuple(edges.select(F.count(F.lit(1)), F.coalesce(F.sum("w"), F.lit(0))).first())
        if state == before and not new.limit(1).count():
            break
    return reduce(DataFrame.union, settled)


def others(rows: DataFrame, firsts: DataFrame, order: Column) -> DataFrame:
    """Rows of (conv, id) that are not the first by `order`; firsts: conv, id, _k, n.

    An identifier that many rows share hands its first to them by broadcast."""
    many = firsts.where("n > 1")
    heavy = max(64, -(-rows.count() // HOT_IDS))
    # each has `heavy` rows or more, so these are HOT_IDS at most
    hot = F.broadcast(many.where(F.col("n") >= heavy).select(F.col("conv").alias("_conv"), F.col("id").alias("_id"), F.col("_k").alias("_hot")))
    marked = rows.join(hot, (F.col("conv") == F.col("_conv")) & (F.col("id") == F.col("_id")), "left").drop("_conv", "_id")
    rare = marked.where("_hot is null").drop("_hot").join(many.where(F.col("n") < heavy).select("conv", "id", "_k"), ["conv", "id"])
    both = marked.where("_hot is not null").withColumnRenamed("_hot", "_k").unionByName(rare)
    return both.where(order != F.col("_k"))


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """conv_id, call_id, call_turn, result_turn, name, level, status, copies, duplicates, linked_json, linked_sha256 of every distinct call, and of every distinct result that answers none."""
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    calls, results = calls.withColumn("conv", conv), results.withColumn("conv", conv)
    # the first of an identifier counts: least by aggregation, which a hot identifier enters once a task
    call_order = F.struct("turn", "idx", F.xxhash64("name", "arguments", "depends", "verdict"), F.xxhash64("verdict", "depends", "arguments", "name"))
    result_order = F.struct("turn", F.xxhash64("content"), "content")
    first = calls.groupBy("conv", "id").agg(F.min_by(F.struct("conv_id", "turn", "idx", "name", "arguments", "depends", "verdict", "copies"), call_order).alias("c"), F.min(call_order).alias("_k"), F.count(F.lit(1)).alias("n"), F.sum("copies").alias("n_calls"))
    first = staged(first.select("conv", "id", "c.*", "_k", "n", "n_calls"))
    answers = results.groupBy("conv", "id").agg(F.min_by(F.struct("conv_id", "turn", "content"), result_order).alias("r"), F.min(result_order).alias("_k"), F.count(F.lit(1)).alias("n"), F.sum("copies").alias("n_results"))
    answers = staged(answers)
    both = first.drop("_k", "n").join(answers.drop("_k", "n").hint("shuffle_hash"), ["conv", "id"], "full").join(levels(first), ["conv", "id"], "left")
    status = F.when(F.col("n_calls").isNull(), "orphan").when(F.col("verdict") != "ok", F.col("verdict")).when(F.col("level").isNull(), "cyclic").when(F.col("r").isNull(), "unanswered").otherwise("linked")
    linked = both.select(
        F.coalesce("conv_id", "r.conv_id").alias("conv_id"), F.col("id").alias("call_id"), F.col("turn").alias("call_turn"), F.col("r.turn").alias("result_turn"), "name", "level", status.alias("status"), F.coalesce("copies", F.lit(0)).alias("copies"),
        (F.greatest(F.coalesce("n_calls", F.lit(1)) - 1, F.lit(0)) + F.greatest(F.coalesce("n_results", F.lit(1)) - 1, F.lit(0))).alias("duplicates"), "arguments", F.col("r.content").alias("content"),
    )
    none = lambda kind: F.lit(None).cast(kind)
    zero = F.lit(0).cast("long").alias("duplicates")
    more_calls = others(calls, first, call_order).select("conv_id", F.col("id").alias("call_id"), F.col("turn").alias("call_turn"), none("long").alias("result_turn"), "name", none("long").alias("level"), F.lit("duplicate").alias("status"), "copies", zero, "arguments", none("string").alias("content"))
    more_results = others(results, answers, result_order).select("conv_id", F.col("id").alias("call_id"), none("long").alias("call_turn"), F.col("turn").alias("result_turn"), none("string").alias("name"), none("long").alias("level"), F.lit("duplicate_result").alias("status"), "copies", zero, none("string").alias("arguments"), "content")
    quoted = lambda c: F.regexp_replace(F.regexp_replace(F.to_json(F.array(c)), r"^\[", ""), r"\]$", "")
    shown = F.concat(
        F.lit('{"arguments":'), F.coalesce("arguments", F.lit("null")), F.lit(',"id":'), quoted(F.col("call_id")), F.lit(',"name":'), F.when(F.col("name").isNull(), "null").otherwise(quoted(F.col("name"))),
        F.lit(',"result":'), F.coalesce("content", F.lit("null")), F.lit("}"),
    )
    every = linked.union(more_calls).union(more_results).withColumn("linked_json", shown).drop("arguments", "content")
    return every.withColumn("linked_sha256", F.sha2("linked_json", 256))


def link_tool_calls(turns: DataFrame, schemas: dict) -> DataFrame:
    return link(*parse(turns, schemas))


def as_tool_turns(conversations: DataFrame) -> DataFrame:
    """Conversations of plain turns as calls and results.

    A user turn calls `reply` and waits for the user turn before it; the
    assistant turn after it is the result.  A system turn calls `configure`,
    which nothing answers.  A turn of any other role, or none, is a call of a tool
    of that name ("unknown" for none), which no schema knows.  Only neighbours are compared, by a join on the turn
    number, not a window over a conversation.

    A row without a turn number has no neighbours: it is named by its text's
    digest, "t?<digest>", so a call of it waits for none and is answered by none
    (`invalid` for a user turn, as `reply` requires a turn), a result is `orphan`;
    equal rows of a conversation are duplicates."""
    turn = conversations.select("conv_id", "turn", "role", "text")
    earlier = turn.where("role = 'user'").select(F.col("conv_id").alias("_conv"), (F.col("turn") + 2).alias("_turn"), F.lit(True).alias("_before")).distinct()
    joined = turn.join(earlier, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("turn") == F.col("_turn")), "left")
    # the role keeps a result from meeting the call of an equal text
    unnumbered = F.concat(F.lit("t?"), F.sha2(F.concat_ws("\x1f", "role", F.coalesce("text", F.lit("\x1e"))), 256))
    name = F.coalesce(F.concat(F.lit("t"), F.col("turn").cast("string")), unnumbered)
    before = F.when(F.col("_before"), F.concat(F.lit("$t"), (F.col("turn") - 2).cast("string")))
    call = F.to_json(F.struct(F.array(F.struct(name.alias("id"), F.lit("reply").alias("name"), F.struct(F.col("text").alias("prompt"), "turn", before.alias("after")).alias("arguments"))).alias("tool_calls")))
    setup = F.to_json(F.struct(F.array(F.struct(name.alias("id"), F.lit("configure").alias("name"), F.struct(F.col("text").alias("instructions")).alias("arguments"))).alias("tool_calls")))
    other = F.to_json(F.struct(F.array(F.struct(name.alias("id"), F.coalesce("role", F.lit("unknown")).alias("name"), F.struct(F.col("text").alias("text")).alias("arguments"))).alias("tool_calls")))
    result = F.to_json(F.struct(F.coalesce(F.concat(F.lit("t"), (F.col("turn") - 1).cast("string")), unnumbered).alias("tool_call_id"), F.col("text").alias("content")))
    return joined.select("conv_id", "turn", F.when(F.col("role") == "user", call).when(F.col("role") == "system", setup).when(F.col("role") == "assistant", result).otherwise(other).alias("text"))


def op2_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_tool_calls(as_tool_turns(table(spark, sf_dir, "conversations")), TURN_TOOLS)
