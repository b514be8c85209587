import hashlib
import json
import random

import pytest

from loomline.llm.toolcalls import TURN_TOOLS, as_tool_turns, breaks, canonical, check_schema, levels, link_tool_calls, op2_tool_call_linking

SCHEMAS = {
    "add": {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": ["number", "string"]}, "c": {"enum": ["x", "y"]}}},
    "list": {"type": "object", "properties": {"v": {"type": "array", "items": {"type": "string"}, "maxItems": 2}, "flag": {"type": "boolean"}}},
}
TURNS = "conv_id long, turn long, text string, id string, level int"


def call(*calls):
    return json.dumps({"tool_calls": list(calls)})


def test_canonical_and_schema():
    assert canonical({"b": 1.0, "a": [1.5, {"é": None, "A": True}]}) == '{"a":[1.5,{"A":true,"é":null}],"b":1}'
    good = [{"a": 1}, {"a": 2, "b": 1.5}, {"a": 0, "b": "s", "c": "x"}, {"a": 3.0}]
    bad = [{}, {"a": -1}, {"a": True}, {"a": "1"}, {"a": 1, "c": "z"}, {"a": 1, "d": 1}, {"a": 1.5}]
    assert not any(breaks(x, SCHEMAS["add"]) for x in good) and all(breaks(x, SCHEMAS["add"]) for x in bad)
    assert breaks({"v": ["a", 1]}, SCHEMAS["list"]) and breaks({"v": ["a"] * 3}, SCHEMAS["list"]) and breaks([], SCHEMAS["list"]) and not breaks({"v": [], "flag": False, "other": 1}, SCHEMAS["list"])


def test_links(spark):
    rows = [
        (1, 0, call({"id": "a", "name": "add", "arguments": {"b": 2, "a": 1}}, {"id": "b", "name": "add", "arguments": '{"a": 5, "b": "$a"}'})),
        (1, 1, json.dumps({"tool_call_id": "a", "content": {"z": 1.0, "y": "é"}})), (1, 2, json.dumps({"tool_call_id": "b", "content": None})),
        (1, 3, call({"id": "c", "name": "list", "arguments": {"v": ["$b", "$a"]}, "depends_on": ["nobody"]})),
        (2, 0, call({"id": "a", "name": "add", "arguments": {"a": 1}, "depends_on": ["b"]}, {"id": "b", "name": "add", "arguments": {"a": 1}, "depends_on": ["a"]}, {"id": "d", "name": "add", "arguments": {"a": 1}, "depends_on": ["b"]})),
        (2, 1, json.dumps({"tool_call_id": "zz", "content": "lost"})), (3, 0, call({"name": "nope", "arguments": {}}, {"name": "add", "arguments": {"a": "x"}}, {"id": 7, "name": "add", "arguments": [1]}, "junk")),
        (3, 1, "plain text"), (3, 2, "{broken"), (3, 3, None), (3, 4, ""), (3, 5, "[1]"), (3, 6, '{"tool_calls": 3}'), (None, 0, call({"id": "n", "name": "add", "arguments": {"a": 1}})), (None, None, json.dumps({"tool_call_id": "n", "content": [1]})),
        (4, 0, call({"id": "a", "name": "add", "arguments": {"a": 1}})), (4, 0, call({"id": "a", "name": "add", "arguments": {"a": 1}})), (4, 1, json.dumps({"tool_call_id": "a", "content": 1})), (4, 2, json.dumps({"tool_call_id": "a", "content": 2})),
        (5, 0, call({"id": "self", "name": "add", "arguments": {"a": 1}, "depends_on": ["self"]})), (6, 0, call(*({"id": f"k{i}", "name": "add", "arguments": {"a": i}, "depends_on": [f"k{i - 1}"]} for i in range(6)))),
    ]
    out = link_tool_calls(spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS), SCHEMAS).collect()
    more = [r for r in out if r.status.startswith("duplicate")]
    assert [(r.conv_id, r.call_id, r.status, r.result_turn, r.copies, r.linked_json) for r in more] == [(4, "a", "duplicate_result", 2, 1, '{"arguments":null,"id":"a","name":null,"result":2}')]
    got = {(r.conv_id, r.call_id): r for r in out if r not in more}
    assert got[4, "a"].copies == 2 and got[1, "a"].copies == 1
    status = {k: (r.status, r.level) for k, r in got.items()}
    assert status == {
        (1, "a"): ("linked", 0), (1, "b"): ("linked", 1), (1, "c"): ("unanswered", 2), (2, "a"): ("cyclic", None), (2, "b"): ("cyclic", None), (2, "d"): ("cyclic", None), (2, "zz"): ("orphan", None),
        (3, "0.0"): ("unknown_tool", 0), (3, "0.1"): ("invalid", 0), (3, "7"): ("invalid", 0), (None, "n"): ("linked", 0), (4, "a"): ("linked", 0), (5, "self"): ("cyclic", None),
        **{(6, f"k{i}"): ("unanswered", i) for i in range(6)},
    }
    assert got[1, "a"].linked_json == '{"arguments":{"a":1,"b":2},"id":"a","name":"add","result":{"y":"é","z":1}}'
    assert got[4, "a"].duplicates == 2 and json.loads(got[4, "a"].linked_json)["result"] == 1
    assert all(hashlib.sha256(r.linked_json.encode()).hexdigest() == r.linked_sha256 for r in got.values())
    assert all(canonical(json.loads(r.linked_json)) == r.linked_json for r in got.values())


def test_levels_of_long_chains_and_random_graphs(spark):
    rng, rows, want = random.Random(8), [], {}
    graphs = {"chain": {i: [i - 1] if i else [] for i in range(90)}, "ring": {i: [(i + 1) % 7] for i in range(7)} | {7: [3], 8: [7, 9], 9: []}}
    for g in range(6):
        graphs[f"dag{g}"] = {i: rng.sample(range(i), min(i, rng.randrange(4))) for i in range(30)}
    for conv, graph in graphs.items():
        def level(i, seen=(), graph=graph):
            if i in seen:
                return None
            below = [level(j, (*seen, i)) for j in graph[i]]
            return None if None in below else 1 + max(below) if below else 0

        for i, on in graph.items():
            rows.append((conv, str(i), [str(j) for j in on] + ["absent"]))
            if conv != "chain" and (x := level(i)) is not None:
                want[conv, str(i)] = x
    want |= {("chain", str(i)): i for i in range(90)}
    got = {(r.conv, r.id): r.level for r in levels(spark.createDataFrame(rows, "conv string, id string, depends array<string>")).collect()}
    assert got == want


def brute_levels(graph):
    level, changed = {}, True
    while changed:
        changed = False
        for i, on in graph.items():
            real = [j for j in on if j in graph]
            if i not in level and all(j in level for j in real):
                level[i], changed = max((1 + level[j] for j in real), default=0), True
    return level


def test_levels_with_any_identifier(spark):
    names = ["", "\x1fcycle", "a", "b", " ", "null", "0", "\x1f"]
    rng, rows, want = random.Random(4), [], {}
    for g in range(40):
        graph = {i: rng.sample([*names, "absent"], rng.randrange(3)) for i in rng.sample(names, rng.randrange(1, 9))}
        rows += [(str(g), i, on) for i, on in graph.items()]
        want |= {(str(g), i): n for i, n in brute_levels(graph).items()}
    got = {(r.conv, r.id): r.level for r in levels(spark.createDataFrame(rows, "conv string, id string, depends array<string>")).collect()}
    assert got == want


def test_numbers_and_characters_that_json_cannot_hold(spark):
    rows = [
        (1, 0, '{"tool_calls": [{"id": "big", "name": "add", "arguments": {"a": 1e999}}, {"id": "deep", "name": "add", "arguments": "{\\"a\\": NaN}"}]}'), (1, 1, '{"tool_call_id": "big", "content": [-1e999]}'),
        (1, 2, '{"tool_calls": [{"id": "nan", "name": "add", "arguments": {"a": NaN}}]}'), (1, 3, '{"tool_calls": [{"id": "h\\ud800", "name": "list", "arguments": {"v": ["\\udc00", "\\ud83d\\ude00"]}, "depends_on": ["\\ud800"]}]}'),
        (1, 4, '{"tool_call_id": "h\\ud800", "content": "\\ud800"}'), (1, 5, call({"id": "long", "name": "list", "arguments": {"v": ["x" * 3_000_000]}})), (1, 6, call({"id": True, "name": "add", "arguments": {"a": 2}})),
        (1, 7, '{"tool_calls": [{"id": "nest", "name": "add", "arguments": ' + "[" * 900 + "]" * 900 + "}]}"), (1, 8, "[" * 200_000),
    ]
    got = {r.call_id: r for r in link_tool_calls(spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS), SCHEMAS).collect()}
    assert {k: r.status for k, r in got.items()} == {"big": "invalid", "deep": "invalid", "h\ufffd": "linked", "long": "unanswered", "6.0": "unanswered", "nest": "invalid"}
    assert json.loads(got["big"].linked_json)["result"] == "[-inf]" and json.loads(got["h\ufffd"].linked_json)["arguments"] == {"v": ["\ufffd", "\U0001f600"]}
    assert len(got["long"].linked_json) > 3_000_000
    assert all(hashlib.sha256(r.linked_json.encode()).hexdigest() == r.linked_sha256 for r in got.values())


def test_every_call_and_result_is_a_row(spark):
    rng, rows = random.Random(3), []
    for i in range(400):
        ident = rng.choice(["a", "", "b", f"u{i % 40}"]) if i % 3 else "hot"
        turn = rng.choice([None, *range(9)])
        rows.append((i % 2, turn, call({"id": ident, "name": "add", "arguments": {"a": rng.randrange(4)}}) if rng.random() < 0.5 else json.dumps({"tool_call_id": ident, "content": rng.randrange(4)})))
    out = link_tool_calls(spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS).repartition(5), SCHEMAS).collect()
    calls = {(c, t, x) for c, t, x in rows if "tool_calls" in x}
    results = {(c, t, x) for c, t, x in rows if "tool_calls" not in x}
    first = [r for r in out if not r.status.startswith("duplicate")]
    called = [r for r in out if r.name is not None]
    assert len(called) == len(calls) and sum(r.copies for r in called) == sum("tool_calls" in x for _, _, x in rows)
    assert len([r for r in out if "result" in r.status]) + sum(json.loads(r.linked_json)["result"] is not None for r in first) == len(results)
    assert len({(r.conv_id, r.call_id) for r in first}) == len(first)
    assert sum(1 + r.duplicates + (r.status == "linked") for r in first) == len(rows)


def test_schema_keywords():
    tree = {"type": "object", "$defs": {"n": {"type": "object", "properties": {"next": {"$ref": "#/$defs/n"}, "v": {"exclusiveMinimum": 0, "exclusiveMaximum": 9, "multipleOf": 2}}}}, "properties": {"root": {"$ref": "#/$defs/n"}}}
    assert not breaks({"root": {"v": 2, "next": {"v": 4}}}, tree) and all(breaks({"root": {"next": {"v": v}}}, tree) for v in (0, 9, 3, 10))
    for schema, good, bad in [
        ({"pattern": "^a+$"}, ["a", 1], ["b"]), ({"anyOf": [{"type": "string"}, {"minimum": 3}]}, ["x", 3], [2]), ({"oneOf": [{"minimum": 1}, {"maximum": 3}]}, [0, 4], [2]), ({"allOf": [{"minimum": 1}, {"maximum": 3}]}, [2], [0, 4]),
        ({"not": {"type": "null"}}, [1], [None]), ({"uniqueItems": True}, [[1, True], []], [[1, 1.0]]), ({"enum": [1, "x"]}, [1, 1.0, "x"], [True]), ({"const": False}, [False], [0]),
        ({"additionalProperties": {"type": "string"}, "minProperties": 1}, [{"a": "b"}], [{}, {"a": 1}]), ({"type": "number"}, [1], [float("inf"), float("nan"), True]), ({"type": "integer"}, [1e300], [float("inf"), 1.5]),
    ]:
        check_schema(schema)
        assert not any(breaks(x, schema) for x in good) and all(breaks(x, schema) for x in bad), schema
    assert breaks(0.35, {"multipleOf": 0.1}) and not breaks(0.3, {"multipleOf": 0.1}) and not breaks(10**300, {"multipleOf": 10}) and breaks(10**309, {})
    check_schema({"anyOf": [{"$ref": "#/anyOf/1"}, {"type": ["string", "null"]}], "properties": {"next": {"$ref": "#"}}})
    for schema in (
        {"format": "email"}, {"properties": {"a": {"contains": {}}}}, {"$ref": "http://x"}, {"items": [1]}, {"$ref": "#/nope"}, {"$ref": "#"}, {"allOf": [{"$ref": "#"}]}, {"pattern": "("}, {"minimum": None}, {"minLength": -1}, {"required": "a"}, {"type": "text"},
        {"$defs": {"a": {"$ref": "#/$defs/b"}, "b": {"not": {"$ref": "#/$defs/a"}}}}, {"multipleOf": 0}, {"anyOf": []}, {"enum": 1}, {"properties": {"a": {"$ref": "#/required"}}, "required": ["a"]},
    ):
        with pytest.raises(ValueError):
            check_schema(schema)


def test_turns_of_other_roles_are_kept(spark):
    rows = [(1, 0, "tool", "hi"), (1, 1, None, "ho"), (1, 2, "user", "hi"), (1, 3, "assistant", None)]
    got = link_tool_calls(as_tool_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), TURN_TOOLS).collect()
    assert sorted((r.call_id, r.name, r.status) for r in got) == [("t0", "tool", "unknown_tool"), ("t1", "unknown", "unknown_tool"), ("t2", "reply", "linked")]


def test_empty(spark):
    assert link_tool_calls(spark.createDataFrame([], TURNS), SCHEMAS).count() == 0


def plain_query(turns):
    """Every row of the query over turns with a number, one a (conversation, turn)."""
    at = {(r.conv_id, r.turn): r for r in turns}
    dumps = lambda v: json.dumps(v, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    out = []

    def row(conv, ident, call, answer, name, level, status, arguments):
        shown = dumps({"id": ident, "name": name, "arguments": arguments, "result": answer.text if answer else None})
        out.append((conv, ident, call and call.turn, answer and answer.turn, name, level, status, int(call is not None), 0, shown, hashlib.sha256(shown.encode()).hexdigest()))

    for (conv, turn), r in at.items():
        after = at.get((conv, turn + 1))
        answer = after if after and after.role == "assistant" else None
        if r.role == "assistant":
            before = at.get((conv, turn - 1))
            if before is None or before.role == "assistant":
                row(conv, f"t{turn - 1}", None, r, None, None, "orphan", None)
        elif r.role == "user":
            level = 0
            while (x := at.get((conv, turn - 2 * level - 2))) and x.role == "user":
                level += 1
            arguments = {"prompt": r.text, "turn": turn} | ({"after": f"$t{turn - 2}"} if level else {})
            row(conv, f"t{turn}", r, answer, "reply", level, "invalid" if not r.text or turn < 0 else "linked" if answer else "unanswered", arguments)
        else:
            known = r.role == "system"
            row(conv, f"t{turn}", r, answer, "configure" if known else r.role, 0, "unknown_tool" if not known else "invalid" if not r.text else "linked" if answer else "unanswered", {"instructions" if known else "text": r.text})
    return out


def test_every_row_of_the_query(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = turns.collect()
    assert len({(r.conv_id, r.turn) for r in rows}) == len(rows) and all(r.text is not None and r.turn is not None for r in rows)
    got = op2_tool_call_linking(spark, "/root/testdata/sf0.01")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain_query(rows), key=str)
    assert as_tool_turns(turns.limit(0)).count() == 0


def test_whole_numbers_of_any_length(spark):
    sound = '{"id": "ok%d", "name": "add", "arguments": {"a": 2}}'
    rows = [(1, i, '{"tool_calls": [{"id": "n%d", "name": "add", "arguments": {"a": %s}}, %s]}' % (i, "-" * (i % 2) + "9" * n, sound % i)) for i, n in enumerate((308, 309, 400, 5000, 100_000))]
    rows.append((1, 9, '{"tool_call_id": "n2", "content": [%s]}' % ("7" * 5000)))
    got = {r.call_id: r for r in link_tool_calls(spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS), SCHEMAS).collect()}
    assert {k: r.status for k, r in got.items() if k[0] == "o"} == {f"ok{i}": "unanswered" for i in range(5)}
    assert [got[f"n{i}"].status for i in range(1, 5)] == ["invalid"] * 4 and "9" * 5000 in got["n3"].linked_json and "7" * 5000 in got["n2"].linked_json


def test_turns_without_a_number_are_kept(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "ho"), (1, None, "user", "hi"), (1, None, "user", "hi"), (1, None, "user", "other"), (1, None, "assistant", "hi"), (1, None, "system", "be kind"), (None, None, "user", None)]
    got = link_tool_calls(as_tool_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), TURN_TOOLS).collect()
    assert sorted((str(r.conv_id), str(r.name), r.status, r.call_turn is None, r.duplicates) for r in got) == [
        ("1", "None", "orphan", True, 0), ("1", "configure", "unanswered", True, 0), ("1", "reply", "invalid", True, 0), ("1", "reply", "invalid", True, 1), ("1", "reply", "linked", False, 0), ("None", "reply", "invalid", True, 0),
    ]
