"""Linking, order, schemas and canonical lines on small tables; SQL covers the whole one."""

import json
import random

import pytest
from pyspark.sql import functions as F

from posefold.llm.tool_calls import format_chat, link_tool_calls, schema_errors, topological_levels

CALLS = "call_id string, name string, arguments string, after string, level int"
RESULTS = "call_id string, content string, name string"
SCHEMAS = {
    "add": {"type": "object", "properties": {"a": {"type": "integer"}, "b": {"type": "number", "minimum": 0, "maximum": 9}}, "required": ["a"], "additionalProperties": False},
    "say": {"properties": {"to": {"type": "string", "enum": ["x", "y"]}, "what": {"type": "string", "minLength": 2, "maxLength": 3}}},
}


def levels(spark, pairs):
    frame = spark.createDataFrame(pairs, "call_id string, after string")
    return {r.call_id: r.level for r in topological_levels(frame).collect()}


def test_levels(spark):
    chain = [(f"c{i}", f"c{i - 1}" if i else None) for i in range(40)]
    got = levels(spark, chain + [("x", "gone"), ("p", "q"), ("q", "p"), ("r", "q"), ("s", "s"), ("t", "c5")])
    assert all(got[f"c{i}"] == i for i in range(40))
    assert (got["x"], got["p"], got["q"], got["r"], got["s"], got["t"]) == (0, None, None, None, None, 6)
    assert levels(spark, []) == {}


def brute(pairs):
    """Longest ways by the definition; None in and after cycles."""
    calls = {c for c, _ in pairs}
    before = {c: {a for x, a in pairs if x == c and a in calls} for c in calls}
    levels = {}
    while True:
        ready = [c for c in calls if c not in levels and before[c] <= levels.keys()]
        if not ready:
            return {c: levels.get(c) for c in calls}
        for c in ready:
            levels[c] = max((levels[a] + 1 for a in before[c]), default=0)


@pytest.mark.parametrize("seed", range(6))
def test_levels_of_graphs(spark, seed):
    rng = random.Random(seed)
    name = lambda i: f"c{i}"
    pairs = [(name(i), None) for i in range(60)]
    for i in range(1, 60):
        for _ in range(rng.choice([0, 1, 1, 1, 2, 3])):
            pairs.append((name(i), name(rng.randrange(max(0, i - 9), i))))
    pairs += [("late", name(i)) for i in range(0, 60, 7)] + [("late", "gone"), ("late", name(0))]
    if seed % 2:
        i = rng.randrange(20, 50)
        pairs += [(name(i), name(i + 5)), (name(i + 5), name(i))]
    assert levels(spark, pairs) == brute(pairs)


NESTED = {
    "properties": {
        "where": {"type": "object", "properties": {"x": {"type": "integer"}}, "required": ["x"], "additionalProperties": False},
        "tags": {"type": "array", "minItems": 1, "maxItems": 3, "items": {"type": "string", "minLength": 2}},
        "rows": {"type": "array", "items": {"type": "object", "properties": {"n": {"type": "number", "maximum": 5}}, "required": ["n"]}},
    }
}


@pytest.mark.parametrize(
    "arguments,want",
    [
        ('{"where": {"x": 1}, "tags": ["ab"], "rows": [{"n": 1}, {"n": 5}]}', []), ("{}", []),
        ('{"where": {"x": "1", "y": 2}}', ["where.x: not of type integer", "where: unknown: y"]), ('{"where": {}}', ["where.x: missing"]),
        ('{"where": 3, "tags": 4}', ["where: not of type object", "tags: not of type array"]), ('{"tags": []}', ["tags: beyond the minItems"]),
        ('{"tags": ["ab", "c", 1, "d"]}', ["tags: beyond the maxItems", "tags[]: beyond the minLength; tags[]: not of type string"]),
        ('{"rows": [{"n": 9}, {}, 1]}', ["rows[].n: beyond the maximum; rows[].n: missing; rows[]: not of type object"]),
    ],
)
def test_nested_schemas(spark, arguments, want):
    frame = spark.createDataFrame([(arguments,)], "arguments string")
    assert frame.select(schema_errors(F.col("arguments"), NESTED)).first()[0] == want


def test_unknown_keywords_are_refused(spark):
    for schema in ({"pattern": "x"}, {"properties": {"a": {"oneOf": []}}}, {"properties": {"a": {"items": {"format": "date"}}}}):
        with pytest.raises(ValueError, match="not known"):
            schema_errors(F.col("arguments"), schema)


def test_several_references(spark):
    calls = [("a", "t", "{}", None), ("b", "t", "{}", ["a"]), ("c", "t", "{}", ["a", "b", "gone"]), ("d", "t", "{}", ["a"]), ("d", "t", "{}", ["c"]), ("e", "t", "{}", [])]
    frame = spark.createDataFrame(calls, "call_id string, name string, arguments string, after array<string>")
    got = {r.call_id: r for r in link_tool_calls(frame, spark.createDataFrame([], RESULTS), {"t": {}}).collect()}
    assert {c: r.level for c, r in got.items()} == {"a": 0, "b": 1, "c": 2, "d": 3, "e": 0}
    assert got["d"].errors == "calls differ" and got["c"].valid


@pytest.mark.parametrize(
    "tool,arguments,want",
    [
        ("add", '{"a": 1}', []), ("add", '{"b": 1, "a": 2}', []), ("add", '{"a": 1.5}', ["a: not of type integer"]),
        ("add", '{"b": 10}', ["a: missing", "b: beyond the maximum"]), ("add", '{"a": 1, "b": -1.5}', ["b: beyond the minimum"]),
        ("add", '{"a": 1, "z": 0, "y": 0}', ["unknown: y,z"]), ("add", "[1]", ["not an object", "a: missing"]), ("add", "{", ["not JSON"]),
        ("add", None, ["not JSON"]), ("add", '{"a": null}', ["a: not of type integer"]),
        ("say", '{"to": "z", "what": "abcd", "more": 1}', ["to: not an allowed value", "what: beyond the maxLength"]),
        ("say", '{"what": "a"}', ["what: beyond the minLength"]), ("say", "{}", []),
    ],
)
def test_schemas(spark, tool, arguments, want):
    frame = spark.createDataFrame([(arguments,)], "arguments string")
    assert frame.select(schema_errors(F.col("arguments"), SCHEMAS[tool])).first()[0] == want


def test_linking(spark):
    calls = [
        ("1", "add", '{"b": 2, "a": 1}', None, 9), ("2", "add", '{"a":1}', "1", 9), ("3", "say", '{"to":"x"}', "2", 9), ("3", "say", '{"to":"y"}', "2", 9),
        ("4", "who", "{}", "5", 9), ("5", "add", '{"a":1}', "4", 9), (None, "add", '{"a":1}', None, 9), ("6", "add", '{"a":1}', None, 9), ("6", "add", '{"a":1}', None, 9),
    ]
    results = [("1", "é \"q\"\n", "n"), ("3", "r", "n"), ("3", "s", "n"), ("9", "lost", "n"), (None, "none", "n")]
    got = link_tool_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS).collect()
    by = {(r.call_id, r.status): r for r in got}
    assert len(got) == 9 and sum(r.status == "no_identifier" for r in got) == 2
    assert by["1", "answered"].record == (
        '{"arguments":{"a":1,"b":2},"call_id":"1","content":"é \\"q\\"\\n","errors":[],"level":0,"name":"add","status":"answered","valid":true}'
    )
    assert by["2", "unanswered"].level == 1 and by["2", "unanswered"].valid
    assert by["3", "answered"].errors == "calls differ; results differ" and by["3", "answered"].level == 2
    assert by["4", "cyclic"].errors == "unknown tool" and by["5", "cyclic"].level is None
    assert by["6", "unanswered"].n_calls == 2 and by["6", "unanswered"].valid
    assert by["9", "orphan_result"].n_calls == 0 and not by["9", "orphan_result"].valid
    for r in got:
        assert json.dumps(json.loads(r.record), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r.record


def test_chat(spark):
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 3, "user", ""), (1, 4, "user", None), (1, 5, "assistant", "b"),
        (1, 6, "assistant", "c"), (2, 0, "assistant", "first"), (2, 7, "robot", "x"), (None, 1, "user", "n"), (3, None, None, "m"), (3, 1, "user", "z" * 90_000),
    ]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, level int")
    got = format_chat(frame).collect()
    by = {r.call_id: r for r in got if r.call_id}
    assert [(by[f"1:{t}"].status, by[f"1:{t}"].level) for t in (0, 1, 3, 4)] == [("unanswered", 0), ("answered", 1), ("unanswered", 2), ("answered", 3)]
    assert by["1:3"].errors == "text: beyond the minLength" and by["1:4"].errors == "text: missing"
    assert by["1:5"].status == by["2:-1"].status == "orphan_result" and by["2:7"].errors == "unknown tool"
    assert sum(r.status == "no_identifier" for r in got) == 2 and by["3:1"].valid
    assert format_chat(frame.limit(0)).count() == 0


def test_a_long_conversation(spark):
    frame = spark.range(300).selectExpr("7L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "'t' AS text")
    got = {r.call_id: r.level for r in format_chat(frame).collect()}
    assert got == {f"7:{t}": t // 2 for t in range(0, 300, 2)}
