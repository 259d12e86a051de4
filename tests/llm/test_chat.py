"""Linking, order, validation and canonical JSON of tool calls."""

import json
import random

from pyspark.sql import functions as F

from tillstream.llm import chat

TOOLS = {
    "add": {"properties": {"a": {"type": "number"}, "b": {"type": "number"}, "note": {"type": "string"}}, "required": ["a", "b"]},
    "find": {"properties": {"q": {"type": "string"}, "tags": {"type": "array"}, "deep": {"type": "boolean"}, "opt": {"type": "object"}}, "required": ["q"], "additionalProperties": True},
}
CALLS = "conv_id long, turn long, call_id string, name string, arguments string, after string, status string"
RESULTS = "conv_id long, turn long, call_id string, content string, step string"


def test_linking_and_status(spark):
    calls = [(1, 0, "a", "add", '{"b": 2, "a": 1.5}', None), (1, 2, "b", "find", '{"q":"x"}', "a"), (1, 4, "c", "find", '{"q":"x"}', "b"), (1, 5, None, "find", "{}", None),
             (2, 0, "x", "add", "{}", "y"), (2, 1, "y", "add", "{}", "x"), (2, 2, "z", "add", "{}", "x"), (3, 0, "own", "find", '{"q":"1"}', "own"), (4, 0, "p", "add", None, "nowhere"),
             (1, 2, "b", "find", '{"q":"x"}', "a")]
    results = [(1, 1, "a", "3.5"), (1, 3, "b", None), (1, 6, "b", "again"), (1, 7, "gone", "?"), (1, 8, None, "?"), (2, 9, "z", "cyclic")]
    found = chat.linked(spark.createDataFrame([(*r, "s") for r in calls], CALLS), spark.createDataFrame([(*r, "s") for r in results], RESULTS), TOOLS).collect()
    assert len(found) == len(calls) + len(results)
    seen = sorted(((r.conv_id, r.turn, r.role, r.call_id, r.status, r.step) for r in found), key=repr)
    want = [(1, 0, "call", "a", "linked", 0), (1, 1, "result", "a", "linked", 1), (1, 2, "call", "b", "linked", 2), (1, 2, "call", "b", "linked", 2),
            (1, 3, "result", "b", "linked", 3), (1, 6, "result", "b", "linked", 3), (1, 4, "call", "c", "unanswered", 4), (1, 5, "call", None, "unanswered", None),
            (1, 7, "result", "gone", "orphan", None), (1, 8, "result", None, "orphan", None), (2, 0, "call", "x", "cycle", None), (2, 1, "call", "y", "cycle", None),
            (2, 2, "call", "z", "cycle", None), (2, 9, "result", "z", "cycle", None), (3, 0, "call", "own", "cycle", None), (4, 0, "call", "p", "unanswered", 0)]
    assert seen == sorted(want, key=repr)
    first = next(r for r in found if r.call_id == "a" and r.role == "call")
    assert first.message == '{"arguments":{"a":1.5,"b":2},"id":"a","name":"add","role":"call"}'


def test_errors(spark):
    cases = {'{"a":1,"b":2.5}': "", '{"a":1}': "missing b", '{"a":"1","b":2,"z":0,"c":1}': "type of a; surplus c; surplus z", "[1]": "no JSON object", "{": "no JSON object",
             "": "no JSON object", '{"a":1,"b":2,"note":null}': "type of note", '{"a":1e400,"b":1}': None}
    rows = [("add", k) for k in cases] + [("find", '{"q":"","tags":[1],"deep":true,"opt":{},"more":1}'), ("find", '{"q":1,"tags":"","deep":0,"opt":[]}'), ("gone", "{}"), ("add", None), (None, "{}")]
    table = spark.createDataFrame(rows, "name string, arguments string")
    found = table.select("name", "arguments", F.array_join(chat.argument_errors(TOOLS, F.col("name"), F.col("arguments")), "; ").alias("e")).collect()
    got = {(r.name, r.arguments): r.e for r in found}
    for text, error in cases.items():
        assert error is None or got["add", text] == error
    assert got["find", rows[-5][1]] == ""
    assert got["find", rows[-4][1]] == "type of deep; type of opt; type of q; type of tags"
    assert got["gone", "{}"] == got[None, "{}"] == "unknown tool"
    assert got["add", None] == "no JSON object"


def test_canonical_json(spark):
    rng = random.Random(4)
    values = ["é\n\"\\/", "", 0, -5, 12345678901, True, None, [], {}, [1, {"b": 1, "a": [2]}], {"z": 1, "a": {"y": "", "b": 2}}]
    rows = []
    for k in range(200):
        keys = [f"{rng.choice('zyxabc')}{i}" for i in range(rng.randint(0, 6))]
        rows.append((1, k, f"i{k}", "find", json.dumps({n: rng.choice(values) for n in keys}, indent=rng.choice([None, 2])), None))
    table = spark.createDataFrame([(*r, "s") for r in rows], CALLS)
    none = spark.createDataFrame([], RESULTS)
    for r in chat.linked(table, none, TOOLS).collect():
        own = json.loads(rows[r.turn][4])
        want = {"arguments": own, "id": r.call_id, "name": "find", "role": "call"}
        assert r.message == json.dumps(want, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_depths_of_a_long_chain(spark):
    calls = spark.range(3000).selectExpr("1L AS conv_id", "concat('n', id) AS call_id", "concat('n', id - 1) AS after")
    assert {r.call_id: r.depth for r in chat.depths(calls).collect()} == {f"n{k}": k for k in range(3000)}


def test_same_identifiers_in_other_conversations(spark):
    """A call of one conversation is not answered by a result of another one, nor comes after its calls."""
    calls = [(1, 0, "a", "find", "{}", None), (1, 2, "b", "find", "{}", "a"), (2, 0, "a", "find", "{}", "b"), (None, 0, "a", "find", "{}", None), (None, 2, "b", "find", "{}", "a")]
    results = [(1, 1, "a", "x"), (2, 3, "b", "x"), (None, 1, "a", "x")]
    found = chat.linked(spark.createDataFrame([(*r, "s") for r in calls], CALLS), spark.createDataFrame([(*r, "s") for r in results], RESULTS), TOOLS).collect()
    assert sorted(((r.conv_id, r.role, r.call_id, r.status, r.step) for r in found), key=repr) == sorted([
        (1, "call", "a", "linked", 0), (1, "call", "b", "unanswered", 2), (2, "call", "a", "unanswered", 0), (None, "call", "a", "linked", 0), (None, "call", "b", "unanswered", 2),
        (1, "result", "a", "linked", 1), (2, "result", "b", "orphan", None), (None, "result", "a", "linked", 1)], key=repr)


def plain_depths(rows):
    """Longest way to each call, or None in and behind cycles."""
    before = {}
    for conv, call, after in rows:
        if call is not None:
            before.setdefault((conv, call), set()).update((conv, a) for a in after or ())
    before = {c: {a for a in own if a in before} for c, own in before.items()}
    out, left = {}, dict(before)
    while ready := [c for c, own in left.items() if own <= out.keys()]:
        for c in ready:
            out[c] = max((out[a] + 1 for a in left[c]), default=0)
        left = {c: own for c, own in left.items() if c not in out}
    return {c: out.get(c) for c in before}


def test_several_predecessors(spark):
    """Random graphs with chains, joints, repeated calls that name other predecessors, and cycles, against plain Python."""
    rng = random.Random(9)
    rows = [(c, f"n{k}", [f"n{j}" for j in rng.sample(range(k), min(k, rng.choice([0, 1, 1, 1, 2, 3])))]) for c in (1, 2, None) for k in range(60)]
    rows += [(1, "n5", ["n3"]), (1, "n5", ["n4", None]), (1, "n7", None), (1, None, ["n1"]), (2, "n30", ["n50"]), (3, "x", ["x"]), (3, "y", ["x", "z"]), (3, "z", []), (3, "w", ["z", "y"])]
    calls = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, call_id string, after array<string>, up int")
    assert {(r.conv_id, r.call_id): r.depth for r in chat.depths(calls).collect()} == plain_depths(rows)


def test_odd_conversations(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", None), (1, 2, "assistant", ""), (1, 3, "user", "q" * 100_000), (1, 3, "user", "twice"), (2, 0, "assistant", "first"),
            (None, 0, "user", "x"), (3, None, "user", "x"), (3, 0, None, "x"), (3, 1, "tool", "x")]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, status int")
    found = chat.of_conversations(turns).collect()
    assert len(found) == len(rows)
    by = {(r.conv_id, r.turn, r.role): (r.status, r.step, r.errors) for r in found}
    assert by[1, 1, "call"] == ("linked", 0, "missing prompt")
    assert by[1, 2, "result"] == ("linked", 1, "")
    assert by[1, 3, "call"] == ("unanswered", 2, "")
    assert by[2, 0, "result"] == ("orphan", None, "")
    assert by[3, None, "call"][:2] == by[None, 0, "call"][:2] == ("unanswered", None)
    assert by[1, 0, "system"] == by[3, 0, None] == by[3, 1, "tool"] == ("plain", -1, "")
    assert chat.of_conversations(turns.where("false")).count() == 0
