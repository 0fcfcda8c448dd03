import json
import random
import time

import pytest

from corpusloom.llm import toolcalls as T

SCHEMAS = {**T.SCHEMAS, "add": {"type": "object", "required": ["a", "b"], "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": ["number", "string"]}, "m": {"enum": ["x", "y"]}, "l": {"type": "array", "items": {"type": "string", "maxLength": 2}}}}}


def call(*calls):
    return json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})


def test_linking(spark):
    rows = [
        (1, 0, "user", "tanya \"ini\"\n", 0), (1, 1, "assistant", "jawab é", 0), (1, 2, "user", "", 0), (2, 0, "system", "s", 0), (2, 1, "assistant", "tanpa tanya", 0),
        (3, 0, "assistant", call(("c1", "add", {"b": 2, "a": 1}), ("c2", "add", '{"a": {"$ref": "c1"}, "b": "z"}'), ("c3", "add", {"a": -1, "l": ["abc"]}), (None, "no", 5)), 0),
        (3, 1, "tool", json.dumps({"tool_call_id": "c1", "content": {"z": 1, "a": [1]}}), 0), (3, 2, "tool", json.dumps({"tool_call_id": "c1", "content": "lagi"}), 0), (3, 3, "tool", json.dumps({"tool_call_id": "c9", "content": None}), 0),
        (4, 0, "assistant", call(("f1", "add", {"a": {"$ref": "f2"}, "b": 1}), ("f2", "add", {"a": {"$ref": "f3"}, "b": 1}), ("f3", "add", {"a": 1, "b": 1})), 0),
        (5, 0, "assistant", call(("k1", "add", {"a": {"$ref": "k2"}, "b": 1}), ("k2", "add", {"a": {"$ref": "k1"}, "b": 1}), ("k3", "add", {"a": {"$ref": "gone"}, "b": 1}), ("k3", "add", {"a": 1, "b": 1})), 0),
        (None, 0, "user", "x", 0), (6, None, "user", None, 0), (7, 0, None, "{broken", 0),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, id int")
    out = T.linked(df, SCHEMAS).collect()
    by = {(r["id"], r["kind"], r["turn"], r["index"]): r for r in out}
    assert by["1:0", "call", 0, 0]["record"] == T.canonical({"arguments": {"prompt": 'tanya "ini"\n'}, "id": "1:0", "tool": "respond", "result": "jawab é"})
    assert by["1:2", "call", 2, 0]["error"] == "$.prompt: minLength" and by["1:2", "call", 2, 0]["result_turn"] is None
    assert by["2:0", "orphan", 1, 0]["error"] == "no call"
    assert json.loads(by["c1", "call", 0, 0]["record"])["result"] == {"z": 1, "a": [1]} and '"result":{"a":[1],"z":1}' in by["c1", "call", 0, 0]["record"]
    assert by["c1", "orphan", 2, 0]["error"] == "repeated result" and by["c9", "orphan", 3, 0]["error"] == "no call"
    assert by["c2", "call", 0, 1]["valid"] and by["c2", "call", 0, 1]["level"] == 0
    assert by["c3", "call", 0, 2]["error"] == "$.b: missing; $.a: minimum; $.l[0]: maxLength"
    assert by[None, "call", 0, 3]["error"] == "no id"
    assert [by[f"f{i}", "call", 0, i - 1]["level"] for i in (1, 2, 3)] == [2, 1, 0]
    assert by["k1", "call", 0, 0]["error"] == by["k2", "call", 0, 1]["error"] == "cycle"
    assert sorted(r["error"] for r in out if r["id"] == "k3") == ["repeated id", "unresolved gone"]
    assert sum(r["kind"] == "message" for r in out) == 4
    assert len(out) == 20


@pytest.mark.parametrize(
    ("value", "schema", "wrong"),
    [
        ({"a": 1.0, "b": "x"}, SCHEMAS["add"], []), ({"a": True, "b": 1}, SCHEMAS["add"], ["$.a: not integer"]), (5, SCHEMAS["add"], ["$: not object"]), ({"a": 1, "b": 1, "m": "z"}, SCHEMAS["add"], ["$.m: not in enum"]),
        ({"prompt": "x", "y": 1}, T.SCHEMAS["respond"], ["$.y: unknown"]), ({"$ref": "x"}, SCHEMAS["add"], []),
    ],
)
def test_validation(value, schema, wrong):
    assert T.violations(value, schema) == wrong


def test_canonical():
    assert T.canonical({"b": [1, {"z": None, "é": 'q"'}], "a": 1.5}) == '{"a":1.5,"b":[1,{"z":null,"é":"q\\""}]}'


def test_identifiers_belong_to_their_conversation(spark):
    log = [(c, 0, "assistant", call(("c0", "add", {"a": c or 9, "b": {"$ref": "c1"}}), ("c1", "add", {"a": 1, "b": 1}))) for c in (1, 2, None)]
    log += [(c, 1, "tool", json.dumps({"tool_call_id": "c0", "content": c})) for c in (1, 2, None)]
    out = T.linked(spark.createDataFrame(log, "conv_id long, turn long, role string, text string"), SCHEMAS).collect()
    assert len(out) == 6 and all(r["valid"] for r in out)
    got = {r["conv_id"]: json.loads(r["record"]) for r in out if r["id"] == "c0"}
    assert {c: (r["arguments"]["a"], r["result"]) for c, r in got.items()} == {1: (1, 1), 2: (2, 2), None: (9, None)}
    assert {r["level"] for r in out if r["id"] == "c0"} == {1}


def test_what_a_real_log_holds(spark):
    deep = "[" * 2_000 + "]" * 2_000
    bad = [
        '{"tool_calls": [{"id": "a", "name": [], "arguments": {}}, {"id": {"x": 1}, "name": {"n": 2}, "arguments": 1}, 5]}',
        '{"tool_calls": [{"id": "s\\ud800", "name": "\\udfff", "arguments": {"\\ud800": "\\udc00"}}]}',
        '{"tool_call_id": ["r"], "content": "\\ud83d"}',
        '{"tool_calls": [{"id": "d", "name": "add", "arguments": ' + deep + "}]}",
        '{"tool_calls": [{"id": "n", "name": "add", "arguments": [NaN, Infinity]}]}', '{"tool_call_id": "x", "content": 1e999}',
        '{"tool_calls": [{"id": "t", "name": "add", "arguments": "[NaN]"}, {"id": "i", "name": "add", "arguments": {"a": {"$ref": ["q"]}, "b": 1' + "0" * 5_000 + "}}]}",
        '{"tool_calls": [{"id": "q", "name": "add", "arguments": {"a": {"$ref": ["q"]}, "b": 1}}]}', '{"tool_calls": {}}', "{", "{}", '{"tool_call_id": null}',
    ]
    text = [(9, i, "system", t, "x", 1) for i, t in enumerate(bad)] + [(10, 0, "user", "kata " * 400_000, "x", 1)]
    out = T.linked(spark.createDataFrame(text, "conv_id long, turn long, role string, text string, id string, kind int"), SCHEMAS).collect()
    by = {(r["turn"], r["index"]): r for r in out if r["conv_id"] == 9}
    assert [by[0, i]["id"] for i in range(3)] == ["a", '{"x":1}', None]
    assert [by[0, i]["error"] for i in range(3)] == ["unknown tool []", 'unknown tool {"n":2}', "no id"]
    assert by[1, 0]["id"] == "s\\ud800" and by[1, 0]["error"] == "unknown tool \\udfff"
    assert json.loads(by[1, 0]["record"])["arguments"] == {"\ud800": "\udc00"}
    assert by[2, 0]["id"] == '["r"]' and by[2, 0]["kind"] == "orphan"
    assert {by[t, 0]["kind"] for t in (3, 4, 5, 6, 8, 9, 10, 11)} == {"message"}  # 6: a number of 5,001 digits
    assert by[7, 0]["error"] == 'unresolved ["q"]'
    assert all(json.loads(r["record"]) for r in out)
    assert len([r for r in out if r["conv_id"] == 10][0]["record"]) > 2_000_000


def test_the_query_has_levels_and_errors_of_every_kind(spark):
    out = T.query(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")).collect()
    assert {r["level"] for r in out} == {0, 1, 2, 3}
    assert {e for r in out if r["error"] for e in r["error"].split("; ")} >= {"cycle", "no call", "repeated result", "$.limit: maximum", "unresolved t2", "unresolved t4"}


def test_empty_table(spark):
    assert T.query(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def chain(conv, n):
    return (conv, 0, "assistant", call(*[(f"c{i}", "add", {"a": {"$ref": f"c{i + 1}"} if i + 1 < n else 1, "b": 1}) for i in range(n)]))


LOG = "conv_id long, turn long, role string, text string"


def test_long_chains_take_no_more_rounds_than_short_ones(spark):
    def taken(n):
        began = time.time()
        rows = T.linked(spark.createDataFrame([chain(1, n), chain(2, 3)], LOG), SCHEMAS).collect()
        assert {r["id"]: r["level"] for r in rows if r["conv_id"] == 1} == {f"c{i}": n - 1 - i for i in range(n)}
        return time.time() - began

    taken(20)
    assert taken(1000) < 3 * taken(20) + 2


def test_both_orders_of_a_conversation_agree(spark):
    rng = random.Random(3)
    rows = [(c, 0, "assistant", call(*[(f"c{i}", "add", {"a": {"$ref": f"c{rng.randrange(n)}"}, "b": {"$ref": f"c{min(n - 1, i + rng.randrange(1, 4))}"} if rng.random() < 0.7 else 1}) for i in range(n)])) for c, n in enumerate([2, 3, 5, 8, 8, 12])]
    df = spark.createDataFrame([*rows, chain(9, 6)], LOG)
    one, many = ({(r["conv_id"], r["id"]): (r["level"], r["error"]) for r in T.linked(df, SCHEMAS, whole=w).collect()} for w in (T.WHOLE, 4))
    assert one == many and {e for _, e in one.values()} >= {None, "cycle"}


def test_depth_is_a_parameter(spark):
    deep = '{"tool_calls": [{"id": "d", "name": "add", "arguments": {"a": 1, "b": 1, "l": ' + "[" * 150 + "]" * 150 + "}}]}"
    df = spark.createDataFrame([(1, 0, "assistant", deep)], LOG)
    assert [T.linked(df, SCHEMAS, depth=d).first()["kind"] for d in (100, 200)] == ["orphan", "call"]
