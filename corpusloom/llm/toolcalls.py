"""Tool-call linking: join, order, validate and serialise calls and results.

A message holds calls and results as JSON, or is plain text:

* ``{"tool_calls": [{"id", "name", "arguments"}, ...]}`` makes calls; arguments
  may be an object or a JSON string of one. A value ``{"$ref": id}`` anywhere in
  them makes the call depend on the call of that identifier.
* ``{"tool_call_id", "content"}`` is a result.
* A plain turn of ``user`` calls the tool ``respond`` with the turn's text as
  ``prompt``; the plain turn of ``assistant`` that follows is its result. Their
  identifier is the conversation and the user's turn.
* Anything else is a message, kept but not linked.

Identifiers and references hold inside their conversation; null conversations
are one of their own. An identifier, name or reference that is no string goes
by its canonical JSON. Text that is no JSON, holds NaN, Infinity or a number
beyond a double, or nests deeper than ``DEPTH``, is plain. Lone surrogates,
which no UTF-8 text can hold, come back as escapes.

Calls and results meet in a hash join on the identifier; nothing gathers a
conversation. Dependencies on earlier calls need no work, as order of
appearance is topological for them; only calls that refer forward are raised,
level by level, until nothing changes or a cycle is left.
"""

from __future__ import annotations

import json
import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.components import connected_components
from corpusloom.storage import stored

#: Schemas of the tools that calls may name: a subset of JSON Schema.
SCHEMAS = {
    "respond": {
        "type": "object",
        "required": ["prompt"],
        "properties": {"prompt": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "maximum": 160}, "after": {"type": "object"}},
        "additionalProperties": False,
    }
}
KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
#: Nesting that is read as JSON.
DEPTH = 100
#: References of a conversation that a task orders at once.
WHOLE = 200_000
LONE = re.compile("[\ud800-\udfff]")


def escaped(text: str) -> str:
    """Text that UTF-8 can hold: lone surrogates as escapes."""
    return LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value) -> str:
    """JSON with sorted keys, no spaces, and no escapes but those JSON demands."""
    return escaped(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def named(value) -> str:
    """An identifier or name as text."""
    return escaped(value) if isinstance(value, str) else canonical(value)


def _is(value, kind: str) -> bool:
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    if kind == "integer":
        return isinstance(value, int) and not isinstance(value, bool) or isinstance(value, float) and value.is_integer()
    return isinstance(value, KINDS[kind])


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """What is wrong with a value, in a fixed order. A reference stands for any value."""
    if isinstance(value, dict) and set(value) == {"$ref"}:
        return []
    out, kinds = [], schema.get("type")
    if kinds is not None and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{at}: not {kinds}"]
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        out.append(f"{at}: not in enum")
    if isinstance(value, str):
        out += [f"{at}: {n}" for n, bad in (("minLength", len(value) < schema.get("minLength", 0)), ("maxLength", len(value) > schema.get("maxLength", len(value)))) if bad]
    if _is(value, "number"):
        out += [f"{at}: {n}" for n, bad in (("minimum", value < schema.get("minimum", value)), ("maximum", value > schema.get("maximum", value))) if bad]
    if isinstance(value, list):
        for i, x in enumerate(value):
            out += violations(x, schema.get("items", {}), f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{escaped(k)}: missing" for k in sorted(schema.get("required", [])) if k not in value]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{at}.{escaped(k)}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{at}.{escaped(k)}: unknown")
    return out


def _references(value) -> list[str]:
    if isinstance(value, dict):
        if set(value) == {"$ref"}:
            return [named(value["$ref"])]
        return [r for v in value.values() for r in _references(v)]
    return [r for v in value for r in _references(v)] if isinstance(value, list) else []


def _finite(text: str) -> float:
    if not math.isfinite(number := float(text)):
        raise ValueError(text)
    return number


def _load(text: str, depth: int = DEPTH):
    """The value, None if it is no JSON or nests deeper."""
    try:
        value = json.loads(text, parse_constant=_finite, parse_float=_finite)
    except (ValueError, RecursionError):
        return None
    layer = [value]
    for _ in range(depth):
        layer = [x for v in layer if isinstance(v, (dict, list)) for x in (v.values() if isinstance(v, dict) else v)]
        if not layer:
            return value
    return None


def items(conv: int | None, turn: int | None, role: str | None, text: str | None, schemas: dict, depth: int = DEPTH) -> list[tuple]:
    """(kind, index, id, tool, arguments, result, references, error) of a message."""
    text = text or ""
    found = _load(text, depth) if text[:1] == "{" else None
    if isinstance(found, dict) and isinstance(found.get("tool_calls"), list):
        out = []
        for i, c in enumerate(found["tool_calls"]):
            c = c if isinstance(c, dict) else {}
            args, name, ident = c.get("arguments"), c.get("name"), c.get("id")
            args = _load(args, depth) if isinstance(args, str) else args
            known = isinstance(name, str) and name in schemas
            wrong = violations(args, schemas[name]) if known else [f"unknown tool {named(name)}"]
            out.append(("call", i, None if ident is None else named(ident), None if name is None else named(name), canonical(args), None, sorted(set(_references(args))), "; ".join(wrong) or None))
        return out
    if isinstance(found, dict) and found.get("tool_call_id") is not None:
        return [("result", 0, named(found["tool_call_id"]), None, None, canonical(found.get("content")), [], None)]
    if conv is not None and turn is not None and role == "user":
        args = {"prompt": text}
        return [("call", 0, f"{conv}:{turn}", "respond", canonical(args), None, [], "; ".join(violations(args, schemas.get("respond", {}))) or None)]
    if conv is not None and turn is not None and role == "assistant":
        return [("result", 0, f"{conv}:{turn - 1}", None, None, canonical(text), [], None)]
    return [("message", 0, None, None, None, canonical(text), [], None)]


def scoped(ident: Column) -> Column:
    """An identifier with its conversation."""
    return F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), F.lit(":"), ident)


def parsed(messages: DataFrame, schemas: dict = SCHEMAS, depth: int = DEPTH) -> DataFrame:
    """One row for every call, result or message; what nests deeper than ``depth`` is a message."""
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    shape = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("kind", pa.string()), ("index", pa.int32()), ("id", pa.string()), ("tool", pa.string()), ("arguments", pa.string()), ("result", pa.string()), ("refs", pa.list_(pa.string())), ("error", pa.string())])

    def run(batches):
        for b in batches:
            out = [(c, t, *i) for c, t, r, x in zip(*(b.column(j).to_pylist() for j in range(4)), strict=True) for i in items(c, t, r, x, schemas, depth)]
            cols = zip(*out, strict=True) if out else [()] * len(shape)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, shape, strict=True)], schema=shape)

    return rows.mapInArrow(run, "conv_id bigint, turn bigint, kind string, index int, id string, tool string, arguments string, result string, refs array<string>, error string")


def ordered(edges: list[tuple[str, str, bool]]) -> list[tuple[str, int, bool]]:
    """(id, level, whether it is in a cycle or waits for one) for the references (id, to, forward) of whole groups, in time of their number."""
    root: dict[str, str] = {}
    waits: dict[str, list[tuple[str, bool]]] = {}
    left: dict[str, int] = {}

    def find(x: str) -> str:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for one, to, forward in edges:
        for x in (one, to):
            if x not in root:
                root[x], left[x] = x, 0
        root[find(one)] = find(to)
        waits.setdefault(to, []).append((one, forward))
        left[one] += 1
    level, ready = dict.fromkeys(root, 0), [x for x, n in left.items() if not n]
    while ready:
        to = ready.pop()
        for one, forward in waits.get(to, ()):
            level[one] = max(level[one], level[to] + forward)
            left[one] -= 1
            if not left[one]:
                ready.append(one)
    most: dict[str, int] = {}
    for one, _, forward in edges:
        most[find(one)] = most.get(find(one), 0) + forward
    return [(x, most[find(x)] + 1 if left[x] else level[x], left[x] > 0) for x in root]


def _whole_scopes(ends: DataFrame) -> DataFrame:
    """(id, l, cycle) for the references (scope, id, to, forward) of scopes that a task can hold, one scope after another."""
    rows = ends.select("scope", "id", "to", "forward").repartition("scope").sortWithinPartitions("scope")

    def run(batches):
        now, edges = None, []

        def batch(found):
            cols = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.int32(), pa.bool_()))]
            return pa.RecordBatch.from_arrays(cols, names=["id", "l", "cycle"])

        for b in batches:
            out = []
            for scope, *edge in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if scope != now:
                    out += ordered(edges)
                    now, edges = scope, []
                edges.append(tuple(edge))
            yield batch(out)
        yield batch(ordered(edges))

    return rows.mapInArrow(run, "id string, l int, cycle boolean")


def _by_rounds(ends: DataFrame) -> DataFrame:
    """The same for scopes of any size: each round raises the levels of calls by those of what they refer to.

    No level of a group without a cycle is above its number of forward
    references, so what rises beyond is in a cycle or waits for one, and the
    rounds end.
    """
    groups = connected_components(ends.select(F.xxhash64("id").alias("a"), F.xxhash64("to").alias("b")))
    ends = ends.join(groups, F.xxhash64(ends["id"]) == groups["node"]).drop("node")
    most = ends.where("forward").groupBy("root").agg(F.count(F.lit(1)).cast("int").alias("most"))
    ends = stored(ends.join(most, "root"))
    both = ends.select("id", "most").union(ends.select("to", "most")).distinct()
    level = stored(both.select("id", "most", F.lit(0).alias("level")))
    raised = True
    while raised:
        up = ends.join(level.select(F.col("id").alias("to"), F.col("level").alias("l")), "to")
        up = up.groupBy("id").agg(F.max(F.col("l") + F.col("forward").cast("int")).alias("up"))
        now = F.greatest("level", F.least(F.coalesce("up", F.lit(0)), F.col("most") + 1))
        new = stored(level.join(up, "id", "left").select("id", "most", now.alias("level"), (now > F.col("level")).alias("raised")))
        raised = not new.where("raised").isEmpty()
        level = new.drop("raised")
    return level.select("id", F.col("level").alias("l"), (F.col("level") > F.col("most")).alias("cycle"))


def levels(calls: DataFrame, whole: int = WHOLE) -> DataFrame:
    """(id, level, broken) of calls (id, scope, at, refs: structs of id and name): broken names a reference without a call, or a cycle.

    Level 0 for calls that refer to earlier ones only; a call that refers
    forward is one above what it refers to. References don't leave their scope,
    a conversation: one of ``whole`` references at most is ordered in a task,
    in time of their number however long the chains; larger ones in rounds.
    """
    refs = calls.select("id", "scope", "at", F.explode("refs").alias("r")).select("id", "scope", "at", F.col("r.id").alias("to"), "r.name")
    ends = refs.join(calls.select(F.col("id").alias("to"), F.col("at").alias("to_at")), "to", "left")
    missing = ends.where("to_at IS NULL").groupBy("id").agg(F.concat(F.lit("unresolved "), F.min("name")).alias("broken"))
    ends = stored(ends.where("to_at IS NOT NULL").select("scope", "id", "to", (F.col("to_at") >= F.col("at")).alias("forward")))
    sizes = ends.groupBy("scope").agg(F.count(F.lit(1)).alias("n"), F.bool_or("forward").alias("any")).where("any")
    ends = stored(ends.join(sizes, "scope"))
    level = _whole_scopes(ends.where(F.col("n") <= whole))
    large = ends.where(F.col("n") > whole)
    if not large.isEmpty():
        level = level.unionByName(_by_rounds(large.select("id", "to", "forward")))
    out = calls.select("id").join(missing, "id", "left").join(level, "id", "left")
    return out.select("id", F.coalesce("l", F.lit(0)).alias("level"), F.coalesce("broken", F.when(F.col("cycle"), "cycle")).alias("broken"))


def linked(messages: DataFrame, schemas: dict = SCHEMAS, depth: int = DEPTH, whole: int = WHOLE) -> DataFrame:
    """(conv_id, turn, index, kind, id, tool, level, result_turn, valid, error, record): every call, result and message.

    A call's record has its arguments and the earliest result of its
    identifier in its conversation (null if none). Later results of it, and
    results without a call, come back as ``orphan``. Of calls with one
    identifier the earliest is linked, the others are errors. Null or empty
    texts are plain ones; rows with a null conversation or turn are messages,
    unless JSON names them. Sorting by (conv_id, level, turn, index) is a
    topological order. Repeated rows are calls or results with one identifier,
    one of which is linked. Texts of any length are read whole. Columns beside
    the four don't matter, whatever their names. An empty table gives no rows.
    """
    refs = F.transform("refs", lambda r: F.struct(scoped(r).alias("id"), r.alias("name")))
    rows = parsed(messages, schemas, depth).withColumns({"at": F.struct("turn", "index"), "row": F.monotonically_increasing_id(), "sid": scoped(F.col("id")), "refs": refs})
    rows = stored(rows)
    ident = F.col("id").isNotNull()
    first = rows.where(ident & (F.col("kind") != "message")).groupBy("kind", "sid").agg(F.min(F.struct("at", "row")).alias("f"))
    first = first.select(F.col("kind").alias("k"), F.col("sid").alias("i"), F.col("f.row").alias("first"))
    bare = rows.where(~ident).withColumn("lead", F.lit(False))  # rows without an identifier never meet in a join
    rows = rows.where(ident).join(first, (rows["kind"] == first["k"]) & (rows["sid"] == first["i"]), "left").drop("k", "i")
    rows = stored(rows.withColumn("lead", F.coalesce(F.col("row") == F.col("first"), F.lit(False))).drop("first"))
    calls = rows.where((F.col("kind") == "call") & F.col("lead"))
    results = rows.where((F.col("kind") == "result") & F.col("lead"))
    order = levels(calls.select(F.col("sid").alias("id"), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("scope"), "at", "refs"), whole).withColumnRenamed("id", "sid")
    answers = results.select("sid", F.col("turn").alias("result_turn"), F.col("result").alias("answer"))
    full = calls.drop("result").join(answers, "sid", "left").join(order, "sid", "left")
    text = lambda c: F.when(F.col(c).isNull(), "null").otherwise(F.expr(f"substring(to_json(struct({c} AS v)), 6, char_length(to_json(struct({c} AS v))) - 6)"))
    record = F.concat(F.lit('{"arguments":'), F.col("arguments"), F.lit(',"id":'), text("id"), F.lit(',"result":'), F.coalesce("answer", F.lit("null")), F.lit(',"tool":'), text("tool"), F.lit("}"))
    error = F.concat_ws("; ", "error", "broken")
    full = full.select("conv_id", "turn", "index", F.lit("call").alias("kind"), "id", "tool", F.coalesce("level", F.lit(0)).alias("level"), "result_turn", F.when(error != "", error).alias("error"), record.alias("record"))
    rest = rows.where(~((F.col("kind") == "call") & F.col("lead")))
    rest = rest.join(calls.select("sid", F.lit(True).alias("has_call")), "sid", "left").where(~((F.col("kind") == "result") & F.col("lead") & F.coalesce("has_call", F.lit(False)))).drop("has_call")
    rest = rest.unionByName(bare)
    why = F.when(F.col("kind") == "call", F.when(F.col("id").isNull(), "no id").otherwise("repeated id")).when(F.col("kind") == "result", F.when(F.col("lead"), "no call").otherwise("repeated result"))
    single = F.concat(F.lit('{"id":'), text("id"), F.lit(',"result":'), F.coalesce("result", F.lit("null")), F.lit("}"))
    rest = rest.select("conv_id", "turn", "index", F.when(F.col("kind") == "result", "orphan").otherwise(F.col("kind")).alias("kind"), "id", "tool", F.lit(0).alias("level"), F.lit(None).cast("long").alias("result_turn"), why.alias("error"), single.alias("record"))
    return full.unionByName(rest).withColumn("valid", F.col("error").isNull())


def as_log(turns: DataFrame) -> DataFrame:
    """Plain turns as a log of calls and results in JSON.

    A user's turn calls ``respond``. Of a conversation's users' turns the first
    and second refer forward to the next, the fourth back to the third, and the
    third back to the second where the conversation divides by three. An
    assistant's turn is the result for the turn before, but for the second,
    which repeats the first's call where the conversation divides by five, and
    the fourth, which answers a call that nobody made. Other roles, and turns
    without number, stay as they are.
    """
    turn, at = F.col("turn"), F.floor(F.col("turn") / 2)
    text = F.coalesce("text", F.lit(""))
    goal = F.when(at.isin(0, 1), turn + 2).when((at == 3) | ((at == 2) & (F.col("conv_id") % 3 == 0)), turn - 2)
    ident = lambda c: F.concat(F.lit("t"), c.cast("string"))
    after = F.when(goal.isNotNull(), F.struct(ident(goal).alias("$ref")))
    call = F.struct(ident(turn).alias("id"), F.lit("respond").alias("name"), F.struct(text.alias("prompt"), F.char_length(text).alias("limit"), after.alias("after")).alias("arguments"))
    call = F.to_json(F.struct(F.array(call).alias("tool_calls")))
    asked = F.when(at == 3, turn + 90).when((at == 1) & (F.col("conv_id") % 5 == 0), turn - 3).otherwise(turn - 1)
    result = F.to_json(F.struct(ident(asked).alias("tool_call_id"), F.struct(text.alias("text"), F.char_length(text).alias("chars")).alias("content")))
    known = F.col("conv_id").isNotNull() & turn.isNotNull()
    return turns.select("conv_id", "turn", "role", F.when(known & (F.col("role") == "user"), call).when(known & (F.col("role") == "assistant"), result).otherwise(F.col("text")).alias("text"))


def query(turns: DataFrame) -> DataFrame:
    return linked(as_log(turns)).select("conv_id", "turn", "kind", "id", "tool", "level", "result_turn", "valid", "error", F.sha2(F.col("record").cast("binary"), 256).alias("record_sha256"))


SQL = r"""
WITH RECURSIVE m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT *, 't' || turn AS id, CASE WHEN turn // 2 IN (0, 1) THEN turn + 2 WHEN turn // 2 = 3 OR (turn // 2 = 2 AND conv_id % 3 = 0) THEN turn - 2 END AS goal FROM m WHERE role = 'user'),
a AS (SELECT *, 't' || CASE WHEN turn // 2 = 3 THEN turn + 90 WHEN turn // 2 = 1 AND conv_id % 5 = 0 THEN turn - 3 ELSE turn - 1 END AS id FROM m WHERE role = 'assistant'),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, id ORDER BY turn) AS nth FROM a),
r AS (SELECT * FROM n WHERE nth = 1),
e AS (SELECT c.conv_id, c.turn, c.goal, (c.goal > c.turn)::INT AS up FROM c JOIN c d ON d.conv_id = c.conv_id AND d.turn = c.goal),
walk AS (
  SELECT conv_id, turn, turn AS at, 0 AS level, 0 AS steps FROM c
  UNION ALL
  SELECT w.conv_id, w.turn, e.goal, w.level + e.up, w.steps + 1 FROM walk w JOIN e ON e.conv_id = w.conv_id AND e.turn = w.at WHERE w.steps < 9),
far AS (SELECT conv_id, turn, max(level) AS level, max(steps) = 9 AS cycle FROM walk GROUP BY ALL),
most AS (SELECT conv_id, sum(up) AS most FROM e GROUP BY ALL),
linked AS (
  SELECT c.conv_id, c.turn, 'call' AS kind, c.id, 'respond' AS tool, CASE WHEN f.cycle THEN most + 1 ELSE f.level END::INTEGER AS level, r.turn AS result_turn,
         nullif(concat_ws('; ', CASE WHEN length(c.text) > 160 THEN '$.limit: maximum' END, CASE WHEN c.text = '' THEN '$.prompt: minLength' END,
                CASE WHEN f.cycle THEN 'cycle' WHEN c.goal IS NOT NULL AND e.goal IS NULL THEN 'unresolved t' || c.goal END), '') AS error,
         '{"arguments":{' || CASE WHEN c.goal IS NOT NULL THEN '"after":{"$ref":"t' || c.goal || '"},' ELSE '' END || '"limit":' || length(c.text) || ',"prompt":' || to_json(c.text)::VARCHAR
           || '},"id":"' || c.id || '","result":' || coalesce('{"chars":' || length(r.text) || ',"text":' || to_json(r.text)::VARCHAR || '}', 'null') || ',"tool":"respond"}' AS record
  FROM c JOIN far f USING (conv_id, turn) LEFT JOIN most USING (conv_id) LEFT JOIN e USING (conv_id, turn) LEFT JOIN r ON r.conv_id = c.conv_id AND r.id = c.id
  UNION ALL
  SELECT n.conv_id, n.turn, 'orphan', n.id, NULL, 0, NULL, CASE WHEN nth > 1 THEN 'repeated result' ELSE 'no call' END, '{"id":"' || n.id || '","result":{"chars":' || length(n.text) || ',"text":' || to_json(n.text)::VARCHAR || '}}'
  FROM n LEFT JOIN c ON c.conv_id = n.conv_id AND c.id = n.id WHERE c.id IS NULL OR nth > 1
  UNION ALL
  SELECT conv_id, turn, 'message', NULL, NULL, 0, NULL, NULL, '{"id":null,"result":' || to_json(text)::VARCHAR || '}'
  FROM m WHERE role NOT IN ('user', 'assistant'))
SELECT conv_id, turn, kind, id, tool, level, result_turn, (error IS NULL) AS valid, error, sha256(record) AS record_sha256 FROM linked
"""
