"""Tool-call linking for chat data, in DataFrame functions only.

Messages (conversation, turn, role, text) carry calls as JSON: an `assistant` text
``{"tool_calls": [{"id", "name", "arguments": {...}}]}`` and a `tool` text
``{"tool_call_id", "content"}``.

1. Calls and results are taken from the JSON and **hash-joined by (conversation, identifier)**. Results are
   reduced to one row an identifier before the join (the first by turn, and how many there were), so
   repeated identifiers cannot multiply rows.
2. **Topological order**: an argument whose whole value is ``"$<identifier>"`` refers to another call's
   result. Calls are peeled off in waves (those whose references are all resolved get the next
   level), checkpointed a wave; what is left when a wave is empty stands in a cycle. (level, turn,
   identifier) is a topological order; it is a pair of columns and not a position, so that no
   conversation is gathered in one task.
3. **Arguments are checked** against schemas (tool, field, type, required): malformed JSON, missing,
   unknown and wrongly typed fields, references to no call.
4. Each call is serialised with its result as **canonical JSON**: sorted keys, no white space.

Defined cases: messages with null or other text carry neither call nor result and are left out; a
null conversation is one conversation; a call without identifier is never answered; a result
without a call is a row of status `orphan`; repeated calls are rows each, with the same result; calls of
tools without a schema are `unknown tool`; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.session import checkpoint_dir


class Field(NamedTuple):
    tool: str
    field: str
    type: str          # string, integer, number, boolean, array or object
    required: bool


#: JSON type -> how Spark's variant types begin.
_TYPES = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DECIMAL|DOUBLE|FLOAT", "boolean": "BOOLEAN",
          "array": "ARRAY", "object": "OBJECT"}


def _object(text: Column) -> Column:
    """JSON text as an object, null if it is none."""
    v = F.try_parse_json(text)
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v)


def calls_of(messages: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """One row a call: conv, turn, call_id, name, args (JSON text as sent)."""
    rows = messages.where(F.col(role) == "assistant").select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), _object(F.col(text)).alias("v"))
    one = "struct<id: string, name: string, arguments: variant>"
    rows = rows.select("conv", "turn", F.explode(F.try_variant_get("v", "$.tool_calls", f"array<{one}>")).alias("c"))
    return rows.select("conv", "turn", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"),
                       F.col("c.arguments").alias("args"))


def results_of(messages: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
               text: str = "text") -> DataFrame:
    """One row an answered identifier: the first result by turn, and the number of results."""
    rows = messages.where(F.col(role) == "tool").select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), _object(F.col(text)).alias("v"))
    rows = rows.select("conv", "turn", F.try_variant_get("v", "$.tool_call_id", "string").alias("call_id"),
                       F.try_variant_get("v", "$.content", "string").alias("content")).where("call_id is not null")
    return rows.groupBy("conv", "call_id").agg(
        F.min(F.struct("turn", "content")).alias("first"), F.count(F.lit(1)).alias("n_results"))


def levels(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, call_id, level) of the calls that refer to others, and the references to no call.

    level is null in a cycle. Calls without references have level 0 and no row here."""
    checkpoint_dir(calls.sparkSession)
    nodes = calls.where("call_id is not null").select("conv", "call_id").distinct()
    refs = calls.where("call_id is not null").select(
        "conv", "call_id", F.explode(F.regexp_extract_all(F.to_json("args"), F.lit(r'[:\[,]"\$([^"\\]+)"'), F.lit(1))).alias("on")
        ).distinct().checkpoint()
    known = nodes.select(F.col("conv").alias("c"), F.col("call_id").alias("i"))
    match = refs["conv"].eqNullSafe(known["c"]) & (refs["on"] == known["i"])
    dangling = refs.join(known, match, "left_anti").select("conv", "call_id").distinct()
    left = refs.join(known, match, "left_semi").checkpoint()
    every = left.select("conv", "call_id").distinct().checkpoint()
    # Resolved by now: the calls that refer to none; from here on those of the wave before.
    waiting, waves, level = every, [], 0
    done = None
    while True:
        level += 1
        k = (waiting if done is None else done).select(F.col("conv").alias("c"), F.col("call_id").alias("i"))
        on = left["conv"].eqNullSafe(k["c"]) & (left["on"] == k["i"])
        left = left.join(k, on, "left_semi" if done is None else "left_anti").checkpoint()
        still = left.select("conv", "call_id").distinct()
        s = still.select(F.col("conv").alias("c"), F.col("call_id").alias("i"))
        done = waiting.join(s, waiting["conv"].eqNullSafe(s["c"]) & (waiting["call_id"] == s["i"]), "left_anti").checkpoint()
        if done.isEmpty():
            break
        waves.append(done.withColumn("level", F.lit(level)))
        waiting = still.checkpoint()
    out = waiting.withColumn("level", F.lit(None).cast("int"))
    for w in waves:
        out = out.unionByName(w)
    return out, dangling


def _errors(schemas: Sequence[Field]) -> Column:
    """Sorted list of what is wrong with (name, args)."""
    a = F.expr("cast(args as map<string, variant>)")
    rules = F.lit(None).cast("array<string>")
    for tool in dict.fromkeys(f.tool for f in schemas):
        own = [f for f in schemas if f.tool == tool]
        checks = []
        for f in own:
            got = F.schema_of_variant(F.try_element_at(a, F.lit(f.field)))
            absent = got.isNull() | (got == "VOID")
            checks.append(F.when(absent, F.lit(f"missing {f.field}") if f.required else F.lit(None).cast("string"))
                          .when(~got.rlike(f"^({_TYPES[f.type]})"), F.lit(f"type {f.field}")))
        unknown = F.transform(F.array_except(F.map_keys(a), F.array(*[F.lit(f.field) for f in own])),
                              lambda k: F.concat(F.lit("unknown "), k))
        rules = F.when(F.col("name") == tool, F.concat(F.array(*checks), unknown)).otherwise(rules)
    broken = F.when(F.col("args").isNull() | ~F.schema_of_variant("args").startswith("OBJECT"), F.array(F.lit("malformed")))
    return F.sort_array(F.array_compact(F.coalesce(broken, rules, F.array(F.lit("unknown tool")))))


def link(messages: DataFrame, schemas: Sequence[Field], **columns: str) -> DataFrame:
    """One row a call (and an orphan result): conv_id, call_id, level, turn, name, status, n_results,
    valid, errors, json."""
    checkpoint_dir(messages.sparkSession)
    calls, results = calls_of(messages, **columns), results_of(messages, **columns)
    order, dangling = levels(calls)
    r = results.withColumnsRenamed({"conv": "rc", "call_id": "ri"}).hint("shuffle_hash")
    both = calls.join(r, calls["conv"].eqNullSafe(r["rc"]) & (calls["call_id"] == r["ri"]), "left")
    o = order.withColumnsRenamed({"conv": "oc", "call_id": "oi"}).withColumn("ordered", F.lit(True))
    both = both.join(o, both["conv"].eqNullSafe(o["oc"]) & (both["call_id"] == o["oi"]), "left")
    d = dangling.select(F.col("conv").alias("dc"), F.col("call_id").alias("di"), F.lit("dangling reference").alias("loose"))
    both = both.join(d, both["conv"].eqNullSafe(d["dc"]) & (both["call_id"] == d["di"]), "left")
    cyclic = F.col("ordered") & F.col("level").isNull()
    errors = F.sort_array(F.array_compact(F.concat(_errors(schemas), F.array("loose", F.when(cyclic, F.lit("cycle"))))))
    done = both.select(
        F.col("conv").alias("conv_id"), "call_id", F.when(F.col("ordered"), F.col("level")).otherwise(0).alias("level"),
        "turn", "name", F.when(F.col("n_results").isNotNull(), "answered").otherwise("unanswered").alias("status"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), errors.alias("e"),
        # Keys in order: a variant's own keys are sorted, those of the frame are written so.
        F.to_json(F.struct(F.col("args").alias("arguments"), F.col("call_id").alias("id"), "name",
                           F.col("first.content").alias("result"))).alias("json"))
    done = done.select("conv_id", "call_id", "level", "turn", "name", "status", "n_results",
                       (F.size("e") == 0).alias("valid"), F.array_join("e", ",").alias("errors"), "json")
    c = calls.select(F.col("conv").alias("cc"), F.col("call_id").alias("ci")).where("ci is not null").distinct()
    lost = results.join(c, results["conv"].eqNullSafe(c["cc"]) & (results["call_id"] == c["ci"]), "left_anti")
    lost = lost.select(
        F.col("conv").alias("conv_id"), "call_id", F.lit(None).cast("int").alias("level"), F.col("first.turn").alias("turn"),
        F.lit(None).cast("string").alias("name"), F.lit("orphan").alias("status"),
        F.col("n_results").cast("long").alias("n_results"), F.lit(False).alias("valid"), F.lit("orphan").alias("errors"),
        F.to_json(F.struct(F.col("call_id").alias("id"), F.col("first.content").alias("result"))).alias("json"))
    return done.unionByName(lost)


# The conversations table has turns of plain text and no tool calls. The query derives them from every row: a
# user turn is a call of `reply`, a turn of any other role but `assistant` (system, null) a call of `instruct`,
# both referring to the call of turn 0 from turn 1 on; an assistant turn is the result of the turn before it.
DERIVED = tuple(Field(tool, field, kind, required) for tool in ("reply", "instruct") for field, kind, required in (
    ("after", "string", False), ("chars", "integer", True), ("text", "string", True), ("turn", "integer", True)))


def derived(conversations: DataFrame) -> DataFrame:
    """Messages with calls and results, from the turns of ``conversations``."""
    ident = lambda t: F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), t.cast("string"))
    turn = F.col("turn")
    args = F.struct(F.when(turn > 0, F.concat(F.lit("$"), ident(F.lit(0)))).alias("after"), F.col("text"), turn,
                    F.length("text").alias("chars"))
    answer = F.coalesce(F.col("role") == "assistant", F.lit(False))
    tool = F.when(F.col("role") == "user", "reply").otherwise("instruct")
    call = F.to_json(F.struct(F.array(F.struct(ident(turn).alias("id"), tool.alias("name"),
                                               args.alias("arguments"))).alias("tool_calls")))
    result = F.to_json(F.struct(ident(turn - 1).alias("tool_call_id"), F.col("text").alias("content")))
    return conversations.select("conv_id", "turn", F.when(answer, "tool").otherwise("assistant").alias("role"),
                                F.when(answer, result).otherwise(call).alias("text"))


#: DuckDB form of the op5 query.
ORACLE = """
WITH m AS (
  SELECT conv_id, turn, role, text, coalesce(CAST(conv_id AS VARCHAR), '') || ':' AS pre
  FROM conversations
), calls AS (
  SELECT conv_id, turn, text, pre || CAST(turn AS VARCHAR) AS call_id, pre || '0' AS root,
         CASE WHEN role = 'user' THEN 'reply' ELSE 'instruct' END AS name FROM m WHERE role IS DISTINCT FROM 'assistant'
), results AS (
  SELECT conv_id, call_id, count(*) AS n_results, arg_min(text, turn) AS content, min(turn) AS turn
  FROM (SELECT conv_id, turn, text, pre || CAST(turn - 1 AS VARCHAR) AS call_id FROM m WHERE role = 'assistant')
  GROUP BY conv_id, call_id
), ids AS (
  SELECT DISTINCT conv_id, call_id FROM calls
), linked AS (
  SELECT c.*, r.n_results, r.content, c.turn > 0 AS refers, c.turn > 0 AND i.call_id IS NULL AS loose
  FROM calls c LEFT JOIN results r ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.call_id = c.call_id
  LEFT JOIN ids i ON i.conv_id IS NOT DISTINCT FROM c.conv_id AND i.call_id = c.root
)
SELECT conv_id, call_id, CAST(CASE WHEN refers AND NOT loose THEN 1 ELSE 0 END AS INT) AS level, turn, name,
       CASE WHEN n_results IS NULL THEN 'unanswered' ELSE 'answered' END AS status,
       CAST(coalesce(n_results, 0) AS BIGINT) AS n_results, NOT loose AS valid,
       CASE WHEN loose THEN 'dangling reference' ELSE '' END AS errors,
       '{"arguments":{' || CASE WHEN refers THEN '"after":' || CAST(to_json('$' || root) AS VARCHAR) || ',' ELSE '' END
         || '"chars":' || CAST(length(text) AS VARCHAR) || ',"text":' || CAST(to_json(text) AS VARCHAR)
         || ',"turn":' || CAST(turn AS VARCHAR) || '},"id":' || CAST(to_json(call_id) AS VARCHAR) || ',"name":"' || name || '"'
         || CASE WHEN content IS NULL THEN '' ELSE ',"result":' || CAST(to_json(content) AS VARCHAR) END || '}' AS json
FROM linked
UNION ALL
SELECT r.conv_id, r.call_id, CAST(NULL AS INT), r.turn, NULL, 'orphan', CAST(r.n_results AS BIGINT), FALSE, 'orphan',
       '{"id":' || CAST(to_json(r.call_id) AS VARCHAR)
         || CASE WHEN content IS NULL THEN '' ELSE ',"result":' || CAST(to_json(content) AS VARCHAR) END || '}'
FROM results r LEFT JOIN ids i ON i.conv_id IS NOT DISTINCT FROM r.conv_id AND i.call_id = r.call_id WHERE i.call_id IS NULL
"""
