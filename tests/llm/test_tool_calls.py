import json

from pyspark.sql import functions as F

from tillsight.llm import tool_calls as tc

SCHEMAS = (tc.Field("add", "a", "integer", True), tc.Field("add", "b", "number", True), tc.Field("add", "note", "string", False))
TYPE = "conv_id long, turn long, role string, text string, extra string"


def call(*calls):
    return json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})


def answer(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


def run(spark, rows):
    out = tc.link(spark.createDataFrame([(*r, None) for r in rows], TYPE), SCHEMAS).collect()
    return {(r["conv_id"], r["call_id"]): r for r in out}, out


def test_linking_order_and_validation(spark):
    by, out = run(spark, [
        (1, 0, "user", "hello"), (1, 1, "assistant", call(("x", "add", {"b": 2.5, "a": 1}), ("y", "add", {"a": "$x", "b": 1}))),
        (1, 2, "tool", answer("x", "3.5")), (1, 3, "assistant", call(("z", "add", {"a": 1, "b": 2, "note": "$y"}))),
        (1, 4, "tool", answer("z", "done")), (1, 5, "tool", answer("z", "later")), (1, 6, "tool", answer("q", "lost")),
        (1, 7, "assistant", "no json {"), (1, 8, "assistant", None), (1, 9, "tool", "[1]"),
        (2, 0, "assistant", call(("x", "mul", {}), ("m", "add", {"a": True, "c": None}))),
        (2, 1, "assistant", call(("p", "add", {"a": 1, "b": 1, "note": "$r"}), ("r", "add", {"a": 1, "b": 1, "note": "$p"}))),
        (2, 2, "assistant", call(("s", "add", {"a": 1, "b": 1, "note": "$nobody"}), ("t", "add", "text"))),
    ])
    assert [by[1, k]["level"] for k in "xyz"] == [0, 1, 2]
    assert by[1, "x"]["json"] == '{"arguments":{"a":1,"b":2.5},"id":"x","name":"add","result":"3.5"}'
    assert by[1, "x"]["valid"] and by[1, "y"]["errors"] == "type a" and by[1, "y"]["status"] == "unanswered"
    assert (by[1, "z"]["n_results"], json.loads(by[1, "z"]["json"])["result"]) == (2, "done")
    assert by[1, "q"]["status"] == "orphan"
    assert by[2, "x"]["errors"] == "unknown tool"
    assert by[2, "m"]["errors"] == "missing b,type a,unknown c"
    assert by[2, "p"]["level"] is None and by[2, "r"]["errors"] == "cycle"
    assert by[2, "s"]["errors"] == "dangling reference" and by[2, "s"]["level"] == 0
    assert by[2, "t"]["errors"] == "malformed"
    assert len(out) == 10


def test_repeated_identifiers_do_not_multiply(spark):
    rows = [(None, 1, "assistant", call(("x", "add", {"a": 1, "b": 1})))] * 30 + [(None, 2, "tool", answer("x", "r"))] * 40
    _, out = run(spark, rows)
    assert len(out) == 30 and {r["n_results"] for r in out} == {40} and {r["status"] for r in out} == {"answered"}


def test_empty_and_no_python(spark):
    none = spark.createDataFrame([], TYPE)
    assert tc.link(none, SCHEMAS).count() == 0
    plan = tc.link(none, SCHEMAS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_derived_messages(spark):
    rows = spark.createDataFrame([(1, 0, "user", 'say "hi"\n'), (1, 1, "assistant", "hi"), (1, 2, "user", None), (2, 1, "user", "x"),
                                  (None, 0, "system", "s"), (None, 1, None, "n"), (None, 2, "user", "u"), (None, 3, "assistant", "a")],
                                 "conv_id long, turn long, role string, text string")
    out = {(r["conv_id"], r["turn"]): r for r in tc.link(tc.derived(rows), tc.DERIVED).collect()}
    assert out[1, 0]["status"] == "answered" and json.loads(out[1, 0]["json"])["arguments"]["text"] == 'say "hi"\n'
    assert out[1, 2]["level"] == 1 and out[1, 2]["errors"] == "missing chars,missing text"
    assert out[2, 1]["errors"] == "dangling reference"              # the table has no turn 0 of it
    # Every row takes part, whatever its role: what is no assistant's is a call.
    assert len(out) == 6 and [out[None, t]["name"] for t in (0, 1, 2)] == ["instruct", "instruct", "reply"]
    assert all(out[None, t]["valid"] for t in (0, 1, 2)) and out[None, 2]["status"] == "answered" and out[None, 2]["level"] == 1


def test_no_row_of_the_table_is_left_out(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    out = tc.link(tc.derived(rows), tc.DERIVED)
    asked = rows.where("role is null or role <> 'assistant'").count()
    answers = rows.where("role = 'assistant'").count()
    assert out.where("status <> 'orphan'").count() == asked
    assert out.agg(F.sum("n_results")).first()[0] == answers        # one call an id here, so each result is counted once
    begun = rows.where("turn = 0 and role <> 'assistant'").select("conv_id").distinct()
    assert out.join(begun, "conv_id").where("errors like '%dangling%'").count() == 0


def test_schema_types(spark):
    got = spark.range(1).select(F.schema_of_variant(F.parse_json(F.lit('{"a":1}'))).alias("t")).first()["t"]
    assert got.startswith("OBJECT")
