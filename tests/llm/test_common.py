import pyarrow as pa
import pytest

from tillsight.llm import common
from tillsight.llm.common import append_columns, as_bytes


def sizes(col):
    assert pa.types.is_binary(col.type)
    return [pa.array([len(x or b"") for x in col.to_pylist()], pa.int64())]


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_texts_are_sent_once(spark, monkeypatch, kind):
    fed, run = [], common.in_arrow
    monkeypatch.setattr(common, "in_arrow", lambda df, *rest: fed.append(df) or run(df, *rest))
    docs = spark.sql(f"""select id, cast(t as {kind}) as text, id + 1 as size from values
        (0, X'C3A920C3A9'), (1, X''), (2, null), (3, X'FF41'), (4, X'E282') as d(id, t)""")
    out = append_columns(docs, "TEXT", [("size", "bigint")], sizes, limit=4)
    assert fed[0].columns == ["id", "text"] and out.columns == ["id", "text", "size"] and out.schema["text"].dataType.typeName() == kind
    rows = {r["id"]: r for r in out.selectExpr("id", "hex(text) as text", "size").collect()}
    assert {k: r["size"] for k, r in rows.items()} == {0: 5, 1: 0, 2: 0, 3: 2, 4: 2}
    assert {k: r["text"] for k, r in rows.items()} == {0: "C3A920C3A9", 1: "", 2: None, 3: "FF41", 4: "E282"}


def test_text_of_another_type_has_its_binary_form(spark):
    was = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")       # else Spark casts no number to binary
    try:
        docs = spark.sql("select id, cast(id as int) as text from range(3)")
        out = append_columns(docs, "text", [("size", "bigint")], sizes)
        assert sorted(map(tuple, out.collect())) == [(0, 0, 4), (1, 1, 4), (2, 2, 4)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", was)


def test_string_columns_as_bytes():
    for kind, want in ((pa.string(), pa.binary()), (pa.large_string(), pa.large_binary()), (pa.binary(), pa.binary())):
        got = as_bytes(pa.array(["a", None, "\u00e9b"], kind).slice(1))
        assert got.type == want and got.to_pylist() == [None, "\u00e9b".encode()]
        assert common.buffers(pa.array(["a", None, "\u00e9b"], kind).slice(1))[1].tolist() == [0, 0, 3]
