import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tillsight.llm import langid
from tillsight.llm.common import fold

from .helpers import documents, empty, odd

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = documents(spark, SF)
    model = langid.train(docs, fold(F.col("doc_id"), 3) != 1)
    held = langid.predict(docs.where((fold(F.col("doc_id"), 3) == 1) & F.col("text").rlike(r"\p{L}")), model).collect()
    assert len(held) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in held)


def test_masks_name_every_language_of_a_gram():
    rng = np.random.default_rng(2)
    kept = [np.unique(rng.integers(0, 2 ** 32, 3000, dtype=np.uint32)) for _ in range(70)]
    kept[69] = np.union1d(kept[69], kept[0][:500])
    f = langid.Filter([f"l{i:02}" for i in range(70)], kept)
    assert f.rows.shape[1] == 2
    for i in (0, 5, 63, 64, 69):
        bit = f.masks(kept[i])[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)
        assert bit.all()                                       # no false negatives
    both = f.masks(kept[0][:500])
    assert (both[:, 0] & np.uint64(1)).all() and (both[:, 1] >> np.uint64(5) & np.uint64(1)).all()
    other = rng.integers(0, 2 ** 32, 50_000, dtype=np.uint32)
    share = (f.masks(other)[:, 0] & np.uint64(1)).mean()
    assert abs(share - f.false[0]) < 0.01                      # the correction knows its rate


def test_grams_do_not_cross_texts():
    g, text = langid.grams(pa.array([b"ab", None, b"abcd"], pa.binary()))
    assert (text == [0, 2, 2, 2]).all()
    assert g[0] == int.from_bytes(b" ab ", "little")


def test_odd_rows_and_empty(spark):
    model = langid.train(odd(spark), min_share=1e-4)
    rows = langid.predict(odd(spark), model).collect()
    assert len(rows) == 12
    for r in rows:
        if r["doc_id"] in (2, 3, 4):
            assert (r["lang_pred"], r[-1]) == ("und", 0.0)
    assert {r["lang_pred"] for r in rows} <= {"en", "de", "fr", "und"}
    none = langid.train(empty(spark))
    assert {r["lang_pred"] for r in langid.predict(odd(spark), none).collect()} == {"und"}
    assert langid.predict(empty(spark), model).count() == 0


def test_lang_is_no_input_of_a_prediction(spark):
    docs = documents(spark, SF)
    model = langid.train(docs, fold(F.col("doc_id"), 3) != 1)
    a = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs.select("doc_id", "text"), model).collect()}
    b = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs.withColumn("lang", F.lit("xx")), model).collect()}
    assert a == b
