import numpy as np
import pytest
from pyspark.sql import functions as F

from tillsight.llm import toxicity
from tillsight.llm.common import fold

from .helpers import documents, empty, odd

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def machine(spark):
    docs = documents(spark, SF).select("doc_id", "text")
    return toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), fold(F.col("id"), 5) != 0)


def kernel(a, b):
    """Gap-weighted subsequences by enumeration."""
    def features(w):
        at, weight = toxicity._shape(len(w))
        out = {}
        for places, x in zip(at.tolist(), weight, strict=True):
            t = tuple(w[p] for p in places)
            out[t] = out.get(t, 0) + x
        return out
    fa, fb = features(a), features(b)
    return sum(x * fb.get(t, 0) for t, x in fa.items())


def test_features_are_the_kernel():
    words = [toxicity.encode(w)[0] for w in ("idiot", "idxiot", "clown", "aaaa")]
    r, t, v = toxicity.features(words)
    dense = np.zeros((len(words), toxicity.ALPHABET ** toxicity.ORDER), np.float32)
    np.add.at(dense, (r, t), v)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert abs(dense[i] @ dense[j] - kernel(a, b)) < 1e-5
    assert kernel(words[0], words[1]) > 5 * kernel(words[0], words[2])


def test_folded_margin_equals_the_sum_over_triples():
    rng = np.random.default_rng(4)
    m = toxicity.Machine(rng.normal(size=toxicity.ALPHABET ** toxicity.ORDER).astype(np.float32), 0.25, None)
    words = ["idiot", "a", "", ":;", "réeux", "pneumonoultramicroscopicsilicovolcanoconiosis", "x" * 500]
    for w, got in zip(words, m.margins(words), strict=True):
        best = -1.0
        for s in toxicity.encode(w):
            if len(s) >= toxicity.ORDER:
                r, t, v = toxicity.features([s])
                best = max(best, float((v * m.theta[t]).sum()) + 0.25)
        assert abs(best - got) < 1e-4


def test_held_out_accuracy(spark, machine):
    docs = documents(spark, SF).select("doc_id", "text").where(fold(F.col("doc_id"), 5) == 0)
    rows = toxicity.score(docs, machine).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    bad = [r["score"] >= 0.5 for r in rows if r["toxic"] == 1]
    fine = [r["score"] >= 0.5 for r in rows if r["toxic"] == 0]
    assert len(bad) > 50 and len(fine) > 400
    assert np.mean(bad) > 0.8
    assert np.mean(fine) < 0.03


def test_bent_insults_and_clean_text(machine):
    clean = "the report was thorough and the committee thanked everyone who helped"
    texts = [clean, clean + " you idiot", clean + " you idxiot", clean + " you i d i o t", clean + " you id.iot!!", "", "x"]
    s = machine.scores(texts)
    assert s[0] < 0.5 and s[5] < 0.5 and s[6] < 0.5
    assert (s[1:5] >= 0.5).all()


def test_odd_rows_and_empty(spark, machine):
    rows = toxicity.score(odd(spark), machine, name="tox").collect()
    assert len(rows) == 12 and all(0 <= r["tox"] <= 1 for r in rows)
    by = {r["doc_id"]: r["tox"] for r in rows}
    assert by[2] == by[3] == by[4]
    assert toxicity.score(empty(spark), machine, name="tox").count() == 0
    labels = spark.createDataFrame([(1, 0), (5, 0), (5, None), (None, 1)], "doc_id long, toxic int")
    one = toxicity.train(odd(spark), labels)
    assert {r["tox"] for r in toxicity.score(odd(spark), one, name="tox").collect()} == {0.0}
    none = toxicity.train(empty(spark), labels.where("false"))
    assert {r["tox"] for r in toxicity.score(odd(spark), none, name="tox").collect()} == {0.0}
