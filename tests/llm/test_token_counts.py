import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import documents, empty, odd
from tillsight.llm import token_counts as tc
from tillsight.llm.queries import vocabulary

ALPHABET = [*"ab'strevlmd  \n\t 12.,!é中　'", "'re", "'ll", "'ve", " '", "<|endoftext|>", "'S", "\r\n", "̈", "ª", "²", " ", "😀", "\x1c"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def wanted(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def worker():
    with open(vocabulary(), encoding="utf-8") as f:
        return tc.Worker(f.read(), tc.code_classes())


def test_random_texts_equal_the_library(spark, library):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 40))) for _ in range(20_000)]
    got = tc.count_tokens(table(spark, texts), vocabulary()).orderBy("doc_id").collect()
    assert [r.n_tokens for r in got] == wanted(library, texts)
    assert [r.n_bytes for r in got] == [len(t.encode()) for t in texts]


def test_documents_equal_the_library(spark, library):
    got = tc.count_tokens(documents(spark), vocabulary()).collect()
    assert [r.n_tokens for r in got] == wanted(library, [r.text for r in got])
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)


def test_odd_rows_pass_through(spark, library):
    df = odd(spark).withColumn("N_TOKENS", F.lit("old"))
    got = tc.count_tokens(df, vocabulary()).collect()
    assert len(got) == df.count() and got[0].__fields__ == [*odd(spark).columns, "n_bytes", "n_tokens", "over_limit"]
    assert [r.n_tokens for r in got] == wanted(library, [r.text for r in got])
    assert all(r.n_tokens == r.n_bytes == 0 and not r.over_limit for r in got if not r.text)
    assert tc.count_tokens(empty(spark), vocabulary()).count() == 0


def test_long_texts_are_cut_at_white_space_only(spark, library, monkeypatch):
    monkeypatch.setattr(tc, "WINDOW", 50)
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(ALPHABET) for _ in range(3000)), "x" * 5000, "a " * 3000, " " * 3000 + "b", "don't\n\n 're " * 400]
    w = worker()
    assert w.count(texts, tc.LengthTable(np.zeros(0, np.uint64), np.zeros(0, np.uint16))).tolist() == wanted(library, texts)


def test_the_table_holds_the_frequent_and_nothing_depends_on_it(spark, library, monkeypatch):
    """Both tiers alone, a summary that overflows, and summaries merged in levels give the same counts."""
    monkeypatch.setattr(tc, "MERGE_ROWS", 2)
    docs = documents(spark).repartition(9)
    sc = spark.sparkContext
    with open(vocabulary(), encoding="utf-8") as f:
        spec, classes = sc.broadcast(f.read()), sc.broadcast(tc.code_classes())
    full = tc.frequent(docs, spec, classes)
    w = worker()
    texts = [r.text for r in docs.collect()]
    want = wanted(library, texts)
    assert w.count(texts, full).tolist() == want
    cached = len(w.known[0])
    assert w.count(texts, tc.LengthTable(np.zeros(0, np.uint64), np.zeros(0, np.uint16))).tolist() == want
    assert len(w.known[0]) > cached > 0          # tier one answered for the rest
    monkeypatch.setattr(tc, "SUMMARY", 200)
    monkeypatch.setattr(tc, "KEEP", 100)
    monkeypatch.setattr(tc, "CACHE", 300)
    small = tc.frequent(docs, spec, classes)
    assert 0 < int((small.lengths > 0).sum()) <= 100
    assert worker().count(texts, small).tolist() == want
    _, s, e, prints, _ = w.pieces([" the"])
    assert full.lookup(prints).tolist() in ([1], [0]) and e[-1] - s[0] == 4


def test_table_of_colliding_slots():
    keys = np.arange(1, 2000, dtype=np.uint64)            # all begin in slot zero
    t = tc.LengthTable(keys, np.arange(1, 2000, dtype=np.uint16))
    assert t.lookup(np.array([1, 1999, 2000, 7], np.uint64)).tolist() == [1, 1999, 0, 7]
