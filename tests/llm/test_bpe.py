import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillsight.llm import bpe

from .helpers import documents, empty, odd

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(rows, library):
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        back = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_random_unicode_equals_the_library(library):
    random.seed(3)
    parts = ["a", "Bc", " ", "  ", "\n", "\t", "é", "ß", "½", "²", "\x1c", "\x85", "　", "'s", "'ll", "٣", "中",
             "😀", "é", "<|endoftext|>", "12", "!", "​", "\x00", "aaaa", "\r\n"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 40))) for _ in range(500)]
    texts += ["", "a" * 3000, "<|endoftext|>" * 3]
    got = bpe.Encoder(bpe.Vocabulary.read(PATH)).encode(texts)
    want = library.encode_batch(texts, add_special_tokens=False)
    assert [[int(i) for p in g for i in p[1].split(",")] for g in got] == [w.ids for w in want]


def test_documents_equal_the_library(spark, library):
    check(bpe.digests(documents(spark), PATH).collect(), library)


def test_odd_rows(spark, library):
    out = bpe.digests(odd(spark), PATH)
    assert out.columns[:8] == odd(spark).columns
    rows = out.collect()
    assert len(rows) == 12
    check(rows, library)


def test_round_trip_and_empty(spark):
    out = bpe.encode(odd(spark).select("doc_id", "text"), PATH).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in out)
    assert bpe.digests(empty(spark), PATH).count() == 0
