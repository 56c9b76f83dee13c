import random
from collections import Counter
from itertools import permutations

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tests.llm.helpers import odd
from tillsight.llm import filter_audit as fa

DOCS = "doc_id bigint, lang string, text string, part string, failed int"
LABELS = "doc_id bigint, quality int, toxic int, part string"


def failed(text, smaller):
    ws = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    return [len(ws) < 100, 100 * len(set(ws)) < 80 * len(ws), 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            any(c in "#$%&*|" for c in text), smaller]


def brute(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, _, t in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    rows = [((lang or ""), d, failed(t or "", d is not None and least.get(t or "", d) < d)) for d, lang, t in docs]
    out, worth = {}, Counter()
    for p in permutations(range(5)):
        for part in {r[0] for r in rows}:
            left = [r for r in rows if r[0] == part]
            fails = [r for r in rows if r[0] == part]
            for i, k in enumerate(p):
                gone = [r for r in left if r[2][k]]
                left = [r for r in left if not r[2][k]]
                worth[part, k] += len(gone)
                out[part, "".join("ABCDE"[x] for x in p), i + 1] = (
                    len(left), len(gone), sum(r[2][k] for r in fails) - len(gone), sum(r[2][k] and sum(r[2]) == 1 for r in fails),
                    sum(r[1] in good for r in gone), sum(r[1] in toxic for r in gone), k)
    return {key: (*v[:-1], worth[key[0], v[-1]]) for key, v in out.items()}


def run(spark, docs, labels):
    d = spark.createDataFrame([(*r, "clash", 9) for r in docs], DOCS)
    rows = fa.audit(d, spark.createDataFrame([(*r, "clash") for r in labels], LABELS)).collect()
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(got) == len(rows)
    return got


def made(n, seed):
    rnd = random.Random(seed)
    docs = []
    for i in range(n):
        size = rnd.choice((0, 3, 99, 100, 101, 150))
        text = " ".join(f"w{rnd.randint(0, rnd.choice((30, 4000)))}" for _ in range(size))
        text += rnd.choice(("", "", " #", " AAAA" * 30, "\t*\n"))
        if docs and rnd.random() < 0.4:
            text = rnd.choice(docs)[2]
        docs.append((rnd.choice((i, i, i, 7, None)), rnd.choice(("en", "de", None, "")), rnd.choice((text, text, text, None))))
    return docs, [(rnd.choice((i, 7, None)), rnd.choice((0, 1, None)), rnd.choice((0, 1, None))) for i in range(0, n, 2)]


def test_equals_brute_force(spark):
    docs, labels = made(160, 1)
    assert run(spark, docs, labels) == brute(docs, labels)


def test_small_ranges_and_negative_ids(spark, monkeypatch):
    monkeypatch.setattr(fa, "RANGE", 8)
    docs, labels = made(120, 2)
    docs = [(None if d is None else d * 5 - 300, lang, t) for d, lang, t in docs]
    labels = [(None if d is None else d * 5 - 300, q, t) for d, q, t in labels]
    assert run(spark, docs, labels) == brute(docs, labels)


def test_a_third_of_all_rows_are_copies(spark):
    docs, labels = made(100, 3)
    docs = [(1000 + i, "en", "the same text") for i in range(60)] + [(5, "en", "one row again")] * 60 + docs
    assert run(spark, docs, labels) == brute(docs, labels)


def test_empty_tables(spark):
    docs, labels = made(20, 4)
    assert run(spark, [], labels) == {}
    assert run(spark, docs, []) == brute(docs, [])


def test_odd_rows(spark):
    df = odd(spark)
    rows = fa.audit(df, spark.createDataFrame([], LABELS)).where("step = 5").collect()
    kept = Counter(r.kept for r in rows if r.part == "en")
    assert set(kept) == {1} and sum(kept.values()) == 120         # the long text fails no filter
    assert {r.part for r in rows} == {"en", "de", "fr", ""}


ids = st.lists(st.integers(0, 400), unique=True).map(sorted)


@given(st.lists(ids, max_size=6))
def test_union_of_sorted_lists(lists):
    assert fa.union([list(x) for x in lists]) == sorted(set().union(*lists))


@given(ids, ids)
def test_common_of_sorted_lists(a, b):
    assert fa.common(a, b) == sorted(set(a) & set(b))


@given(ids, st.integers(0, 401), st.integers(0, 30))
def test_gallop(a, x, at):
    at = min(at, sum(v < x for v in a))
    assert fa.gallop(a, x, at) == sum(v < x for v in a)


@pytest.mark.parametrize("bad", ["#", "$", "%", "&", "*", "|"])
def test_symbols(spark, bad):
    got = run(spark, [(1, "en", f"a {bad}")], [])
    assert got["en", "DABCE", 1][:2] == (0, 1)
