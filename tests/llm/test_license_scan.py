import re

from pyspark.sql import functions as F

from tillsight.llm import license_scan as ls

from .helpers import documents, empty, odd

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    w = WORD.findall(re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    at, labels = [], set()
    for p, label in ls.PHRASES.items():
        q = p.encode().split()
        for i in range(len(w) - len(q) + 1):
            if w[i:i + len(q)] == q:
                at.append(i)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def got(r):
    return r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]


def test_base_columns_against_brute_force(spark):
    rows = ls.scan(documents(spark, "/root/testdata/sf0.01").select("doc_id", "text")).collect()
    texts = {r["doc_id"]: r["text"] for r in documents(spark, "/root/testdata/sf0.01").collect()}
    assert len(rows) == len(texts) and sum(r["n_base"] > 0 for r in rows) > 20
    for r in rows:
        assert got(r) == brute(texts[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))


def test_phrases_in_every_place(spark):
    cases = ["CC BY-NC", "cc by nc cc by nc", "x under the MIT license; under the mit License y", "apache license version",
             "Apache License, Version 2.0 and apache license version 2", "under the MIT licence", "underthe mit license",
             "cc by", "cc" + " by nc" * 3, "été cc by nc été", "z " * 5000 + "cc by nc"]
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    for r in ls.scan(docs).collect():
        assert got(r) == brute(cases[r["doc_id"]]), cases[r["doc_id"]]


def test_notices_tolerate_small_changes(spark):
    whole = ls.NOTICES["mit"][0]
    words = whole.split()
    bent = " ".join(words[:20] + ["really"] + words[20:31] + words[32:])
    half = " ".join(words[:len(words) // 2])
    docs = spark.createDataFrame([(1, f"intro {whole} outro"), (2, bent), (3, half), (4, " ".join(reversed(words)))],
                                 "doc_id long, text string")
    rows = {r["doc_id"]: r for r in ls.scan(docs).collect()}
    assert rows[1]["labels"] == "mit" and rows[1]["score"] == 1.0 and rows[1]["n_base"] == 0
    assert rows[2]["labels"] == "mit" and 0.9 < rows[2]["score"] < 1.0
    assert rows[3]["labels"] == "" and rows[4]["labels"] == "" and rows[3]["score"] == 0.0


def test_notices_with_long_insertions(spark):
    words = ls.NOTICES["mit"][0].split()
    cuts = [([16, 33], 4), ([10, 25, 40], 7), ([24], 30), ([5, 15, 25, 35, 45], 5)]
    cases = []
    for at, n in cuts:
        w = list(words)
        for i in sorted(at, reverse=True):
            w[i:i] = [f"filler{i}x{j}" for j in range(n)]
        cases.append(" ".join(["intro"] * 9 + w + ["outro"] * 9))
    cases.append(" ".join(words[:20] + ["far"] * 400 + words[20:]))          # farther apart than the template is long
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in ls.scan(docs).collect()}
    assert [rows[i]["labels"] for i in range(len(cuts))] == ["mit"] * len(cuts)
    assert all(rows[i]["score"] == 1.0 for i in range(len(cuts)))
    assert rows[len(cuts)]["labels"] == ""


def brute_labels(text, min_score=ls.MIN_SCORE):
    """Labels by the definition: an ordered match in any window of two template lengths."""
    w, out = ls.words_of((text or "").encode()), set()
    for t in ls.templates():
        n = len(t.words)
        if t.phrase:
            out |= {t.label for i in range(len(w) - n + 1) if w[i:i + n] == t.words}
        elif any(ls.verified(w[i:i + 2 * n], t, 0, n) >= min_score for i in range(max(1, len(w) - n // 2))):
            out.add(t.label)
    return ",".join(sorted(out))


def test_method_labels_against_brute_force(spark):
    import random

    rng = random.Random(7)
    common = "the software to any of this license use and in source code for free public".split()
    cases = []
    for t in ls.templates():
        if t.phrase:
            continue
        n = len(t.words)
        spare = int(n * (1 - ls.MIN_SCORE) + 1e-9)
        for changes in {0, spare // 2, spare, 2 * spare + 2}:
            w = [x.decode() for x in t.words]
            for i in sorted(rng.sample(range(1, n - 1), min(changes, n - 2)), reverse=True):
                kind = rng.randrange(3)
                if kind == 0:
                    del w[i]
                elif kind == 1:
                    w[i] = f"junk{i}"
                else:
                    w[i:i] = [f"more{i}"] * rng.randrange(1, 3)
            cases.append((changes <= spare, " ".join(rng.choices(common, k=30) + w + rng.choices(common, k=30))))
        cases.append((False, " ".join(rng.choices([x.decode() for x in t.words], k=3 * n))))
    docs = spark.createDataFrame([(i, c) for i, (_, c) in enumerate(cases)], "doc_id long, text string")
    rows = {r["doc_id"]: r["labels"] for r in ls.scan(docs).collect()}
    for i, (bounded, text) in enumerate(cases):
        want, got = (set(filter(None, x.split(","))) for x in (brute_labels(text), rows[i]))
        assert got == want if bounded else got <= want, text      # beyond B changes a match may be missed


def test_texts_are_not_shuffled(spark):
    """The spans are broadcast by the size of their table: no exchange carries a text."""
    plan = ls.scan(documents(spark).select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan, plan


def test_verified_is_ordered():
    t = ls.Template(0, "x", [b"a", b"b", b"c", b"d"], False)
    assert ls.verified([b"a", b"x", b"b", b"c", b"d"], t, 0, 1) == 1.0
    assert ls.verified([b"d", b"c", b"b", b"a"], t, 0, 0) == 0.25


def test_odd_rows_and_empty(spark):
    rows = ls.scan(odd(spark)).collect()
    assert len(rows) == 12
    for r in rows:
        assert (r["n_words"], r["n_base"]) == brute(r["text"])[:2]
    assert ls.scan(empty(spark)).count() == 0
    twice = odd(spark).where("doc_id = 10").unionByName(odd(spark).where("doc_id = 10"))
    assert [r["n_base"] for r in ls.scan(twice.withColumn("x", F.lit(1))).collect()] == [2, 2]
