import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tillsight.llm import ngram_lm as lm
from tillsight.llm.common import fold

from .helpers import crc, documents, empty, odd, words


def brute(rows):
    c = Counter()
    for i, t in rows:
        if crc(i, 10):
            c.update([*words(t), None])
    n, v = sum(c.values()), len(c)
    return c, n, v


def brute_all(texts):
    c = Counter(w for t in texts for w in [*t.split(), None])
    return c, sum(c.values()), len(c)


def scored(spark, docs, **options):
    held = docs.withColumn("held", fold(F.col("doc_id"), 10) == 0)
    model = lm.train(held, ~F.col("held"), **{k: v for k, v in options.items() if k == "segment_tokens"})
    return model, lm.score(held, model, **{k: v for k, v in options.items() if k == "broadcast_bytes"})


def test_base_score_is_exact_and_model_is_better(spark):
    docs = documents(spark).select("doc_id", "text")
    model, out = scored(spark, docs)
    rows = out.collect()
    c, n, v = brute([(r["doc_id"], r["text"]) for r in rows])
    assert (model.tokens, model.distinct) == (n, v)
    for r in rows:
        t = [*words(r["text"]), None]
        assert r["n_tokens"] == len(t) and r["n_known"] == sum(c[x] > 0 for x in t)
        assert math.isclose(r["base_score"], sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t), rel_tol=1e-9)
    held = [r for r in rows if r["held"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_filter_against_exact_counts():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 2 ** 63, 20_000, dtype=np.uint64)
    counts = rng.zipf(1.5, len(keys)).clip(max=10 ** 9)
    seg = lm.Segment(keys[:0], counts[:0], keys, lm.level(counts))
    got = seg.levels(keys)
    assert (got >= lm.level(counts)).all()                     # a Bloom filter never loses a level
    assert (got == lm.level(counts)).mean() > 0.9
    assert (seg.levels(rng.integers(0, 2 ** 63, 20_000, dtype=np.uint64)) > 0).mean() < 0.05
    assert (lm.level(np.array([1, 2, 3, 4, 7, 8])) == [1, 2, 2, 3, 3, 4]).all()


def test_passes_do_not_change_the_scores(spark):
    docs = documents(spark).select("doc_id", "text")
    key = lambda df: {r["doc_id"]: (r["n_known"], r["score"]) for r in df.collect()}
    model, one = scored(spark, docs, segment_tokens=5000)
    bound = 2 * max(model.sizes)
    assert len(model.passes(bound)) > 2
    many = lm.score(docs, model, broadcast_bytes=bound)
    a, b = key(one), key(many)
    assert a.keys() == b.keys()
    assert all(a[k][0] == b[k][0] and math.isclose(a[k][1], b[k][1], rel_tol=1e-12) for k in a)


def test_segments_are_partitions_and_not_sorted(spark, monkeypatch):
    """Rows of a segment stream into the one task that builds it: no sort holds them in the executor."""
    fed, run = [], lm.in_arrow
    monkeypatch.setattr(lm, "in_arrow", lambda df, *rest: fed.append(df) or run(df, *rest))
    model = lm.train(documents(spark).select("doc_id", "text"), F.lit(True), segment_tokens=5000)
    plan = fed[-1]._jdf.queryExecution().executedPlan().toString()
    assert "Sort [" not in plan and plan.count("Exchange") == 2        # by segment, and the masses' own
    assert model.n > 3 and fed[-1].rdd.getNumPartitions() == model.n
    got = sorted(r["segment"] for r in model.segments.select("segment").collect())
    assert got == list(range(model.n))


def test_order_of_what_follows(spark):
    """Quantised counts keep the order of what follows a context, but for the filter's false positives: one pair
    in thirty or so answers a level too high."""
    made = [f"a{i} {w}{i}" for i in range(40) for w, n in (("b", 9), ("c", 6), ("d", 3)) for _ in range(n)]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    model = lm.train(docs, F.lit(True))
    asked = [f"a{i} {w}{i}" for i in range(40) for w in "bcde"]
    pairs = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    one = {r["text"]: r["score"] for r in lm.score(pairs, model).collect()}
    kept = [one[f"a{i} b{i}"] > one[f"a{i} c{i}"] > one[f"a{i} d{i}"] > one[f"a{i} e{i}"] for i in range(40)]
    assert sum(kept) >= 30


def hashes(texts):
    return lm.token_hashes(pa.array([t.encode() for t in texts], pa.binary()))


def test_probabilities_of_every_context_sum_to_one(spark):
    """Frequent and rare contexts, quantised counts of all levels; false positives of the filter are taken out."""
    docs = documents(spark).select("doc_id", "text").limit(60)
    texts = [(r["text"] or "") for r in docs.collect()] + ["same words " * 400, "only here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = lm.train(docs, F.lit(True), segment_tokens=2000)
    tables = model.tables(list(range(model.n)))
    h, at = hashes(texts)
    pairs = Counter((int(a), int(b)) for a, b, same in zip(h[:-1], h[1:], at[1:] == at[:-1], strict=True) if same)
    counts = Counter(h.tolist())
    vocabulary = np.array([*counts, 2], np.uint64)      # and one token never seen
    frequent = [x for x, _ in counts.most_common(40) if x != int(lm.END)]
    rare = [x for x, k in counts.items() if k == 1][:40]
    assert rare and max(pairs.values()) > 300
    for context in frequent + rare:
        asked = np.stack([np.full(len(vocabulary), context, np.uint64), vocabulary], 1).ravel()
        text = np.repeat(np.arange(len(vocabulary)), 2)
        known, before, pair, mass = lm._looked_up(tables, asked, text)
        exact = lm.level(np.array([pairs[context, int(w)] for w in vocabulary])) * np.array([(context, int(w)) in pairs for w in vocabulary])
        assert (pair[1::2] >= exact).all()
        pair[1::2] = exact
        sums = lm._sums(text, len(vocabulary), known, before, pair, mass, model.tokens, model.distinct)
        first = lm._log_base(known[::2], model.tokens, model.distinct)
        assert math.isclose((10 ** (np.array(sums[3]) - first)).sum(), 1, rel_tol=1e-6)


def test_contexts_that_share_half_a_hash(spark):
    names = [f"w{i}" for i in range(400_000)]
    h, at = hashes(names)
    first = h[np.concatenate([[True], at[1:] != at[:-1]])]
    low = first & np.uint64(0xFFFFFFFF)
    order = np.argsort(low)
    same = np.flatnonzero(low[order][1:] == low[order][:-1])[0]
    a, b = names[order[same]], names[order[same + 1]]
    texts = [f"{a} x"] * 5 + [f"{b} y"] * 9 + [f"{b} {i}" for i in range(30)]
    model = lm.train(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), F.lit(True))
    tables = model.tables([0])
    mass = tables.resolve(np.array([first[order[same]], first[order[same + 1]]]), lm.Segment.mass)
    worth = lambda n: (lm.middle(lm.level(np.array([n])))[0] - lm.DISCOUNT) * lm.UNITS
    assert mass.tolist() == [worth(5), worth(9) + 30 * worth(1)]


def test_narrow_numbers():
    values = np.array([0, 1, 2 ** 32 - 2, 2 ** 32 - 1, 2 ** 32, 2 ** 50, 7])
    got = lm.Narrow(values)
    places = np.array([5, 0, 3, 6, 4, 2, 1, 5])
    assert got[places].tolist() == values[places].tolist() and got.low.itemsize == 4


def test_pairs_seen_once_are_kept(spark):
    texts = ["o p", "o q", "o r s", "t u"]      # none of these pairs meets a false positive of the filter
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = lm.train(docs, F.lit(True))
    asked = spark.createDataFrame([(0, "o p"), (1, "t u"), (2, "t p")], "doc_id long, text string")
    got = {r["text"]: r["score"] for r in lm.score(asked, model).collect()}
    c, n, v = brute_all(texts)
    pairs = Counter(p for t in texts for p in zip(t.split(), [*t.split()[1:], None], strict=True))

    def p(prev, x):
        p0 = (c[x] + 0.1) / (n + 0.1 * (v + 1))
        if prev is None:
            return p0
        of = [k for (h, _), k in pairs.items() if h == prev]
        return max(pairs[prev, x] - 0.75, 0) / c[prev] + (1 - sum(k - 0.75 for k in of) / c[prev]) * p0

    for text, score in got.items():
        t = text.split()
        want = sum(math.log10(p(h, x)) for h, x in zip([None, *t], [*t, None], strict=True))
        assert math.isclose(score, want, rel_tol=1e-9), text


def test_odd_rows_and_empty(spark):
    model, out = scored(spark, odd(spark))
    rows = {r["key"]: r for r in out.withColumn("t", F.length("text")).collect()}
    assert rows[2]["n_tokens"] == 1 and rows[4]["n_tokens"] == 1 and rows[5]["n_tokens"] == 30_001
    assert out.count() == 12
    model, none = scored(spark, empty(spark))
    assert (model.tokens, model.distinct, none.count()) == (0, 0, 0)
    assert all(r["base_score"] == 0.0 for r in lm.score(odd(spark).where("text is null"), model).collect())


def test_numbers_packed_by_bytes():
    keys = np.sort(np.random.default_rng(3).integers(0, 2 ** 64, 5000, dtype=np.uint64))
    body = lm._dumped([lm._steps(keys), np.zeros(0, np.uint64), np.array([0, 2 ** 40, 7])])
    a, none, c = lm._loaded(body)
    assert (np.cumsum(a, dtype=np.uint64) == keys).all() and len(none) == 0 and c.tolist() == [0, 2 ** 40, 7]
    assert len(body) < 7.2 * len(keys)     # a step of 5000 over the range of 64 bits has about 52 bits


def test_a_model_beyond_the_bound_takes_two_shuffles(spark, monkeypatch):
    """However many segments there are, texts and answers are written once, and not once a pass; columns, nulls, repeated
    rows and binary texts come out as they do after a broadcast."""
    names, run = [], lm.stored
    docs = odd(spark).union(odd(spark).withColumn("text", F.concat("text", F.lit(" and more of the same words"))))
    model = lm.train(docs, F.lit(True), segment_tokens=500)
    assert model.n > 20
    monkeypatch.setattr(lm, "stored", lambda df, name: names.append(name) or run(df, name))
    for fed in (docs, docs.withColumn("text", F.col("text").cast("binary"))):
        one, many = (lm.score(fed, model, broadcast_bytes=b) for b in (1 << 30, 1))
        assert one.columns == many.columns and one.dtypes == many.dtypes
        assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))
    assert names == ["lm-chunks", "lm-answers"] * 2
    assert lm.score(docs.limit(0), model, broadcast_bytes=1).count() == 0
