import re

import numpy as np
import pytest

from tillsight.llm import mixing

from .helpers import documents, empty, odd


def brute_targets(sizes):
    """sizes: words by source (None last)."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        share = (total - sum(fixed.values())) / max(1e-300, sum(weight[s] for s in rest)) if rest else 0
        over = [s for s in rest if share * weight[s] > 3 * sizes[s]]
        if not over:
            return fixed | {s: share * weight[s] for s in rest}
        fixed |= {s: 3.0 * sizes[s] for s in over}


def check(rows, source):
    sizes = {}
    for r in rows:
        sizes[source[r["doc_id"]]] = sizes.get(source[r["doc_id"]], 0) + r["size"]
    want = brute_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s], rel=1e-9)
        assert r["taken"] % max(1, r["size"]) == 0 and 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    return want, taken


def test_documents(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    rows = mixing.mix(docs).collect()
    text = {r["doc_id"]: r for r in docs.collect()}
    assert all(r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text[r["doc_id"]]["text"] or "")) for r in rows)
    want, taken = check(rows, {i: r["source"] for i, r in text.items()})
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)


def test_reruns_and_other_partitions_agree(spark):
    docs = documents(spark)
    key = lambda df: sorted((r["doc_id"], r["taken"]) for r in mixing.mix(df).collect())
    assert key(docs) == key(docs.repartition(7))


def test_stopped_targets(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate(
        [(4, "a")] * 50 + [(1, "b")] * 3 + [(2, "c")] * 2 + [(3, None)] * 2 + [(7, "A")] * 9)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    want, taken = check(out, {i: s for i, _, s in rows})
    assert all(taken[s] == want[s] for s in "bc")             # they stop at three times their words
    assert all(abs(taken[s] - want[s]) <= 4 for s in want)


def test_subset_sum_against_brute_force():
    rng = np.random.default_rng(8)
    for _ in range(60):
        sizes = rng.choice(np.arange(1, 40), int(rng.integers(1, 6)), replace=False)
        counts = rng.integers(1, 4, len(sizes))
        budget = int(rng.integers(0, int((sizes * counts).sum()) + 1))
        sums = {0}
        for z, c in zip(sizes.tolist(), counts.tolist(), strict=True):
            sums = {s + k * z for s in sums for k in range(c + 1)}
        got = mixing.subset_sum(sizes, counts, budget)
        assert (got >= 0).all() and (got <= counts).all()
        assert abs(int((got * sizes).sum()) - budget) == min(abs(s - budget) for s in sums)
        # fit() first takes the same share of every length, and leaves the program the rest.
        got = mixing.fit(sizes, counts, budget)
        assert (got >= 0).all() and (got <= counts).all()
        assert abs(int((got * sizes).sum()) - budget) <= max(sizes) / 2 + 1


def test_large_budget_in_bounded_cells():
    sizes, counts = np.array([2, 9, 400, 1001]), np.array([10 ** 6, 5 * 10 ** 5, 3, 10 ** 4])
    got = mixing.fit(sizes, counts, 12_345_677, cells=4096)
    assert (got <= counts).all() and abs(int((got * sizes).sum()) - 12_345_677) <= 1


def test_documents_longer_than_the_table():
    two = np.array([2_200_000])
    assert mixing.fit(two, np.array([2]), 3_700_000).tolist() == [2]
    assert mixing.fit(two, np.array([2]), 3_200_000).tolist() == [1]
    rng = np.random.default_rng(3)
    for _ in range(300):
        cells = 64
        sizes = np.unique(rng.integers(cells // 4, 40 * cells, int(rng.integers(1, 5))))
        counts = rng.integers(1, 4, len(sizes))
        budget = int(rng.integers(0, int((sizes * counts).sum()) + 1))
        got = mixing.fit(sizes, counts, budget, cells)
        assert (got >= 0).all() and (got <= counts).all()
        # What fit() leaves to the last step is filled as well as any choice can.
        off = abs(int((got * sizes).sum()) - budget)
        assert off <= max(sizes) / 2 + 1
    for _ in range(300):
        sizes = np.unique(rng.integers(51, 300, int(rng.integers(1, 6))))
        counts, budget = rng.integers(0, 4, len(sizes)), int(rng.integers(1, 102))
        sums = {0}
        for z, c in zip(sizes.tolist(), counts.tolist(), strict=True):
            sums = {s + k * z for s in sums for k in range(c + 1)}
        got = mixing.one_or_two(sizes, counts, budget)
        assert (got <= counts).all() and abs(int((got * sizes).sum()) - budget) == min(abs(s - budget) for s in sums)


def test_apply_mix_repeats_rows(spark):
    docs = documents(spark)
    plan = {r["doc_id"]: r["repeats"] for r in mixing.mix(docs).collect()}
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    seen = {}
    for r in out.collect():
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + 1
    assert seen == {i: n for i, n in plan.items() if n}


def test_odd_rows_and_empty(spark):
    rows = mixing.mix(odd(spark)).collect()
    assert len(rows) == 12
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    again = mixing.apply_mix(odd(spark))
    assert again.columns == odd(spark).columns
    assert again.count() == sum(r["repeats"] for r in rows)
    assert mixing.mix(empty(spark)).count() == 0 and mixing.apply_mix(empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in mixing.mix(blank).collect()] == [(0.0, 0)] * 2


def test_only_the_sources_are_broadcast(spark, monkeypatch):
    """Files are smaller than the rows they hold, so rows, histograms and texts are never gathered in the driver."""
    plans, run = [], type(spark.range(0)).checkpoint
    seen = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(type(spark.range(0)), "checkpoint", lambda self, *a, **b: seen(self) or run(self, *a, **b))
    docs = spark.createDataFrame([(i, "x " * (i % 7 + 1), f"s{i % 3}") for i in range(300)], "doc_id long, text string, source string")
    out = mixing.apply_mix(docs)
    seen(out)
    assert {r["source"] for r in out.select("source").distinct().collect()} == {"s0", "s1", "s2"}
    joins = [line for p in plans for line in p.splitlines() if "BroadcastHashJoin" in line]
    assert joins and not [line for line in joins if not re.search("_g#|_s#|_pid#", line)]
    assert sum(p.count("SortMergeJoin") for p in plans) >= 3
