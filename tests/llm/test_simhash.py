import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillsight.llm import simhash
from tillsight.llm.common import stored

from .helpers import documents, empty, odd, words


def brute_print(text, k=4):
    w = words(text)
    runs = [b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(prints, bits=4):
    """Smallest id reachable, by scanning all pairs of rows (id, print)."""
    low = {}
    for i, _ in prints:
        if i in low:
            continue
        seen, todo = {i}, [i]
        while todo:
            now = [p for j, p in prints if j == todo[-1]]
            todo.pop()
            for j, q in prints:
                if j not in seen and any((p ^ q).bit_count() <= bits for p in now):
                    seen.add(j)
                    todo.append(j)
        for j in seen:
            low[j] = min(seen)
    return low


def test_hash_is_sparks_xxhash64(spark):
    got = spark.range(1).select(F.hex(F.xxhash64(F.lit("a b c d")))).first()[0]
    assert int(got, 16) == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_documents_against_brute_force(spark):
    docs = documents(spark).select("doc_id", "text")
    marked = stored(simhash.with_fingerprint(docs, "fp"))
    got = simhash.label(marked, "fp", "component_id").collect()
    prints = [(r["doc_id"], brute_print(r["text"])) for r in got]
    assert [r["fp"] & (2 ** 64 - 1) for r in got] == [p for _, p in prints]
    low = brute_components(prints)
    assert all(r["component_id"] == low[r["doc_id"]] for r in got)


def planted(spark, rng, n=400):
    """Prints in clusters: chains of small steps and dense groups."""
    out = []
    for _ in range(6):
        x = int(rng.integers(0, 2 ** 63))
        for _ in range(n // 8):
            out.append(x)
            for b in rng.choice(64, int(rng.integers(1, 6)), replace=False).tolist():
                x ^= 1 << b
    dense = int(rng.integers(0, 2 ** 63))
    for _ in range(n // 4):
        out.append(dense ^ sum(1 << int(b) for b in rng.choice(64, 2, replace=False)))
    signed = [x - 2 ** 64 if x >= 2 ** 63 else x for x in out]
    return out, spark.createDataFrame([(i, v) for i, v in enumerate(signed)], "doc_id long, fp long")


@pytest.mark.parametrize(("bits", "bucket"), [(4, 64), (4, 2), (3, 2)])
def test_links_of_planted_prints(spark, bits, bucket):
    values, df = planted(spark, np.random.default_rng(bits + bucket))
    got = simhash.label(df, "fp", "c", bits=bits, bucket=bucket).collect()
    low = brute_components(list(enumerate(values)), bits)
    assert {r["doc_id"]: r["c"] for r in got} == low


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    roots = {r["root"] for r in simhash.components(edges).collect()}
    assert len(roots) == 1


def test_odd_rows_and_empty(spark):
    marked = stored(simhash.with_fingerprint(odd(spark), "fp"))
    got = simhash.label(marked, "fp", "c").collect()
    assert len(got) == 12 and got[0].__fields__[:8] == odd(spark).columns
    assert all(r["fp"] == 0 and r["c"] == 2 for r in got if r["doc_id"] in (2, 3, 4))
    assert [r["c"] for r in got if r["doc_id"] is None] == [None]
    kept = simhash.keep_one(odd(spark))
    assert kept.columns == odd(spark).columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 5, 6, 7, 8, 9, 10]
    assert simhash.keep_one(empty(spark)).count() == 0
    no_id = spark.createDataFrame([(None, "one two three four five"), (None, "one two three four five"), (None, "x y z")],
                                  "doc_id long, text string")
    assert sorted(r["text"] for r in simhash.keep_one(no_id).collect()) == ["one two three four five", "x y z"]


def test_no_exploded_table_is_broadcast(spark, monkeypatch):
    """Spark takes an exploded table for as small as it was before; such a one must not be gathered in the driver."""
    plans, run = [], type(spark.range(0)).checkpoint
    seen = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(type(spark.range(0)), "checkpoint", lambda self, *a, **b: seen(self) or run(self, *a, **b))
    values, df = planted(spark, np.random.default_rng(1))
    # As small as these tables look, a broadcast of their exploded rows is far beyond this bound.
    limit, old = "spark.sql.maxBroadcastTableSize", spark.conf.get("spark.sql.maxBroadcastTableSize")
    spark.conf.set(limit, "4k")
    try:
        out = simhash.label(df, "fp", "c", root="r")
        seen(out)
        got = {r["doc_id"]: r["c"] for r in out.collect()}
    finally:
        spark.conf.set(limit, old)
    assert got == brute_components(list(enumerate(values)))
    assert not [p for p in plans if "Broadcast" in p] and sum("SortMergeJoin" in p for p in plans) > 2
