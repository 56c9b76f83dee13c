import numpy as np
import pytest
from pyspark.sql import functions as F

from tillsight.llm import ann

TYPE = "vec_id long, embedding array<float>, label int, id string, score string"


def brute(ids, v, queries, k=10):
    out = {}
    for q in queries:
        d = np.sqrt(((v - v[ids == q][0]) ** 2).sum(1))
        d[ids == q] = np.inf
        top = np.lexsort((ids, d))[:min(k, len(ids) - 1)]
        out[q] = [(int(ids[i]), float(d[i])) for i in top]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def near(a, b):
    return a.keys() == b.keys() and all(
        [i for i, _ in a[q]] == [i for i, _ in b[q]] and np.allclose([s for _, s in a[q]], [s for _, s in b[q]]) for q in a)


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")


def arrays(df):
    rows = df.select("vec_id", "embedding").collect()
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)


def test_factor_one_is_exact(table):
    ids, v = arrays(table)
    got = found(ann.nearest(table, F.col("id") % 10 == 0, relax=1.0, shard_rows=100, leaf=8, block=20))
    assert near(got, brute(ids, v, ids[ids % 10 == 0]))


def test_recall_with_production_parameters(table):
    ids, v = arrays(table)
    got, want = found(ann.nearest(table, F.col("id") % 10 == 0)), brute(ids, v, ids[ids % 10 == 0])
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_pruning_grows_with_the_factor():
    rng = np.random.default_rng(0)
    v = rng.normal(size=(2000, 6))
    tree = ann.Tree(np.arange(2000), v, 16)
    qids, q = np.arange(50), v[:50]
    exact = tree.search(qids, q, 10, 1.0)
    loose = tree.search(qids, q, 10, 4.0)
    assert (exact[1] <= loose[1] + 1e-12).all() and (exact[1] < loose[1]).any()


def test_ties_equal_vectors_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0], 0, "a", "b") for i in range(1, 40)] + [(i, [0.0, float(i)], 0, "a", "b") for i in range(40, 45)]
    rows += [(0, [1.0, 0.5], 0, None, None), (0, [1.0, 0.5], 0, None, None)]                  # a repeated row
    rows += [(100, None, 0, "", ""), (200, [0.0, 0.0], 0, "", ""), (300, [nan, 1.0], 0, "", ""), (400, [inf, 1.0], 0, "", ""),
             (500, [1.0, None], 0, "", ""), (None, [1.0, 1.0], 0, "", ""), (600, [1.0, 2.0, 3.0], 0, "", ""), (700, [], 0, "", "")]
    df = spark.createDataFrame(rows, TYPE)
    got = found(ann.nearest(df, F.col("id") % 100 == 0, relax=1.0, leaf=4, shard_rows=9))
    assert got.keys() == {0}
    assert [i for i, _ in got[0]] == list(range(1, 11)) and {s for _, s in got[0]} == {0.5}
    few = found(ann.nearest(df.where("vec_id between 40 and 44"), F.col("id") == 40))
    assert [i for i, _ in few[40]] == [41, 42, 43, 44]
    assert ann.nearest(df.where("false"), F.col("id") % 100 == 0).count() == 0
