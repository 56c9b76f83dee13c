"""Nearest neighbours with vantage-point trees per shard.

Rows are dealt to shards of about `shard_rows` by a hash of their id. A task builds one tree a shard:
a node takes one vector as vantage point and splits the rest at their median distance from it;
leaves hold `leaf` vectors. The trees are stored once, one row a shard. Queries go through in blocks of
about `block` vectors: a block is broadcast (its size is bounded by the block), every task searches its
shards for the whole block, and the shards' best k are merged by query.

A search keeps the distance r of the k-th best so far. By the triangle inequality the inside of a
ball of radius m around a vantage point at distance d holds nothing nearer than d - m, the outside
nothing nearer than m - d; a side is skipped if `relax` times that bound exceeds r. With relax = 1
nothing that counts can be skipped and the search is exact; larger values skip more and may miss
neighbours. Distances are computed on the original vectors in double precision.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part, as
queries or candidates; rows without an id take no part; rows that repeat an id are one row, the
one with the smallest vector; vectors are compared with those of their own length; equal distances go to
the smaller id; with fewer candidates than k all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import in_arrow, ship, stored
from tillsight.session import checkpoint_dir

SHARD_ROWS, LEAF, BLOCK = 8192, 64, 2048
RELAX = 1.15


class Tree:
    """Vantage-point tree over the rows of a shard, as arrays. Nodes are numbered in preorder."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.rows = np.arange(len(ids))
        self.nodes: list[tuple[int, int, int, float]] = []      # first row, end, middle (0: leaf), radius
        self._grow(0, len(ids), leaf, np.random.default_rng(1))

    def _grow(self, a: int, b: int, leaf: int, rng: np.random.Generator) -> None:
        todo = [(a, b)]
        self.kids: dict[int, tuple[int, int]] = {}
        parent: list[tuple[int, int]] = [(-1, 0)]
        while todo:
            (a, b), (up, side) = todo.pop(), parent.pop()
            node = len(self.nodes)
            if up >= 0:
                self.kids.setdefault(up, [-1, -1])[side] = node
            if b - a <= leaf:
                self.nodes.append((a, b, 0, 0.0))
                continue
            rows = self.rows[a:b]
            # The point whose distances to a few others spread most makes the sharpest cut.
            some = self.vectors[rng.choice(rows, min(len(rows), 24), replace=False)]
            tries = rng.choice(len(rows), min(len(rows), 8), replace=False)
            spread = [np.std(distances(self.vectors[rows[i]], some)) for i in tries]
            i = int(tries[int(np.argmax(spread))])
            rows[[0, i]] = rows[[i, 0]]
            d = distances(self.vectors[rows[0]], self.vectors[rows[1:]])
            cut = len(d) // 2
            part = np.argpartition(d, cut)
            rows[1:] = rows[1:][part]
            self.nodes.append((a, b, a + 1 + cut, float(d[part[cut]])))
            todo += [(a + 1 + cut, b), (a + 1, a + 1 + cut)]
            parent += [(node, 1), (node, 0)]

    def search(self, qids: np.ndarray, queries: np.ndarray, k: int, relax: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of each query's k nearest other rows ((queries, k); id -1 pads)."""
        best_d = np.full((len(queries), k), np.inf)
        best_i = np.full((len(queries), k), -1, np.int64)

        def offer(which: np.ndarray, rows: np.ndarray, d: np.ndarray) -> None:
            ids = np.broadcast_to(self.ids[rows], d.shape)
            d = np.where(ids == qids[which][:, None], np.inf, d)
            alld = np.concatenate([best_d[which], d], 1)
            alli = np.concatenate([best_i[which], np.where(np.isinf(d), np.iinfo(np.int64).max, ids)], 1)
            top = np.lexsort((alli, alld), axis=1)[:, :k]
            best_d[which] = np.take_along_axis(alld, top, 1)
            best_i[which] = np.take_along_axis(alli, top, 1)

        stack = [(0, np.arange(len(queries)), np.zeros(len(queries)))]
        while stack:
            node, which, bound = stack.pop()
            open_ = relax * bound <= best_d[which, -1]       # the bound may have been overtaken meanwhile
            which = which[open_]
            if not len(which):
                continue
            a, b, mid, radius = self.nodes[node]
            if not mid:
                rows = self.rows[a:b]
                for s in range(0, len(which), 256):
                    part = which[s:s + 256]
                    offer(part, rows, distances(queries[part][:, None, :], self.vectors[rows][None, :, :]))
                continue
            rows = self.rows[a:a + 1]
            d = distances(queries[which], self.vectors[rows])
            offer(which, rows, d[:, None])
            inside, outside = self.kids[node]
            near = d <= radius
            low_in, low_out = np.maximum(d - radius, 0), np.maximum(radius - d, 0)
            # Each query sees its nearer side first; the stack pops last in, first out.
            stack.append((outside, which[near], low_out[near]))
            stack.append((inside, which[~near], low_in[~near]))
            stack.append((inside, which[near], low_in[near]))
            stack.append((outside, which[~near], low_out[~near]))
        return np.where(np.isinf(best_d), -1, best_i), best_d


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances over the last axis, double precision."""
    x = a - b
    return np.sqrt(np.einsum("...i,...i->...", x, x))


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, v, dim): distinct ids with a finite, non-zero vector in doubles."""
    v = F.col(f"`{embedding}`").cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0))
    return rows.groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


def build(rows: DataFrame, *, shard_rows: int = SHARD_ROWS, leaf: int = LEAF) -> DataFrame:
    """The stored index: (dim, shard, tree), a row a shard. Shards hold about ``shard_rows`` rows."""
    checkpoint_dir(rows.sparkSession)
    ship(rows.sparkSession)
    n = {r["dim"]: max(1, -(-r["count"] // shard_rows)) for r in rows.groupBy("dim").count().collect()}   # a row a length
    if not n:
        return rows.sparkSession.createDataFrame([], "dim int, shard int, tree binary")
    shards = F.create_map(*[F.lit(x) for d, c in n.items() for x in (d, c)])

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(pdf["id"].to_numpy(), np.stack(pdf["v"].to_numpy()).astype(np.float64), leaf)
        return pd.DataFrame({"dim": pdf["dim"].iloc[:1].astype("int32"), "shard": pdf["shard"].iloc[:1].astype("int32"),
                             "tree": [pickle.dumps(tree, protocol=5)]})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), shards[F.col("dim")]).cast("int"))
    # As many partitions as shards, so that a task builds about one.
    dealt = dealt.repartition(sum(n.values()), "dim", "shard")
    return stored(dealt.groupBy("dim", "shard").applyInPandas(grow, "dim int, shard int, tree binary"), "ann-index")


def search(queries: DataFrame, index: DataFrame, *, k: int = 10, relax: float = RELAX, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows of ``index`` to each row (id, v, dim)
    of ``queries``; a query's own id is no candidate."""
    spark = queries.sparkSession
    n = {r["dim"]: max(1, -(-r["count"] // block)) for r in queries.groupBy("dim").count().collect()}     # a row a length
    parts = []
    for dim, blocks in sorted(n.items()):
        own = queries.where(F.col("dim") == dim)
        trees = index.where(F.col("dim") == dim).select("tree")
        trees = trees.repartition(max(1, min(index.where(F.col("dim") == dim).count(),
                                             spark.sparkContext.defaultParallelism * 4)))
        for b in range(blocks):
            rows = own.where(F.pmod(F.xxhash64("id", F.lit("block")), F.lit(blocks)) == b).select("id", "v").toArrow()
            held = spark.sparkContext.broadcast((
                rows.column(0).to_numpy(), np.array(rows.column(1).to_pylist(), np.float64).reshape(-1, dim)))

            def look(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
                qids, q = held.value
                for batch in batches:
                    for body in batch.column(0).to_pylist():
                        ids, d = pickle.loads(body).search(qids, q, k, relax)
                        hit = np.isfinite(d)
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.repeat(qids, hit.sum(1))), pa.array(ids[hit]), pa.array(d[hit])],
                            names=["query_id", "vec_id", "score"])

            parts.append(in_arrow(trees, look, "query_id bigint, vec_id bigint, score double"))
    if not parts:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")      # at most k rows a shard and query
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def nearest(vectors: DataFrame, is_query: Column, *, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 10,
            relax: float = RELAX, shard_rows: int = SHARD_ROWS, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """The k nearest other rows of every row whose ``id`` fulfils ``is_query``."""
    rows = stored(usable(vectors, vec_id, embedding), "ann-rows")
    index = build(rows, shard_rows=shard_rows, leaf=leaf)
    return search(rows.where(is_query), index, k=k, relax=relax, block=block)
