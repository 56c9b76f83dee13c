"""Mixing sources to target weights by subset-sum budget fitting.

1. Every document's size (number of words) is stored once as a narrow table; sizes are then counted
   by (source, size): the exact length histogram, partial aggregates first.
2. **Targets.** Sources in code point order (null last) weigh 1, 2, 3, repeating, and share all words;
   a target stops at `MOST` times its source's words and the excess is shared again by weight.
   That is min(MOST * words, level * weight) with the one level at which the targets add up to
   the total; the level is found by a few one-row aggregates over the sources.
3. **Budget fitting.** A source gives floor(target / words) whole repeats; the rest of the budget is
   filled from its length histogram: the same share of every length first, longest lengths topped up, then a
   bounded-knapsack dynamic program over the lengths left picks the subset whose sum is nearest
   to what remains. The program's table holds at most twice `cells` sums; a larger remainder only stays where all
   documents left exceed half of it, and then one or two of them are chosen directly.
4. **Selection** by length count: of a (source, size) as many documents as the fit says, in the order of
   a seeded hash of doc_id. Hash buckets are counted first, so only one bucket of a length is
   ranked row by row, and no length, however frequent, is sorted in one task.

A source's histogram has at most as many rows as it has distinct lengths, which grows with the
square root of its words at most; it is fitted in one task. No other group is gathered.

Defined cases: a null or blank text has size 0 and is never taken; repeated rows are documents each
(which of the equal rows is taken is not defined, and does not show in their values); null is a source
of its own, the last; a table without words gives targets 0; other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import WORD_PATTERN, free_name, if_small, ship, shuffled, stored
from tillsight.operators.ranking import sequence
from tillsight.session import checkpoint_dir

MOST = 3
SEED = 20
BUCKETS = 256
CELLS = 1 << 20


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size) with ``target``."""
    order = sources.select("source", "source_size", F.col("source").isNull().alias("last"))
    numbered = sequence(order, [("last", True), ("source", True)], row_number="place")
    s = numbered.select("source", "source_size", ((F.col("place") - 1) % 3 + 1).cast("double").alias("weight"),
                        (F.lit(float(most)) * F.col("source_size")).alias("stop")).checkpoint()
    total = float(s.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while total:       # rises to the level where the targets share the total; one row comes back a round
        r = s.agg(F.sum(F.when(F.col("stop") <= level * F.col("weight"), F.col("stop")).otherwise(0.0)).alias("full"),
                  F.sum(F.when(F.col("stop") > level * F.col("weight"), F.col("weight")).otherwise(0.0)).alias("w")).first()
        higher = (total - r["full"]) / r["w"] if r["w"] else level
        if higher <= level:
            break
        level = higher
    return s.select("source", "source_size", F.least("stop", F.lit(level) * F.col("weight")).alias("target"))


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, cells: int = CELLS) -> np.ndarray:
    """How many documents of each size to take so that the sum of sizes comes near ``budget``, which is
    at most the sum of all. Sizes are positive and distinct."""
    take = np.zeros(len(sizes), np.int64)
    total = int((sizes * counts).sum())
    if budget <= 0 or not total:
        return take
    if budget >= total:
        return counts.astype(np.int64)
    take += counts * budget // total if total < 1 << 31 else (counts * (budget / total)).astype(np.int64)
    left = budget - int((sizes * take).sum())
    order = np.argsort(-sizes)
    # Top up with the longest that fit, but leave room for the program to choose from. If more than `cells` stays,
    # no size that is left fits into it less half the room: each exceeds half of it.
    room = min(cells, max(1024, 2 * int(sizes.max())))
    for i in order:
        if left <= room:
            break
        k = min(int(counts[i] - take[i]), max(0, (left - room // 2) // int(sizes[i])))
        take[i] += k
        left -= k * int(sizes[i])
    rest = counts - take
    return take + (one_or_two(sizes, rest, left) if left > cells else subset_sum(sizes, rest, left))


def one_or_two(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """The same for a budget that every size exceeds the half of, without a table: none, one or two documents.
    Two add up to more than the budget, so the two shortest are the nearest pair, and a third only leads away."""
    order = [int(i) for i in np.argsort(sizes) if counts[i] > 0]
    pair = [i for i in order[:2] for _ in range(int(min(counts[i], 2)))][:2]
    best = min([[], *([i] for i in order), pair], key=lambda ids: (abs(sum(int(sizes[i]) for i in ids) - budget),
                                                                 sum(int(sizes[i]) for i in ids)))
    take = np.zeros(len(sizes), np.int64)
    np.add.at(take, best, 1)
    return take


def subset_sum(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack: counts per size whose sum is nearest to ``budget`` (ties: below it)."""
    take = np.zeros(len(sizes), np.int64)
    # One step above may be nearer, but what lies beyond twice the budget is farther than nothing at all.
    reach_to = budget + min(budget, int(max(sizes[counts > 0], default=0)))
    item_of = np.full(reach_to + 1, -1, np.int32)     # which item first reached a sum
    reached = np.zeros(reach_to + 1, bool)
    reached[0] = True
    items: list[tuple[int, int]] = []                 # (size index, documents): counts in powers of two
    for i in np.argsort(-sizes):
        size, left, k = int(sizes[i]), int(min(counts[i], reach_to // int(sizes[i]))), 1
        while left > 0 and not reached[budget]:
            n = min(k, left)
            step = n * size
            if step <= reach_to:
                fresh = np.flatnonzero(reached[:reach_to + 1 - step] & ~reached[step:]) + step
                item_of[fresh] = len(items)
                reached[fresh] = True
                items.append((int(i), n))
            left -= n
            k *= 2
        if reached[budget]:
            break
    sums = np.flatnonzero(reached)
    s = int(sums[np.argmin(np.abs(sums - budget))])
    while s:
        i, n = items[item_of[s]]
        take[i] += n
        s -= n * int(sizes[i])
    return take


def mix(docs: DataFrame, *, text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: int = SEED,
        most: int = MOST, cells: int = CELLS) -> DataFrame:
    """(doc_id, size, source_size, target, repeats, taken) of every document; taken = repeats * size."""
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
                         size_of(F.col(f"`{text}`")).alias("size"))
    return plan(stored(narrow, "mixing"), seed=seed, most=most, cells=cells).select(
        "doc_id", "size", "source_size", "target", "repeats", (F.col("repeats") * F.col("size")).alias("taken"))


def plan(narrow: DataFrame, *, seed: int = SEED, most: int = MOST, cells: int = CELLS) -> DataFrame:
    """``narrow`` (source, size, doc_id and more), which is read more than once, with source_size,
    target and repeats."""
    checkpoint_dir(narrow.sparkSession)
    ship(narrow.sparkSession)
    bucket = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(BUCKETS)).cast("int")
    rows = narrow.withColumn("_b", bucket)
    histogram = rows.groupBy("source", "size", "_b").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    lengths = histogram.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sources = lengths.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    goal = targets(sources, most).withColumn("whole", F.when(F.col("source_size") > 0, F.floor(
        F.col("target") / F.col("source_size"))).otherwise(0).cast("long")).withColumn(
        "budget", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")).checkpoint()
    g = goal.withColumnRenamed("source", "_s")

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size")
        pdf["pick"] = fit(pdf["size"].to_numpy(), pdf["n"].to_numpy(), int(pdf["budget"].iloc[0]), cells)
        return pdf[["source", "size", "pick"]]

    kind = narrow.schema["source"].dataType.simpleString()
    asked = lengths.where("size > 0").join(g, F.col("source").eqNullSafe(F.col("_s"))).select("source", "size", "n", "budget")
    picks = asked.groupBy("source").applyInPandas(fitted, f"source {kind}, size bigint, pick bigint")
    # Of a length, the buckets before the last one are taken whole, and the last one in part.
    p = picks.where("pick > 0").withColumnsRenamed({"source": "_ps", "size": "_pz"})
    w = Window.partitionBy("source", "size").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    share = (shuffled(histogram.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0))))
             .join(p, F.col("source").eqNullSafe(F.col("_ps")) & (F.col("size") == F.col("_pz")))
             .select(F.col("source").alias("_hs"), F.col("size").alias("_hz"), F.col("_b").alias("_hb"),
                     F.least(F.greatest(F.col("pick") - F.col("before"), F.lit(0)), F.col("n")).alias("some"),
                     F.col("n").alias("all")).where("some > 0").checkpoint())
    out = shuffled(rows).join(share, F.col("source").eqNullSafe(F.col("_hs")) & (F.col("size") == F.col("_hz"))
                              & (F.col("_b") == F.col("_hb")), "left")
    # Only buckets taken in part are ranked: one a length.
    part = F.col("some") < F.col("all")
    order = Window.partitionBy("source", "size", "_b").orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id")
    ranked = out.where(part).withColumn("_more", (F.row_number().over(order) <= F.col("some")).cast("long"))
    rest = out.where(part.isNull() | ~part).withColumn("_more", F.when(F.col("some").isNotNull(), 1).otherwise(0).cast("long"))
    both = ranked.unionByName(rest)
    both = both.join(if_small(goal.withColumnRenamed("source", "_g")), F.col("source").eqNullSafe(F.col("_g")))
    return both.select(*[f"`{c}`" for c in narrow.columns], "source_size", "target",
                       F.when(F.col("size") > 0, F.col("whole") + F.col("_more")).otherwise(0).cast("long").alias("repeats"))


def apply_mix(docs: DataFrame, *, text: str = "text", source: str = "source", doc_id: str = "doc_id",
              seed: int = SEED, most: int = MOST) -> DataFrame:
    """The mix itself: every document as often as the plan takes it; ``docs``' columns."""
    checkpoint_dir(docs.sparkSession)
    body = free_name(docs, "row")
    packed = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
                         size_of(F.col(f"`{text}`")).alias("size"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("key"))
    chosen = plan(stored(packed, "mixing"), seed=seed, most=most)
    # Rows are known by (doc_id, hash of all columns); equal rows share the sum of their repeats.
    times = chosen.groupBy("doc_id", "key").agg(F.sum("repeats").alias("times"), F.count(F.lit(1)).alias("same"))
    times = times.where("times > 0").withColumnsRenamed({"doc_id": "_d", "key": "_k"})
    key = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    named = docs.withColumn(body, key)
    out = shuffled(named).join(times, named[f"`{doc_id}`"].eqNullSafe(times["_d"]) & (named[f"`{body}`"] == times["_k"]))
    # Equal rows: each is repeated the floor of its share; one of them carries the remainder.
    n = F.when(F.col("same") == 1, F.col("times")).otherwise(F.floor(F.col("times") / F.col("same")))
    whole = out.withColumn("_n", n)
    extra = (out.where("same > 1").dropDuplicates(["_d", "_k"])
             .withColumn("_n", F.col("times") % F.col("same")))
    spread = lambda df: df.where("_n > 0").select(*[F.col(f"`{c}`") for c in docs.columns],
                                                  F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_i")).drop("_i")
    return spread(whole).unionByName(spread(extra))
