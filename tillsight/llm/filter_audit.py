"""Audit of how filters interact, over sorted posting lists of failing ids.

1. Every document is judged by every filter once; the rows kept are narrow (part, id, filters failed).
   Repeated rows of one id that fail alike become one posting with a weight.
2. **Posting lists.** For every part (the language) and range of `RANGE` ids, one row holds a sorted list of
   failing ids per filter, one of the ids labelled good and one of those labelled toxic. A list has at most
   RANGE ids times the 32 ways to fail, so no group grows with the corpus.
3. **Unions and differences.** In each range the union of every set of filters is a k-way merge of its lists
   that gallops: from list to list it steps over the run of ids below the other's head by doubling
   steps and a bisection, and copies the run whole. A set's union is that of the set without its shortest
   list, merged with that list, so a merge costs the short list's length. What a filter removes after
   others is the difference of two unions.
4. Sizes are summed over the ranges of a part; every order's prefixes are among the sets, so an order of any
   length is read off the sums. Only these sums meet the orders.

The duplicate filter compares whole texts by SHA-256; the smallest id of each text is found by an aggregate,
and texts that a large share of all rows have meet it through a broadcast (see ``common.meet``).

Defined cases: a null text is empty; a null part is the empty string; of a null id no other id is smaller
and it is smaller than none, and labels do not reach it; repeated rows are documents each; of repeated
labels one is enough; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import in_arrow, meet, stored

LETTERS = "ABCDE"
RANGE = 1 << 16
#: Ways to fail: an id's place in a list is offset * WAYS + its failed filters.
WAYS = 1 << len(LETTERS)
WORDS = r"[ \t\n\x0B\f\r]+"


def verdicts(text: Column) -> Column:
    """Failed filters A to D as bits 1, 2, 4, 8 (E needs the other documents)."""
    words = F.filter(F.split(text, WORDS), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return F.transform(F.array(F.struct(words.alias("w"))), lambda x: (
        F.when(F.size(x["w"]) < 100, 1).otherwise(0)
        + F.when(100 * F.size(F.array_distinct(x["w"])) < 80 * F.size(x["w"]), 2).otherwise(0)
        + F.when(100 * capitals > 10 * F.length(text), 4).otherwise(0)
        + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0)))[0]


def judged(docs: DataFrame, text: str = "text", part: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """(part, id, failed): one row a document, the five filters' failures as bits."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    facts = stored(docs.select(F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                               F.col(f"`{doc_id}`").cast("long").alias("id"), verdicts(body).alias("failed"),
                               F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest")), "audit-facts")
    groups = facts.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = meet(facts, stored(groups, "audit-copies"), ["digest"], "n")
    copy = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    return met.select("part", "id", (F.col("failed") + F.when(copy, 16).otherwise(0)).cast("int").alias("failed"))


def postings(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a part and id range: documents, the failing lists A to E, good, toxic, and the weights of postings
    that stand for several documents (``heavy``)."""
    merged = rows.groupBy("part", "id", "failed").agg(F.count(F.lit(1)).alias("weight"))
    marks = labels.select(F.col("doc_id").cast("long").alias("_id"), "quality", "toxic").where("_id IS NOT NULL").groupBy("_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad"))
    marked = merged.join(marks, F.col("id") == F.col("_id"), "left")
    code = (F.pmod("id", F.lit(RANGE)) * WAYS + F.col("failed")).cast("int")
    code = F.coalesce(code, F.col("failed"))                       # the null id has a range of its own
    held = lambda cond: F.sort_array(F.collect_list(F.when(cond, code)))
    bits = [F.col("failed").bitwiseAND(1 << k) != 0 for k in range(len(LETTERS))]
    span = F.floor(F.col("id") / RANGE).alias("span")
    return marked.groupBy("part", span).agg(
        F.sum("weight").alias("docs"), *[held(b).alias(x) for x, b in zip(LETTERS, bits, strict=True)],
        held(F.col("good")).alias("good"), held(F.col("bad")).alias("toxic"),
        F.sort_array(F.collect_list(F.when(F.col("weight") > 1, F.struct(code.alias("id"), "weight")))).alias("heavy"))


def gallop(ids: list, x: int, at: int) -> int:
    """First place from ``at`` on whose id is ``x`` or more: steps doubled, then a bisection."""
    step, n = 1, len(ids)
    while at + step < n and ids[at + step] < x:
        step *= 2
    return bisect_left(ids, x, at + step // 2, min(n, at + step + 1))


def union(lists: list[list]) -> list:
    """Galloping k-way merge of sorted lists, each id once: the longest is the base, the shorter ones' runs
    come in between."""
    lists = sorted(lists, key=len)
    out = lists.pop() if lists else []
    while lists:
        more, base, out, i, j = lists.pop(), out, [], 0, 0
        while j < len(more):
            k = gallop(base, more[j], i)
            out += base[i:k]
            i = k
            if i == len(base):
                break
            if base[i] == more[j]:
                j += 1
                continue
            k = gallop(more, base[i], j)
            out += more[j:k]
            j = k
        out += base[i:] if i < len(base) else more[j:]
    return out


def common(few: list, many: list) -> list:
    """Ids in both lists; gallops through ``many``."""
    out, at = [], 0
    for x in few:
        at = gallop(many, x, at)
        if at == len(many):
            break
        if many[at] == x:
            out.append(x)
    return out


def set_sizes(row: dict) -> list[tuple[int, int, int, int]]:
    """(set of filters, documents, good ones, toxic ones in the union of its lists) for every set."""
    lists = sorted(range(len(LETTERS)), key=lambda k: -len(row[LETTERS[k]]))
    heavy = {h["id"]: h["weight"] for h in row["heavy"]}
    weight = lambda ids: len(ids) + sum(heavy.get(x, 1) - 1 for x in ids) if heavy else len(ids)
    held, out = {0: []}, [(0, 0, 0, 0)]
    for k in lists:                                        # the shortest list joins last
        for s in list(held):
            ids = union([held[s], row[LETTERS[k]]])
            held[s | 1 << k] = ids
            out.append((s | 1 << k, weight(ids), weight(common(row["good"], ids)), weight(common(row["toxic"], ids))))
    return out


def union_sizes(lists: DataFrame) -> DataFrame:
    """(part, docs, sizes): of every part the sizes of all unions, by set number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["part"], *x) for r in batch.to_pylist() for x in set_sizes(r)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["part", "filters", "n", "good", "toxic"])

    sizes = in_arrow(lists, run, "part string, filters int, n bigint, good bigint, toxic bigint")
    sums = sizes.groupBy("part", "filters").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    # 32 rows a part
    by_set = sums.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("filters", "n", "good", "toxic"))).alias("sizes"))
    docs = lists.groupBy("part").agg(F.sum("docs").alias("docs"))
    return docs.join(by_set, "part")


def orders() -> Column:
    """All orders and steps as one constant array: filter_order, step, filters before and with the step's."""
    out = []
    for p in permutations(range(len(LETTERS))):
        before = 0
        for i, k in enumerate(p):
            out.append({"filter_order": "".join(LETTERS[x] for x in p), "step": i + 1, "before": before, "own": 1 << k})
            before |= 1 << k
    return F.from_json(F.lit(json.dumps(out)), "array<struct<filter_order:string,step:int,before:int,own:int>>")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a part, order and step with the counts of that step."""
    lists = stored(postings(judged(docs), labels), "audit-postings")
    sizes = union_sizes(lists)
    steps = sizes.withColumn("o", F.explode(orders()))
    full = WAYS - 1
    at = lambda filters, field: F.element_at(F.col("sizes"), (filters + 1).cast("int"))[field]
    before, own = F.col("o.before"), F.col("o.own")
    after = before.bitwiseOR(own)
    gain = lambda field: at(after, field) - at(before, field)
    # Over all orders the sets before a filter are each met as often as the rest can be arranged.
    orders_of = (24, 6, 4, 6, 24)
    worth = sum((at(F.lit(s).bitwiseOR(own), "n") - at(F.lit(s), "n")) * F.when(F.lit(s).bitwiseAND(own) == 0, orders_of[s.bit_count()])
                .otherwise(0) for s in range(full))
    return steps.select(
        "part", F.col("o.filter_order").alias("filter_order"), F.col("o.step").alias("step"),
        (F.col("docs") - at(after, "n")).alias("kept"), gain("n").alias("removed"),
        (at(own, "n") - gain("n")).alias("redundant"),
        (at(F.lit(full), "n") - at(F.lit(full).bitwiseXOR(own), "n")).alias("unique_fails"),
        gain("good").alias("good_lost"), gain("toxic").alias("toxic_lost"), worth.alias("shapley"))


#: DuckDB SQL of ``audit`` over documents and labels: flags joined to the 600 steps.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, part, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
f AS (SELECT doc_id, part, len(ws) < 100 AS a, 100 * len(list_distinct(ws)) < 80 * len(ws) AS b,
  100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * len(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
  coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM w),
lab AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, [a, b, c, d, e] AS flags, count(*) AS n, count(*) FILTER (coalesce(good, false)) AS good,
  count(*) FILTER (coalesce(toxic, false)) AS toxic FROM f LEFT JOIN lab USING (doc_id) GROUP BY part, flags),
k(x) AS (SELECT unnest(range(1, 6))),
perms AS (SELECT [p.x, q.x, r.x, s.x, t.x] AS o FROM k p, k q, k r, k s, k t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps AS (SELECT o, k.x AS step FROM perms, k),
c AS (SELECT part, o, step, o[step] AS own,
  sum(n) FILTER (NOT list_contains(list_transform(o[1:step], lambda i: flags[i]), true)) AS kept,
  sum(n) FILTER (flags[o[step]] AND NOT list_contains(list_transform(o[1:step - 1], lambda i: flags[i]), true)) AS removed,
  sum(n) FILTER (flags[o[step]] AND list_contains(list_transform(o[1:step - 1], lambda i: flags[i]), true)) AS redundant,
  sum(n) FILTER (flags[o[step]] AND len(list_filter(flags, lambda v: v)) = 1) AS unique_fails,
  sum(good) FILTER (flags[o[step]] AND NOT list_contains(list_transform(o[1:step - 1], lambda i: flags[i]), true)) AS good_lost,
  sum(toxic) FILTER (flags[o[step]] AND NOT list_contains(list_transform(o[1:step - 1], lambda i: flags[i]), true)) AS toxic_lost
  FROM m, steps GROUP BY part, o, step)
SELECT part, array_to_string(list_transform(o, lambda i: chr(CAST(64 + i AS INTEGER))), '') AS filter_order,
  CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS BIGINT) AS shapley
FROM c
"""
