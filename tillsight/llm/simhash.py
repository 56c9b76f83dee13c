"""SimHash near-duplicate groups by multi-index hashing.

1. **Fingerprints** are made in the task that reads a text (no shuffle): XXH64 of every word
   shingle, a bit where more than half of the hashes have it.
2. **Distinct fingerprints** go on; copies with one fingerprint are one node from here on, however
   many there are.
3. **Multi-index hashing.** A fingerprint has `segments` equal segments. If two differ in at most
   `bits` bits, some segment differs in at most `bits // segments`; the Hamming balls of half that
   radius around both sides' segments then share a value (radius rounded up). Each fingerprint is
   entered under every value of its balls, and rows that meet under a value are verified on all
   64 bits. With two segments and four bits that is 33 entries a segment; a table of 2^32 values
   keeps chance meetings rare.
4. **Hot values.** A value with at most `bucket` fingerprints is joined directly, so the work is at
   most `bucket` verifications an entry. All fingerprints of fuller values go an exact other way: they
   are entered under every 64-bit point within `bits / 2`, where two meet if and only if they
   differ in at most `bits` bits. That needs no verification, costs a fixed number of entries a
   fingerprint, and links each to the smallest one at the point instead of to all others.
5. **Components** by repeated min-label contraction over the verified links, checkpointed in the
   session's shared folder.

Defined cases: null and blank texts have fingerprint zero and are linked like any other; fewer
words than a shingle make one shingle of all words; repeated rows share a fingerprint; a component
without any doc_id has a null component_id; other columns pass through.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import append_columns, free_name, release, shuffled, stored
from tillsight.session import checkpoint_dir

SEED = 42


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 of every run of ``words`` words, lower-cased in ASCII and joined by one space."""
    tokens = text.lower().split()      # for bytes: ASCII case and white space only
    if not tokens:
        return []
    line = b" ".join(tokens)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    k = min(words, len(tokens)) - 1
    starts = [0, *(gaps[:len(gaps) - k] + 1).tolist()]
    ends = [*gaps[k:].tolist(), len(line)]
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(starts, ends, strict=True)]


def fingerprints(texts: list[bytes | None], words: int) -> np.ndarray:
    """Signed 64-bit fingerprints of the texts."""
    out = np.zeros(len(texts), np.uint64)
    for i, t in enumerate(texts):
        h = np.array(shingle_hashes(t or b"", words), np.uint64)
        if len(h):
            ones = np.zeros(64, np.int64)
            for a in range(0, len(h), 1 << 16):
                part = h[a:a + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
                ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
            out[i] = np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0]
    return out.view(np.int64)


def with_fingerprint(docs: DataFrame, name: str, *, text: str = "text", words: int = 4) -> DataFrame:
    """``docs`` with the fingerprint as a long column ``name``."""
    return append_columns(docs, text, [(name, "bigint")],
                          lambda col: [pa.array(fingerprints(col.to_pylist(), words), pa.int64())])


def ball(width: int, radius: int) -> list[int]:
    """Masks of ``width`` bits with at most ``radius`` ones."""
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(prints: DataFrame, *, bits: int = 4, segments: int = 2, bucket: int = 64) -> DataFrame:
    """Links (a, b), a < b, over distinct fingerprints ``fp`` that have the transitive closure of all
    pairs within ``bits`` bits."""
    width = 64 // segments
    # Few narrow rows are about to be many: a number given keeps them on as many tasks.
    prints = prints.repartition(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    near = ball(width, -(-(bits // segments) // 2))
    entries = prints.select("fp", F.posexplode(F.array(*[
        F.shiftrightunsigned("fp", width * s).bitwiseAND((1 << width) - 1) for s in range(segments)])
        ).alias("seg", "part"))
    entries = entries.select("fp", "seg", F.explode(
        F.transform(F.array(*[F.lit(m) for m in near]), lambda m: m.bitwiseXOR(F.col("part")))).alias("at"))
    # Most values of the balls have one entry; they cannot link anything and stop here. The count
    # is a partial aggregate, the members of small values come as one bounded array.
    size = entries.groupBy("seg", "at").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("low"),
                                            F.max("fp").alias("high")).where("n > 1")
    pairs = size.where("n = 2").select(F.col("low").alias("a"), F.col("high").alias("b"))
    more = size.where("n > 2").select("seg", "at", "n")
    met = shuffled(entries).join(more, ["seg", "at"])
    small = (met.where(F.col("n") <= bucket).groupBy("seg", "at").agg(F.sort_array(F.collect_list("fp")).alias("m"))
             .select(F.explode(F.expr(
                 f"flatten(transform(m, (x, i) -> transform(filter(slice(m, i + 2, size(m)), y -> bit_count(x ^ y) <= {bits}),"
                 " y -> struct(x as a, y as b))))")).alias("p")).select("p.a", "p.b"))
    pairs = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits).unionByName(small)
    hot = met.where(F.col("n") > bucket).select("fp").distinct()
    return pairs.unionByName(_through_points(hot, bits)).distinct()


def _through_points(hot: DataFrame, bits: int) -> DataFrame:
    """Exact links of ``hot`` by their common 64-bit points within half of ``bits``, each to the smallest."""
    flips = [_signed(m) for m in ball(64, -(-bits // 2))]
    table = F.array(*[F.lit(m) for m in flips])
    at = hot.repartition("fp").select("fp", F.explode(
        F.transform(table, lambda m: m.bitwiseXOR(F.col("fp")))).alias("at"))
    met = at.groupBy("at").agg(F.collect_set("fp").alias("m")).where(F.size("m") > 1)
    # A point has at most as many members as there are flips.
    out = met.select(F.array_min("m").alias("a"), F.explode("m").alias("b")).where("a < b")
    if bits % 2:       # rounded up: such points also join pairs one bit too far
        out = met.select(F.explode(F.expr(
            f"flatten(transform(m, x -> transform(filter(m, y -> y > x and bit_count(x ^ y) <= {bits}),"
            " y -> struct(x as a, y as b))))")).alias("p")).select("p.a", "p.b")
    return out.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge (a, b): equal roots, and only those, are connected.

    Each round draws a new random order of the nodes, points every node at the first of itself and
    its neighbours, and rewrites the edges to what their ends point at. Edges inside a contracted
    group vanish, and the node count falls by a constant factor in expectation, also on long
    chains. Only the edges and the round's pointers are checkpointed; the roots follow at the end by
    joining the nodes through the pointers of all rounds. A checkpoint keeps the estimate that Spark made before
    its links were exploded, so no join here is left to a broadcast."""
    checkpoint_dir(edges.sparkSession)
    edges = edges.checkpoint()
    release(edges.sparkSession)     # the entries' shuffles, far larger than what follows
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    rounds = 0
    while not edges.isEmpty():
        rounds += 1
        key = lambda c: F.struct(F.xxhash64(c, F.lit(rounds)).alias("h"), F.col(c).alias("v"))  # noqa: E731, B023
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = (both.groupBy("a").agg(F.min(key("b")).alias("m"))
                .select(F.col("a").alias("r"), F.least(key("a"), F.col("m"))["v"].alias("up")).checkpoint())
        labels = (shuffled(labels).join(step, labels["root"] == step["r"], "left")
                  .select("node", F.coalesce("up", "root").alias("root")))
        left = step.select(F.col("r").alias("a"), F.col("up").alias("x"))
        right = step.select(F.col("r").alias("b"), F.col("up").alias("y"))
        edges = (shuffled(shuffled(edges).join(left, "a")).join(right, "b").where("x <> y")
                 .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct().checkpoint())
    release(edges.sparkSession)
    return labels


def label(marked: DataFrame, fingerprint: str, component: str, *, doc_id: str = "doc_id", bits: int = 4,
          segments: int = 2, bucket: int = 64, root: str | None = None) -> DataFrame:
    """``marked`` (rows with a fingerprint) with ``component``, the smallest doc_id reachable, and
    ``root``, one fingerprint of the component, if asked for. It is read more than once, so it should be stored."""
    checkpoint_dir(marked.sparkSession)
    ids = marked.select(F.col(f"`{fingerprint}`").alias("fp"), F.col(f"`{doc_id}`").alias("doc"))
    nodes = ids.groupBy("fp").agg(F.min("doc").alias("low")).checkpoint()
    roots = components(links(nodes.select("fp"), bits=bits, segments=segments, bucket=bucket))
    named = (shuffled(nodes).join(roots.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("root", F.coalesce("root", "fp")))
    lows = named.groupBy("root").agg(F.min("low").alias("component"))
    named = shuffled(named).join(lows, "root").select("fp", "root", "component")
    # One fingerprint may hold a third of all rows: rows are salted, and the narrow table of
    # labels is repeated once a salt.
    salts = 16
    salt = free_name(marked, "salt")
    dealt = marked.withColumn(salt, F.pmod(F.xxhash64(f"`{doc_id}`"), F.lit(salts)).cast("int"))
    table = named.select(F.col("fp").alias("_f"), F.col("root").alias("_r"), F.col("component").alias("_c"),
                         F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_s"))
    out = dealt.join(shuffled(table), (dealt[f"`{fingerprint}`"] == table["_f"]) & (dealt[f"`{salt}`"] == table["_s"]))
    more = [table["_r"].alias(root)] if root else []
    return out.select(*[dealt[f"`{c}`"] for c in marked.columns], table["_c"].alias(component), *more)


def keep_one(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", words: int = 4, bits: int = 4) -> DataFrame:
    """One row of each component, one with the smallest doc_id; ``docs``' columns.

    Rows are known by (doc_id, hash of all columns) while groups are found, so texts are read twice and
    shuffled once."""
    key, fp = free_name(docs, "key"), free_name(docs, "fp")
    row = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    marked = with_fingerprint(docs.withColumn(key, row), fp, text=text, words=words).select(
        F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{key}`").alias("row"), F.col(f"`{fp}`").alias("fp"))
    grouped = label(stored(marked, "simhash"), "fp", "component", doc_id="doc", bits=bits, root="root")
    first = grouped.where(F.col("doc").eqNullSafe(F.col("component")))
    counted = first.groupBy("root", "doc", "row").agg(F.count(F.lit(1)).alias("same"))
    pick = counted.groupBy("root").agg(F.min(F.struct("row", "doc", "same")).alias("p")).select(
        F.col("p.doc").alias("_pd"), F.col("p.row").alias("_pr"), F.col("p.same").alias("_ps"))
    named = docs.withColumn(key, row)
    kept = shuffled(named).join(pick, named[f"`{doc_id}`"].eqNullSafe(pick["_pd"]) & (named[f"`{key}`"] == pick["_pr"]))
    # Equal rows all match; one of them stays.
    once = kept.where("_ps = 1")
    more = kept.where("_ps > 1").dropDuplicates(["_pd", "_pr"])
    return once.unionByName(more).select(*[f"`{c}`" for c in docs.columns])
