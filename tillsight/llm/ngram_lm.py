"""Language-model scoring with a log-frequency Bloom filter of quantised n-gram counts.

**Tokens**: words in ASCII lower case, then one end token a text. A token is known by a 64-bit hash
of its bytes, computed with numpy over whole chunks (two tokens of a corpus with a billion
different ones share a hash with probability of about 0.03).

**Counts.** Tasks pre-aggregate hashes a chunk; one shuffle sums them. Tokens keep exact counts (the
base score is exact); pairs of neighbouring tokens that occur at least `min_count` times (1: all of
them) enter the filter: a pair of count c is inserted under levels 1..q with q = 1 + floor(log_BASE(c)),
so a reader probes levels upwards until the first miss and takes the middle of the last level that
answered. Every context is a token, and beside its count stands the mass of its kept pairs: the sum of
their dequantised, discounted counts in units of 1/UNITS, so that the probabilities of a context add up
to 1 whatever the quantisation did to its counts. (False positives of the filter add to that sum.)

**Model**: absolute discounting with back-off to the smoothed token model,
P(w|h) = max(E(h,w) - D, 0) / c(h) + (1 - M(h) / c(h)) * P0(w), P0(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)),
with E the middle of the filter's level and M(h) the stored mass. Where M(h) / c(h) exceeds MOST, the first
term and the share are both scaled down to MOST. A text's first token has only P0.

**Contexts** are known by the upper 47 bits of the token's hash: 31 in the pair's key, 16 carried beside it
through the one shuffle of pairs. Of a billion different tokens about one in 140,000 shares its mass with another.

**Segments.** Tables are cut by hash range into segments that are built inside tasks, each of
bounded size. Where all fit into `broadcast_bytes`, they are broadcast and texts are scored as they are
read. Beyond that nothing is broadcast: rows are stored in chunks, a chunk asks every segment for its
distinct tokens and pairs (one shuffle, to the tasks that hold the segments), and the answers meet the
chunk again (a second one). The numbers are the same, and disk and time grow with the input only.

Defined cases: a null text is an empty text (one end token); an empty table gives an empty result,
and without training tokens N = V = 0 and every token has P0 = 1 / 1; repeated rows are counted
and scored each; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tillsight.llm.common import (ASCII_LOWER, append_columns, as_bytes, buffers, chunks, free_name, in_arrow, release,
                                  stored, without, word_spans)
from tillsight.session import checkpoint_dir

BASE, PROBES, BITS_AN_ENTRY = 2.0, 3, 8
MIN_COUNT, DISCOUNT, MOST = 1, 0.75, 0.9
UNITS = 4                       # DISCOUNT is a whole number of 1/UNITS
INSERT = 1 << 20                # keys put into a filter at a time
BROADCAST_BYTES = 192 << 20
CHUNK = 1 << 20                 # bytes of text hashed at a time: a dozen arrays of 8 bytes a byte
SEGMENT_TOKENS = 8_000_000      # training tokens a segment is sized for
_rng = np.random.default_rng(20)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
END = np.uint64(0x5851F42D4C957F2C)
_ONE, _LOW = np.uint64(1), np.uint64(0xFFFFFFFF)
_PREFIX = ~np.uint64((1 << 17) - 1)     # the bits of a token's hash that name it as a context
_WIDE = 0xFFFFFFFF


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(max(0, n - 1), _STEP)]))


def token_hashes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash (an even number) and text number of every token, in order; each text ends in END."""
    buf, offs = buffers(col)
    start, end, text = word_spans(ASCII_LOWER[buf], offs)
    n = len(offs) - 1
    if not len(start):
        return np.full(n, END), np.arange(n)
    size = (end - start).astype(np.int32)
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum()), dtype=np.int32) - np.repeat(first.astype(np.int32), size)      # place in the word
    value = _BYTE[ASCII_LOWER[buf[np.repeat(start.astype(np.int32), size) + at]]]
    value *= _powers(int(size.max()))[at]
    h = _mix(np.add.reduceat(value, first) + size.astype(np.uint64)) & ~_ONE
    del at, value
    words = np.bincount(text, minlength=n)
    out = np.full(len(h) + n, END)
    out[np.arange(len(h)) + text] = h
    return out, np.repeat(np.arange(n), words + 1)


def pair_hashes(h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key (an odd number) of (previous token, token) at every position, and whether there is a previous
    one. The lower half of a key is bits 17 to 47 of the context; `context_top` has the bits above."""
    has = np.zeros(len(h), bool)
    has[1:] = text[1:] == text[:-1]
    out = np.zeros(len(h), np.uint64)
    out[1:] = _mix(h[:-1] * np.uint64(3) + h[1:] * _STEP) & ~_LOW | h[:-1] >> np.uint64(16) & _LOW | _ONE
    return out, has


def context_top(h: np.ndarray) -> np.ndarray:
    """The upper 16 bits of the previous token at every position."""
    return np.concatenate([h[:1], h[:-1]]) >> np.uint64(48)


def _release() -> None:
    """Give memory that a task has freed back to the system: workers live on, and scoring starts beside them."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def level(count: np.ndarray) -> np.ndarray:
    """Quantised count: 1 + floor(log_BASE(count))."""
    return 1 + np.floor(np.log(np.maximum(count, 1)) / np.log(BASE) + 1e-9).astype(np.int64)


def middle(q: np.ndarray) -> np.ndarray:
    """The count that stands for level q (0 for level 0): the middle of its interval."""
    low = BASE ** (q - 1.0)
    return np.where(q > 0, (low + np.maximum(low, BASE * low - 1)) / 2, 0.0)


class Narrow:
    """Non-negative integers in 32 bits each, with a list of the few that need more."""

    def __init__(self, values: np.ndarray):
        self.low = np.minimum(values, _WIDE).astype(np.uint32)
        self.at = np.flatnonzero(values >= _WIDE)
        self.high = values[self.at].astype(np.int64)

    def __getitem__(self, places: np.ndarray) -> np.ndarray:
        out = self.low[places].astype(np.int64)
        if len(self.at):
            wide = np.flatnonzero(out == _WIDE)
            out[wide] = self.high[np.searchsorted(self.at, places[wide])]
        return out


class Segment:
    """Exact counts of tokens, their masses as contexts, and the log-frequency filter of pairs of one hash range."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, keys: np.ndarray, levels: np.ndarray,
                 contexts: np.ndarray | None = None, masses: np.ndarray | None = None):
        order = np.argsort(tokens)
        self.tokens, self.counts = tokens[order], Narrow(counts[order])
        of = np.zeros(len(tokens), np.int64)
        if contexts is not None and len(contexts):
            order = np.argsort(contexts)
            prefix = self.tokens & _PREFIX
            at = np.searchsorted(contexts[order], prefix).clip(max=len(contexts) - 1)
            of = np.where(contexts[order][at] == prefix, masses[order][at], 0)
        self.masses = Narrow(of)
        self.size = max(64, int(levels.sum()) * BITS_AN_ENTRY)
        self.bits = np.zeros(-(-self.size // 8), np.uint8)
        for q in range(1, int(levels.max(initial=0)) + 1):
            keys, levels = keys[levels >= q], levels[levels >= q]
            for i in range(0, len(keys), INSERT):
                for at in self._places(keys[i:i + INSERT], q):
                    np.bitwise_or.at(self.bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def _places(self, keys: np.ndarray, q: int) -> list[np.ndarray]:
        a = _mix(keys + np.uint64(q * int(_STEP) & 0xFFFFFFFFFFFFFFFF))
        b = _mix(a) | np.uint64(1)
        return [(a + b * np.uint64(j)) % np.uint64(self.size) for j in range(PROBES)]

    def _of(self, values: Narrow, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(tokens), np.int64)
        at = np.searchsorted(self.tokens, tokens).clip(max=len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, values[at], 0)

    def count(self, tokens: np.ndarray) -> np.ndarray:
        return self._of(self.counts, tokens)

    def mass(self, tokens: np.ndarray) -> np.ndarray:
        return self._of(self.masses, tokens)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Probe level after level until the first miss."""
        out = np.zeros(len(keys), np.int64)
        left, q = np.arange(len(keys)), 1
        while len(left) and q < 64:
            hit = np.ones(len(left), bool)
            for at in self._places(keys[left], q):
                hit &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1)) > 0
            left = left[hit]
            out[left] = q
            q += 1
        return out


class Tables:
    """Some segments, by number, of ``n`` over the hash range."""

    def __init__(self, n: int, segments: dict[int, Segment]):
        self.n, self.segments = n, segments

    def resolve(self, keys: np.ndarray, what: Callable[[Segment, np.ndarray], np.ndarray]) -> np.ndarray:
        """``what`` (a method of Segment) of keys; -1 where the key's segment is not here."""
        out = np.full(len(keys), -1, np.int64)
        which = segment_of(keys, self.n)
        order = np.argsort(which, kind="stable")
        edge = np.searchsorted(which[order], np.arange(self.n + 1))
        for s, seg in self.segments.items():
            at = order[edge[s]:edge[s + 1]]
            out[at] = what(seg, keys[at])
        return out


def segment_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


class Model:
    """Totals of the training tokens, and the segments as a stored table. ``spent``: stored tables that only the
    segments were made of."""

    def __init__(self, tokens: int, distinct: int, segments: DataFrame, n: int, sizes: list[int], spent: list[DataFrame]):
        self.tokens, self.distinct, self.segments, self.n, self.sizes = tokens, distinct, segments, n, sizes
        self.spent = spent

    def passes(self, limit: int) -> list[list[int]]:
        """Segment numbers by pass, each within ``limit`` bytes (one segment at least)."""
        out: list[list[int]] = [[]]
        room = limit
        for s, size in enumerate(self.sizes):
            if out[-1] and size > room:
                out.append([])
                room = limit
            out[-1].append(s)
            room -= size
        return out

    def tables(self, numbers: list[int]) -> Tables:
        import pickle

        rows = self.segments.where(F.col("segment").between(numbers[0], numbers[-1])).toLocalIterator()
        none = np.zeros(0, np.uint64)
        empty = Segment(none, none, none, none.astype(np.int64))      # a hash range without any key
        return Tables(self.n, {s: empty for s in numbers} | {r["segment"]: pickle.loads(r["body"]) for r in rows})


def train(docs: DataFrame, usable: Column, *, text: str = "text", min_count: int = MIN_COUNT,
          segment_tokens: int = SEGMENT_TOKENS) -> Model:
    """Count tokens and pairs of the rows where ``usable`` holds, and build the segments."""
    checkpoint_dir(docs.sparkSession)
    fed = docs.where(usable).select(F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from counted(batches)
        _release()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 0, CHUNK):
            h, at = token_hashes(batch.column(0))
            p, has = pair_hashes(h, at)
            top = context_top(h)[has]
            p = p[has]
            order = np.argsort(p)
            p, top = p[order], top[order]
            new = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (top[1:] != top[:-1])])) if len(p) else order
            u, n = np.unique(h, return_counts=True)
            for k, c, m in ((u, np.zeros(len(u)), n), (p[new], top[new], np.diff(np.append(new, len(p))))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k.view(np.int64)), pa.array(c.astype(np.int32)), pa.array(m.astype(np.int64))], names=["k", "c", "n"])

    seen = in_arrow(fed, count, "k bigint, c int, n bigint")
    # Most pairs occur once in the corpus, and they are kept (min_count 1): level 1 of the filter.
    # Keys are hashes, so no key decides the load; odd ones are pairs.
    kind = F.col("k").bitwiseAND(1)
    summed = seen.groupBy("k", "c").agg(F.sum("n").alias("n")).where((kind == 0) | (F.col("n") >= min_count))
    summed = stored(summed.select(kind.cast("int").alias("kind"), "k", "c", "n"), "lm-counts")
    release(docs.sparkSession)
    total = summed.where("kind = 0").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    tokens, distinct = int(total["n"] or 0), int(total["v"])
    # The context of a pair as a token's upper bits; what a pair of count n is worth when it is read back.
    context = F.shiftleft(F.col("c").cast("bigint"), 48).bitwiseOR(F.shiftleft(F.col("k").bitwiseAND(0xFFFFFFFE), 16))
    low = F.pow(F.lit(BASE), F.floor(F.log(BASE, F.col("n")) + 1e-9))
    worth = F.round(((low + F.greatest(low, BASE * low - 1)) / 2 - DISCOUNT) * UNITS).cast("bigint")
    mass = (summed.where("kind = 1").groupBy(context.alias("k")).agg(F.sum(worth).alias("n"))
            .select(F.lit(2).alias("kind"), "k", "n"))
    n = max(1, -(-tokens // segment_tokens))
    # Segment of a hash: its upper 32 bits times n, shifted down, as segment_of() has it.
    seg = F.shiftrightunsigned(F.shiftrightunsigned("k", 32) * n, 32).cast("int")
    # A segment is a fixed share of the hash range; its share of the distinct keys is bounded. It is a partition by
    # its number, so its rows stream into one task unsorted.
    parts = summed.select("kind", "k", "n").unionByName(mass).repartitionById(n, seg)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        def parts_of(kind: np.ndarray, k: np.ndarray, c: np.ndarray) -> list[np.ndarray]:
            """Keys and values by kind, copied: a batch is not held, and a pair takes 9 bytes."""
            out = [x[kind == i] for i in range(3) for x in (k, c)]
            out[3] = level(out[3]).astype(np.int8)
            return out

        def made(s: int, held: list[list[np.ndarray]]) -> pa.RecordBatch:
            whole = []
            for i in range(6):
                whole.append(np.concatenate([h[i] for h in held]))
                for h in held:
                    h[i] = None
            body = pickle.dumps(Segment(*whole), protocol=5)
            return pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([len(body)], pa.int64()),
                                               pa.array([body], pa.binary())], names=["segment", "bytes", "body"])

        held: dict[int, list[list[np.ndarray]]] = {}
        for batch in batches:
            kind, k, c = (batch.column(i).to_numpy() for i in range(3))
            k = k.view(np.uint64)
            which = segment_of(k, n)
            for s in np.unique(which).tolist():
                here = which == s
                held.setdefault(s, []).append(parts_of(kind[here], k[here], c[here]))
        for s in list(held):
            yield made(s, held.pop(s))
        _release()

    segments = stored(in_arrow(parts, build, "segment int, bytes bigint, body binary"), "lm-segments")
    release(docs.sparkSession)
    sizes = {r["segment"]: r["bytes"] for r in segments.select("segment", "bytes").collect()}   # n rows
    return Model(tokens, distinct, segments, n, [sizes.get(s, 0) for s in range(n)], [summed])


def _log_base(count: np.ndarray, tokens: int, distinct: int) -> np.ndarray:
    return np.log10((count + 0.1) / (tokens + 0.1 * (distinct + 1)))


def _sums(text: np.ndarray, n: int, known: np.ndarray, before: np.ndarray, pair: np.ndarray, mass: np.ndarray,
          tokens: int, distinct: int) -> list[pa.Array]:
    """n_tokens, n_known, base_score and score of every text from what its positions resolved to."""
    base = _log_base(known, tokens, distinct)
    p0 = 10.0 ** base
    context = np.maximum(before, 1)
    whole = np.where(before > 0, mass / UNITS / context, 0.0)
    share = np.minimum(whole, MOST)
    scale = MOST / np.maximum(whole, MOST)
    # A false positive may answer more than the whole context has.
    seen = np.where(before > 0, np.minimum(np.maximum(middle(pair) - DISCOUNT, 0) / context * scale, MOST), 0.0)
    score = np.where(seen > 0, np.log10(seen + (1 - share) * p0), np.log10(1 - share) + base)
    return [pa.array(np.bincount(text, minlength=n).astype(np.int64)),
            pa.array(np.bincount(text, weights=known > 0, minlength=n).astype(np.int64)),
            pa.array(np.bincount(text, weights=base, minlength=n)),
            pa.array(np.bincount(text, weights=score, minlength=n))]


_OUT = [("n_tokens", "bigint"), ("n_known", "bigint"), ("base_score", "double"), ("score", "double")]


def _looked_up(t: Tables, h: np.ndarray, text: np.ndarray) -> list[np.ndarray]:
    p, has = pair_hashes(h, text)
    # Counts and masses are asked once a distinct token of the chunk, not at every position.
    u, at = np.unique(h, return_inverse=True)
    known = t.resolve(u, Segment.count)[at]
    before = np.where(has, np.concatenate([[-1], known[:-1]]), 0)
    pair = np.where(has, t.resolve(p, Segment.levels), 0)
    mass = np.where(has, np.concatenate([[-1], t.resolve(u, Segment.mass)[at][:-1]]), 0)
    return [known, before, pair, mass]


def score(docs: DataFrame, model: Model, *, text: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with n_tokens, n_known, base_score and score."""
    sc = docs.sparkSession.sparkContext
    passes, tokens, distinct = model.passes(broadcast_bytes), model.tokens, model.distinct
    if len(passes) == 1:
        held = sc.broadcast(model.tables(passes[0]))

        def work(col: pa.Array) -> list[pa.Array]:
            h, at = token_hashes(col)
            return _sums(at, len(col), *_looked_up(held.value, h, at), tokens, distinct)

        return append_columns(docs, text, _OUT, work, CHUNK)

    return _asked(docs, model, text)


def _asked(docs: DataFrame, model: Model, text: str) -> DataFrame:
    """The same without a broadcast, for a model of any size: chunks of rows are stored under numbers, each asks every
    segment once for its distinct keys, and the answers meet the chunk again."""
    spark, n, tokens, distinct = docs.sparkSession, model.n, model.tokens, model.distinct
    df = without(docs, [x for x, _ in _OUT])
    width, fed = len(df.columns), df
    at = df.columns.index(text) if text in df.columns else [c.lower() for c in df.columns].index(text.lower())
    if not isinstance(df.schema.fields[at].dataType, (StringType, BinaryType)):
        at, fed = width, df.withColumn(free_name(df, "text_bytes"), F.col(f"`{text}`").cast("binary"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    names = [*df.columns, *(x for x, _ in _OUT)]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        for batch in chunks(batches, at, CHUNK):
            # A number of its own, whichever attempt of the task has made it: a chunk is one row from here on.
            yield _rows(chunk=[uuid.uuid4().bytes], part=[-1], body=[_packed(batch)])

    def distinct_keys(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        h, of = token_hashes(as_bytes(batch.column(at)))
        p, has = pair_hashes(h, of)
        return h, of, has, *np.unique(h, return_inverse=True), *np.unique(p[has], return_inverse=True)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            _, _, _, u, _, v, _ = distinct_keys(_unpacked(row["body"]))
            cut = [np.searchsorted(segment_of(k, n), np.arange(n + 1)) for k in (u, v)]
            parts = [s for s in range(n) if cut[0][s] < cut[0][s + 1] or cut[1][s] < cut[1][s + 1]]
            yield _rows(chunk=[row["chunk"]] * len(parts), part=parts, body=[_dumped(
                [_steps(k[c[s]:c[s + 1]]) for k, c in zip((u, v), cut, strict=True)]) for s in parts])
        _release()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        none = np.zeros(0, np.uint64)
        empty = Segment(none, none, none, none.astype(np.int64))      # a hash range without any key
        here, segment = -1, empty
        for row in _each(batches):       # a segment comes before what is asked of it
            if row["part"] != here:
                here, segment = row["part"], empty
            if row["chunk"] is None:
                segment = pickle.loads(row["body"])
                continue
            u, v = (np.cumsum(x, dtype=np.uint64) for x in _loaded(row["body"]))
            yield _rows(chunk=[row["chunk"]], part=[here], body=[_dumped([segment.count(u), segment.mass(u), segment.levels(v)])])
        _release()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def whole(body: bytes, got: list) -> pa.RecordBatch:
            batch = _unpacked(body)
            h, of, has, u, token, v, pair = distinct_keys(batch)
            count, mass, level_of = (np.concatenate(x).astype(np.int64) for x in zip(*got, strict=True))
            levels = np.zeros(len(h), np.int64)
            levels[has] = level_of[pair]
            known, mass = count[token], mass[token]
            before, of_mass = (np.where(has, np.concatenate([[-1], x[:-1]]), 0) for x in (known, mass))
            return pa.RecordBatch.from_arrays([*batch.columns[:width], *_sums(
                of, batch.num_rows, known, before, levels, of_mass, tokens, distinct)], names=names)

        held, got = None, []
        for row in _each(batches):       # a chunk comes before its answers, and they in the order of their keys
            if row["part"] >= 0:
                got.append(_loaded(row["body"]))
                continue
            if held is not None:
                yield whole(held, got)
            held, got = row["body"], []
        if held is not None:
            yield whole(held, got)

    release(spark, *model.spent)
    model.spent = []
    packs = stored(in_arrow(fed, pack, _ROW), "lm-chunks")
    body = model.segments.select(F.lit(None).cast("binary").alias("chunk"), F.col("segment").alias("part"), "body")
    asked = in_arrow(packs, ask, _ROW).unionByName(body).repartitionById(n, F.col("part"))
    answers = stored(in_arrow(asked.sortWithinPartitions("part", F.col("chunk").asc_nulls_first()), answer, _ROW), "lm-answers")
    release(spark)
    both = packs.unionByName(answers).repartition(4 * n, "chunk").sortWithinPartitions("chunk", "part")
    return in_arrow(both, finish, ", ".join([fields, *(f"{x} {t}" for x, t in _OUT)]))


_ROW = "chunk binary, part int, body binary"


def _rows(chunk: list, part: list, body: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(chunk, pa.binary()), pa.array(part, pa.int32()), pa.array(body, pa.binary())],
                                      names=["chunk", "part", "body"])


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {k: batch.column(j)[i].as_py() for j, k in enumerate(("chunk", "part", "body"))}


def _steps(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as the steps between them."""
    return np.diff(keys, prepend=np.zeros(1, np.uint64))


def _dumped(arrays: list[np.ndarray]) -> bytes:
    """Non-negative numbers of 64 bits, packed: the first bytes of all, then the second ones, so that bytes
    that are mostly zero take next to nothing."""
    planes = [np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T) for x in arrays]
    head = np.array([len(x) for x in arrays], "<u4").tobytes()
    return bytes([len(arrays)]) + head + pa.compress(b"".join(x.tobytes() for x in planes), codec="zstd", asbytes=True)


def _loaded(body: bytes) -> list[np.ndarray]:
    edge = 1 + 4 * body[0]
    sizes = np.frombuffer(body, "<u4", body[0], 1).astype(np.int64)
    raw = pa.decompress(body[edge:], decompressed_size=8 * int(sizes.sum()), codec="zstd", asbytes=True)
    ends = 8 * np.cumsum(sizes)
    return [np.ascontiguousarray(np.frombuffer(raw[e - 8 * k:e], np.uint8).reshape(8, -1).T).view("<u8").ravel()
            for e, k in zip(ends.tolist(), sizes.tolist(), strict=True)]


def _packed(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return out.getvalue().to_pybytes()


def _unpacked(body: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(body) as r:
        return r.read_next_batch()
