"""Token counts of whole texts by a map-side two-tier lookup of pre-token lengths.

A text's count under a byte-level BPE is the sum of its pre-tokens' counts, and a pre-token's count never
changes. So no ids are needed, only lengths:

1. **Frequent pre-tokens.** Every task counts the pre-tokens of all its texts in a bounded summary (the
   rarer half is dropped when it is full) and hands on its `KEEP` most frequent as ONE row of
   (fingerprint, count, length). Summaries are merged in levels, each level a table, until a few rows are
   left. Pre-tokens themselves are never shuffled.
2. **Tier one**: the `KEEP` most frequent pre-tokens of all tasks in an open-addressing hash table of
   fingerprint and length, broadcast. Its size is fixed (`KEEP` entries of 10 bytes over a load of a
   half at most), whatever the corpus.
3. **Tier two**: pre-tokens not in the table are looked up in the worker's own cache (fingerprint and
   length, `CACHE` entries at most); only those unknown to it too are encoded, each distinct one once.

Pre-tokens are found with numpy on the code points of a chunk (the byte-level pattern's classes: letters,
numbers, white space, others); their 64-bit fingerprints are differences of a prefix sum over random
values of the code points. Which pre-tokens count as frequent decides the time, never the result. Two
different pre-tokens of one fingerprint would be counted alike: about n * KEEP / 2^64 for n distinct
pre-tokens, 10^-5 for a billion.

Very long texts are worked on in windows cut before white space, where a pre-token always ends. The
vocabulary file is read by the driver and broadcast.

Defined cases: a null or empty text has 0 bytes and 0 tokens; a special token's string inside a text is that
one token, as the library has it; repeated rows are counted each; other columns pass through, one with
the name of a result is replaced by it; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import append_columns, chunks, in_arrow, stored

KEEP = 1 << 15
#: Entries of a task's summary before the rarer half goes, and code points of a pre-token kept there.
SUMMARY, LONGEST = 4 * KEEP, 64
CACHE = 1 << 19
WINDOW = 1 << 20
MERGE_ROWS = 32

# Unicode white space as the pattern has it, and the contractions by their second letter on.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SHORT, LONG = "stmd", ("re", "ve", "ll")
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WINDOW_END = re.compile(r"\S(?=\s)")


def code_classes() -> bytes:
    """The class of every code point, one byte each."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = bytearray(kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000))
    for c in WHITE:
        out[c] = SPACE
    return bytes(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class LengthTable:
    """Fingerprint to token count, open addressing with linear probes; looked up for whole arrays."""

    def __init__(self, keys: np.ndarray, lengths: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.lengths = np.zeros(1 << self.bits, np.uint16)       # 0: the slot is free
        left, far = np.arange(len(keys)), 0
        while len(left):
            slot = self._slot(keys[left], far)
            free = self.lengths[slot] == 0
            # Of several keys at one free slot the first gets it, the others probe on.
            _, first = np.unique(slot[free], return_index=True)
            won = left[free][first]
            at = slot[free][first]
            self.keys[at], self.lengths[at] = keys[won], lengths[won]
            left, far = np.setdiff1d(left, won, assume_unique=True), far + 1
        self.probes = far

    def _slot(self, keys: np.ndarray, far: int) -> np.ndarray:
        return ((keys >> np.uint64(64 - self.bits)) + np.uint64(far) & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """Token counts, 0 for a key that is not in the table."""
        out = np.zeros(len(keys), np.int64)
        left = np.arange(len(keys))
        for far in range(self.probes):
            slot = self._slot(keys[left], far)
            held = self.lengths[slot]
            hit = (self.keys[slot] == keys[left]) & (held > 0)
            out[left[hit]] = held[hit]
            left = left[~hit & (held > 0)]        # a free slot ends the search
            if not len(left):
                break
        return out


class Worker:
    """What a Python worker keeps for one vocabulary: pattern classes, the library's encoder for unknown
    pre-tokens, and the tier-two cache (numbers only, at most `CACHE` entries)."""

    def __init__(self, vocabulary: str, classes: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # a task has one core
        from tokenizers import Tokenizer

        spec = json.loads(vocabulary)
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or spec["pre_tokenizer"] != {
                **spec["pre_tokenizer"], "type": "ByteLevel", "add_prefix_space": False, "use_regex": True}:
            raise ValueError("a byte-level BPE file without a normalizer or prefix space is needed")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens that take their neighbours' white space are not supported")
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.encoder = Tokenizer.from_str(vocabulary)
        self.encoder.no_truncation()
        self.encoder.no_padding()
        self.classes = np.frombuffer(classes, np.uint8)
        self.random = _mixed(np.arange(0x110000, dtype=np.uint64) + _BASE)
        self.power = self.inverse = np.ones(1, np.uint64)
        self.known = (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def lengths(self, pieces: list[str]) -> list[int]:
        return [len(e.ids) for e in self.encoder.encode_batch(pieces, add_special_tokens=False)]

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.power) < n:
            step = np.full(max(n, WINDOW), _BASE, np.uint64)
            back = np.full(len(step), pow(int(_BASE), -1, 1 << 64), np.uint64)
            step[0] = back[0] = 1
            self.power, self.inverse = np.cumprod(step), np.cumprod(back)
        return self.power, self.inverse

    def segments(self, texts: list[str]) -> tuple[list[str], list[int], np.ndarray]:
        """Stretches between special tokens, cut to windows, with the text each is of; special tokens a text."""
        parts, owner, extra = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            cut = [text]
            if self.special is not None and (found := self.special.findall(text)):
                extra[i] = len(found)
                cut = self.special.split(text)
            for part in cut:
                a = 0
                while len(part) - a > WINDOW:
                    m = _WINDOW_END.search(part, a + WINDOW)
                    if not m:
                        break
                    parts.append(part[a:m.end()])
                    owner.append(i)
                    a = m.end()
                if a < len(part):
                    parts.append(part[a:])
                    owner.append(i)
        return parts, owner, extra

    def pieces(self, parts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The joined stretches; start, end and fingerprint of every pre-token; number of its stretch."""
        joined = "".join(parts)
        cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        n = len(cps)
        ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
        kind = self.classes[cps]
        fresh = np.zeros(n + 1, bool)
        fresh[0] = True
        fresh[ends] = True
        white = kind == SPACE
        start = fresh[:-1].copy()
        start[1:] |= kind[1:] != kind[:-1]
        # The last of a white run before something else begins a piece; where it is a blank, the piece
        # goes on over what follows.
        last = np.flatnonzero(white[:-1] & ~white[1:] & ~fresh[1:-1])
        start[last] = True
        start[last[cps[last] == 32] + 1] = False
        # Contractions: an apostrophe that begins a piece, and the letters right behind it.
        quote = np.flatnonzero(start & (cps == 39))
        for size, tails in ((1, SHORT), (2, LONG)):
            for tail in tails:
                q = quote[quote + size < n]
                for k, letter in enumerate(tail, 1):
                    q = q[(cps[q + k] == ord(letter)) & ~fresh[q + k]]
                start[q + 1] = False
                after = q + size + 1
                start[after[after < n]] = True
        s = np.flatnonzero(start)
        e = np.append(s[1:], n)[:len(s)]
        power, inverse = self._powers(n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.random[cps] * power[:n], out=total[1:])
        prints = _mixed((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64) * _BASE)
        return joined, s, e, prints, np.searchsorted(ends, s, "right")

    def batches(self, parts: list[str]) -> Iterator[slice]:
        """Stretches in runs of about `WINDOW` code points."""
        a = size = 0
        for b, part in enumerate(parts):
            if size and size + len(part) > WINDOW:
                yield slice(a, b)
                a, size = b, 0
            size += len(part)
        if parts:
            yield slice(a, len(parts))

    def count(self, texts: list[str], table: LengthTable) -> np.ndarray:
        parts, owner, out = self.segments(texts)
        owner = np.array(owner, np.int64)
        for run in self.batches(parts):
            joined, s, e, prints, part = self.pieces(parts[run])
            size = table.lookup(prints)
            missed = np.flatnonzero(size == 0)
            if len(missed):
                size[missed] = self._second_tier(joined, s[missed], e[missed], prints[missed])
            out += np.bincount(owner[run][part], weights=size, minlength=len(texts)).astype(np.int64)
        return out

    def _second_tier(self, joined: str, s: np.ndarray, e: np.ndarray, prints: np.ndarray) -> np.ndarray:
        fresh, first, back = np.unique(prints, return_index=True, return_inverse=True)
        keys, held = self.known
        at = np.searchsorted(keys, fresh)
        there = np.zeros(len(fresh), bool)
        inside = at < len(keys)
        there[inside] = keys[at[inside]] == fresh[inside]
        size = np.zeros(len(fresh), np.int64)
        size[there] = held[at[there]]
        new = np.flatnonzero(~there)
        size[new] = self.lengths([joined[s[i]:e[i]] for i in first[new].tolist()])
        if len(keys) + len(new) > CACHE:
            self.known = (fresh, size) if len(fresh) <= CACHE else (keys[:0], held[:0])
        elif len(new):
            self.known = (np.insert(keys, at[new], fresh[new]), np.insert(held, at[new], size[new]))
        return size[back]

    def summary(self, batches: Iterator[pa.RecordBatch]) -> list[tuple[int, int, int]]:
        """(fingerprint, count, length) of a task's most frequent pre-tokens."""
        seen: dict[int, list] = {}
        for batch in batches:
            texts = [(t or b"").decode("utf-8", "replace") for t in batch.column(0).to_pylist()]
            parts, _, _ = self.segments(texts)
            for run in self.batches(parts):
                joined, s, e, prints, _ = self.pieces(parts[run])
                short = np.flatnonzero(e - s <= LONGEST)
                keys, first, counts = np.unique(prints[short], return_index=True, return_counts=True)
                for key, i, n in zip(keys.tolist(), short[first].tolist(), counts.tolist(), strict=True):
                    entry = seen.get(key)
                    if entry is None:
                        seen[key] = [n, joined[s[i]:e[i]]]
                    else:
                        entry[0] += n
                if len(seen) > SUMMARY:
                    seen = dict(sorted(seen.items(), key=lambda kv: -kv[1][0])[:SUMMARY // 2])
        top = sorted(seen.items(), key=lambda kv: (-kv[1][0], kv[0]))[:KEEP]
        top = [x for x in top if x[1][0] > 1]
        return [(k, v[0], n) for (k, v), n in zip(top, self.lengths([v[1] for _, v in top]), strict=True)]


_WORKER: dict[str, Worker] = {}


def _worker(vocabulary, classes) -> Worker:
    """One a Python worker process: the tier-two cache outlives a task."""
    text = vocabulary.value
    if text not in _WORKER:
        _WORKER.clear()
        _WORKER[text] = Worker(text, classes.value)
    return _WORKER[text]


_SKETCH = "prints binary, counts binary, lengths binary"


def _packed(prints: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> pa.RecordBatch:
    top = np.lexsort((prints, -counts))[:KEEP]
    parts = prints[top].astype("<u8"), counts[top].astype("<i8"), np.minimum(lengths[top], 65535).astype("<u2")
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in parts],
                                      names=["prints", "counts", "lengths"])


def _merged(rows: Iterator[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Counts of equal fingerprints added, two summaries at a time; no more than twice `KEEP` are held."""
    out = None
    for r in rows:
        new = (np.frombuffer(r["prints"], "<u8"), np.frombuffer(r["counts"], "<i8"), np.frombuffer(r["lengths"], "<u2"))
        if out is not None:
            keys, first, back = np.unique(np.concatenate([out[0], new[0]]), return_index=True, return_inverse=True)
            sums = np.bincount(back, weights=np.concatenate([out[1], new[1]]), minlength=len(keys)).astype(np.int64)
            new = (keys, sums, np.concatenate([out[2], new[2]])[first])
            if len(keys) > 2 * KEEP:
                top = np.argsort(-sums, kind="stable")[:2 * KEEP]
                new = tuple(x[top] for x in new)
        out = new
    return out


def frequent(docs: DataFrame, vocabulary, classes, text: str = "text") -> LengthTable:
    """The table of the corpus's most frequent pre-tokens; ``vocabulary`` and ``classes`` are broadcasts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _worker(vocabulary, classes).summary(chunks(batches, 0))
        if found:
            yield _packed(*(np.array(x, t) for x, t in zip(zip(*found), ("<u8", "<i8", "<i8"))))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _merged(r for b in batches for r in b.to_pylist())
        if got is not None:
            yield _packed(*got)

    level = stored(in_arrow(docs.select(F.col(f"`{text}`").cast("binary").alias("t")), count, _SKETCH), "pretokens")
    rows = level.count()
    while rows > MERGE_ROWS:        # every level holds a MERGE_ROWS-th of the rows: a few levels for any corpus
        level = stored(in_arrow(level.repartition(-(-rows // MERGE_ROWS)), merge, _SKETCH), "pretokens")
        rows = level.count()
    got = _merged(r.asDict() for r in level.toLocalIterator())      # MERGE_ROWS rows of a bounded size
    if got is None:
        return LengthTable(np.zeros(0, np.uint64), np.zeros(0, np.uint16))
    top = np.lexsort((got[0], -got[1]))[:KEEP]
    top = top[(got[2][top] > 0) & (got[2][top] < 65535)]
    return LengthTable(got[0][top], got[2][top])


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", *, limit: int = 1024) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit of every text."""
    sc = docs.sparkSession.sparkContext
    with open(vocabulary, encoding="utf-8") as f:
        spec = sc.broadcast(f.read())
    classes = sc.broadcast(code_classes())
    table = sc.broadcast(frequent(docs, spec, classes, text))

    def work(col: pa.Array) -> list[pa.Array]:
        raw = [t or b"" for t in col.to_pylist()]
        n = _worker(spec, classes).count([t.decode("utf-8", "replace") for t in raw], table.value)
        return [pa.array([len(t) for t in raw], pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit)]

    return append_columns(docs, text, [("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")], work)
