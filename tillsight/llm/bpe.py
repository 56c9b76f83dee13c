"""Byte-level BPE encoding and decoding over a pair occurrence index.

A task cuts its texts into pieces with the vocabulary's pre-tokeniser pattern and encodes each
distinct piece of a chunk once. All distinct pieces stand in one symbol sequence; an index maps
every mergeable pair to all its positions there. Ranks are applied in ascending order: the
smallest active rank merges at all its positions (left to right), and only the two neighbouring
pairs of each merge enter the lists of their own ranks. Decoding joins the byte strings of the
ids. Finished pieces are kept in a cache of bounded bytes, which goes when the worker turns to another stage.

The vocabulary (a `tokenizers` JSON of type BPE with the ByteLevel pre-tokeniser and decoder) is
read by the driver and broadcast; its size is that of the file, some MB whatever the corpus.

Defined cases: a null text is encoded as the empty text (no ids); a special token's string inside
a text becomes that token, as the library has it; repeated rows are encoded each; other columns
pass through untouched.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillsight.llm.common import append_columns

#: Bytes of text whose distinct pieces share an index; a worker holds some hundred bytes a piece of it.
CHUNK = 1 << 20
#: Bytes of a worker's finished pieces; an entry's own objects count as `ENTRY_BYTES`.
CACHE_BYTES, ENTRY_BYTES = 128 << 20, 280

# Fixed values of the byte-level format: the contractions, and Unicode white space.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def _class_of(major: str) -> str:
    """The code points whose general category starts with ``major``, as ranges of a class."""
    out, first = [], None
    for cp in range(sys.maxunicode + 2):
        inside = cp <= sys.maxunicode and unicodedata.category(chr(cp))[0] == major
        if inside and first is None:
            first = cp
        elif not inside and first is not None:
            out.append(f"\\U{first:08x}-\\U{cp - 1:08x}")
            first = None
    return "".join(out)


def _pattern(letters: str, digits: str, white: str) -> re.Pattern:
    return re.compile(f"{CONTRACTIONS}| ?[{letters}]+| ?[{digits}]+| ?[^{white}{letters}{digits}]+"
                      f"|[{white}]+(?![^{white}])|[{white}]+")


@lru_cache(maxsize=1)
def _patterns() -> tuple[re.Pattern, re.Pattern]:
    return (_pattern("A-Za-z", "0-9", "\\t-\\r "),
            _pattern(_class_of("L"), _class_of("N"), WHITE))


def _byte_letters() -> dict[str, int]:
    """Printable stand-in of each byte in the vocabulary file: itself where it is a visible Latin-1
    character, else the next free code point from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Ids, merges and special tokens of a byte-level BPE file."""

    def __init__(self, spec: dict):
        model, letters = spec["model"], _byte_letters()
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("a byte-level BPE file without a normalizer is needed")
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of = {i: bytes(letters[c] for c in t) for t, i in ids.items() if t not in self.special}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.first = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.first[b] = ids[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merge = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]          # by rank
        self.rank = {(a, b): r for r, (a, b, _) in reversed(list(enumerate(self.merge)))}
        self.prefix_space = spec["pre_tokenizer"].get("add_prefix_space", False)
        # Ranks of pairs of single bytes, for the first fill of the index.
        self.first_rank = np.full((256, 256), -1, np.int64)
        back = {int(i): b for b, i in enumerate(self.first)}
        for (a, b), r in self.rank.items():
            if a in back and b in back:
                self.first_rank[back[a], back[b]] = r

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))


def encode_pieces(pieces: list[bytes], voc: Vocabulary) -> list[list[int]]:
    """Ids of every piece, by merging over the index of pair positions."""
    raw = np.frombuffer(b"".join(pieces), np.uint8)
    ends = np.cumsum([len(p) for p in pieces], dtype=np.int64)
    n = len(raw)
    sym = voc.first[raw].tolist()
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    for e in ends.tolist():                       # pieces are islands: no pair across their ends
        if e:
            after[e - 1] = -1
        if e < n:
            before[e] = -1
    index: dict[int, list[int]] = {}
    if n > 1:
        ranks = voc.first_rank[raw[:-1], raw[1:]]
        ranks[ends[ends < n] - 1] = -1
        at = np.flatnonzero(ranks >= 0)
        at = at[np.argsort(ranks[at], kind="stable")]
        edges = np.flatnonzero(np.diff(ranks[at], prepend=-1))
        for part in np.split(at, edges[1:]):
            if len(part):
                index[int(ranks[part[0]])] = part.tolist()
    active = list(index)
    heapq.heapify(active)
    merge, rank_of = voc.merge, voc.rank
    while active:
        r = heapq.heappop(active)
        places = index.pop(r)
        places.sort()
        left, right, joined = merge[r]
        for p in places:
            q = after[p]
            if q < 0 or sym[p] != left or sym[q] != right:
                continue                          # changed by an earlier merge
            sym[p], sym[q] = joined, -1
            z = after[q]
            after[p] = z
            after[q] = -1
            if z >= 0:
                before[z] = p
                k = rank_of.get((joined, sym[z]))
                if k is not None:
                    if k in index:
                        index[k].append(p)
                    else:
                        index[k] = [p]
                        heapq.heappush(active, k)
            y = before[p]
            if y >= 0:
                k = rank_of.get((sym[y], joined))
                if k is not None:
                    if k in index:
                        index[k].append(y)
                    else:
                        index[k] = [y]
                        heapq.heappush(active, k)
    out, a = [], 0
    for e in ends.tolist():
        out.append([s for s in sym[a:e] if s >= 0])
        a = e
    return out


class Encoder:
    """Encodes texts; keeps finished pieces of about ``CACHE_BYTES`` and those of the current chunk."""

    def __init__(self, voc: Vocabulary):
        self.voc, self.known, self.size = voc, {}, 0
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(voc.special, key=len, reverse=True))) + ")") \
            if voc.special else None

    def pieces(self, text: str) -> list:
        plain, full = _patterns()
        if self.split is None or not any(s in text for s in self.voc.special):
            if self.voc.prefix_space and text and text[0] != " ":
                text = " " + text
            return (plain if text.isascii() else full).findall(text)
        out: list = []
        for i, part in enumerate(self.split.split(text)):
            if i % 2:
                out.append((self.voc.special[part],))
            elif part:
                if self.voc.prefix_space and part[0] != " ":
                    part = " " + part
                out += (plain if part.isascii() else full).findall(part)
        return out

    def encode(self, texts: list[str]) -> list[list[tuple[int, str, bytes]]]:
        """For every text its pieces as (number of ids, ids as text, decoded bytes)."""
        cut = [self.pieces(t) for t in texts]
        if self.size > CACHE_BYTES:
            self.known, self.size = {}, 0
        known, voc = self.known, self.voc
        fresh = list(set().union(*map(set, cut)) - known.keys()) if cut else []
        words = [p for p in fresh if isinstance(p, str)]
        for p in fresh:
            if not isinstance(p, str):
                known[p] = (1, str(p[0]), voc.bytes_of[p[0]])
        for p, ids in zip(words, encode_pieces([w.encode() for w in words], voc), strict=True):
            entry = known[p] = (len(ids), ",".join(map(str, ids)), b"".join([voc.bytes_of[i] for i in ids]))
            self.size += ENTRY_BYTES + 2 * len(p) + len(entry[1]) + len(entry[2])
        return [[known[p] for p in c] for c in cut]


def encode(docs: DataFrame, vocabulary: str, text: str = "text", *, ids: str = "ids",
           decoded: str = "decoded") -> DataFrame:
    """``docs`` with the id list of every text and the text decoded from it again."""
    return _run(docs, vocabulary, text, [(ids, "array<int>"), (decoded, "string")], lambda rows: [
        pa.array([[int(i) for p in r for i in p[1].split(",")] for r in rows], pa.list_(pa.int32())),
        pa.array([b"".join([p[2] for p in r]).decode("utf-8", "replace") for r in rows], pa.string())])


def digests(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens and the SHA-256 of the id list and of the decoded text: the same
    encoding, reduced in the task so that neither ids nor texts are moved."""
    def reduce(rows: list) -> list[pa.Array]:
        return [pa.array([sum([p[0] for p in r]) for r in rows], pa.int64()),
                pa.array([hashlib.sha256(",".join([p[1] for p in r]).encode()).hexdigest() for r in rows]),
                pa.array([hashlib.sha256(b"".join([p[2] for p in r]).decode("utf-8", "replace").encode()).hexdigest()
                          for r in rows])]
    return _run(docs, vocabulary, text,
                [("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")], reduce)


def _run(docs: DataFrame, vocabulary: str, text: str, new: list[tuple[str, str]], reduce) -> DataFrame:
    with open(vocabulary, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def work(col: pa.Array) -> list[pa.Array]:
        texts = [(t or b"").decode("utf-8", "replace") for t in col.to_pylist()]
        return reduce(_encoder(spec).encode(texts))

    return append_columns(docs, text, new, work, CHUNK)


def _encoder(spec) -> Encoder:
    """One encoder a worker process, kept on the broadcast: Spark drops that from a worker that turns to a stage
    without it, and the cache goes with it."""
    if not hasattr(spec, "encoder"):
        spec.encoder = Encoder(Vocabulary(json.loads(spec.value)))
    return spec.encoder
