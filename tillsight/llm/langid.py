"""Language identification with language-bitmask n-gram filters.

Training counts byte 4-grams of normalised text per language and keeps those that make up at
least `min_share` of the language's grams, so at most 1/min_share grams a language, whatever the
corpus. All languages share one bit-sliced Bloom filter: a row of it is a bit mask over languages,
a gram sets its language's bit in `probes` rows, and the AND of those rows names all languages
that hold the gram. A prediction sums the masks' bits over all grams of a text and takes each
language's false positive rate (its fill to the power of `probes`) out of its count.

The filter is fitted on at most about `sample` documents a language (whole texts, chosen by a hash
of doc_id); every document is predicted. Only text and lang are read for training, only text for
predicting.

Defined cases: a text that is null or has no letter is `und` with score 0; without any training
language every text is `und`; ties go to the language first in code point order; repeated rows
are predicted alike; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import append_columns, chunks, in_arrow

SAMPLE = 1000          # documents a language, in expectation
MIN_SHARE = 2e-5
PROBES = 3
UNKNOWN = "und"
#: ASCII bytes that are no letters become blanks; others, parts of non-ASCII letters too, stay.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[b for b in range(128) if not chr(b).isalpha()]] = 32
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def grams(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte 4-grams of the texts (lower case, letters only, single blanks) and their text numbers."""
    texts = [b"" if t is None else (" " + t.decode("utf-8", "replace").lower() + " ").encode("utf-8", "replace")
             for t in col.to_pylist()]
    b = _PLAIN[np.frombuffer(b"".join(texts), np.uint8)]
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    keep = np.ones(len(b), bool)
    keep[1:] = (b[1:] != 32) | (b[:-1] != 32) | (text[1:] != text[:-1])
    b, text = b[keep].astype(np.uint32), text[keep]
    if len(b) < 4:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    g = b[:-3] | b[1:-2] << 8 | b[2:-1] << 16 | b[3:] << 24
    inside = text[:-3] == text[3:]
    return g[inside], text[:-3][inside]


def _places(g: np.ndarray, bits: int) -> list[np.ndarray]:
    x = g.astype(np.uint64)
    return [(x * np.uint64(m)) >> np.uint64(64 - bits) for m in _MIX[:PROBES]]


class Filter:
    """Bit-sliced Bloom filter over the languages' grams."""

    def __init__(self, langs: list[str], kept: list[np.ndarray]):
        self.langs = langs
        words = max(1, -(-len(langs) // 64))
        self.bits = max(16, int(np.ceil(np.log2(8 * max([1, *map(len, kept)])))))
        self.rows = np.zeros((1 << self.bits, words), np.uint64)
        self.false = np.zeros(len(langs))
        for i, g in enumerate(kept):
            for at in _places(g, self.bits):
                self.rows[at, i // 64] |= np.uint64(1) << np.uint64(i % 64)
            fill = (self.rows[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean()
            self.false[i] = min(0.99, fill ** PROBES)

    def masks(self, g: np.ndarray) -> np.ndarray:
        first, *rest = _places(g, self.bits)
        out = self.rows[first]
        for at in rest:
            out = out & self.rows[at]
        return out

    def shares(self, col: pa.Array) -> np.ndarray:
        """Corrected share of each text's grams that each language holds: (texts, languages)."""
        g, text = grams(col)
        n = len(col)
        total = np.maximum(np.bincount(text, minlength=n), 1)
        masks = self.masks(g)
        out = np.zeros((n, len(self.langs)))
        for i in range(len(self.langs)):
            has = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            hits = np.bincount(text, weights=has, minlength=n) / total
            out[:, i] = np.clip((hits - self.false[i]) / (1 - self.false[i]), 0, 1)
        return out

    def predict(self, col: pa.Array) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return [UNKNOWN] * len(col), np.zeros(len(col))
        shares = self.shares(col)
        best = shares.argmax(1)
        top = shares[np.arange(len(best)), best]
        score = np.where(top > 0, top / np.maximum(shares.sum(1), 1e-12), 0.0)
        known = [t is not None and any(map(str.isalpha, t.decode("utf-8", "replace"))) for t in col.to_pylist()]
        return ([self.langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)],
                np.where(known, score, 0.0))


def train(docs: DataFrame, usable: Column | None = None, *, text: str = "text", lang: str = "lang",
          doc_id: str = "doc_id", sample: int = SAMPLE, min_share: float = MIN_SHARE) -> Filter:
    """Fit on the rows of ``docs`` where ``usable`` holds and ``lang`` is not null."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    if usable is not None:
        rows = rows.where(usable)
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}     # one row a language
    langs = sorted(counts)
    number = {k: i for i, k in enumerate(langs)}
    part = {k: min(1.0, sample / c) for k, c in counts.items()}
    if not langs:
        return Filter([], [])
    draw = F.pmod(F.xxhash64(F.col(doc_id), F.lit("langid")), F.lit(1 << 30)) / float(1 << 30)
    plan = F.create_map(*[F.lit(x) for k in langs for x in (k, part[k])])
    ids = F.create_map(*[F.lit(x) for k in langs for x in (k, number[k])])
    fed = (rows.where(draw < plan[F.col(lang)])
           .select(ids[F.col(lang)].alias("lang"), F.col(text).cast("binary").alias("text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            which = batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
            g, at = grams(batch.column(1))
            key, n = np.unique(which[at] << np.uint64(32) | g.astype(np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array((key >> np.uint64(32)).astype(np.int64)),
                                              pa.array((key & np.uint64(0xFFFFFFFF)).astype(np.int64)),
                                              pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    seen = in_arrow(fed, count, "lang bigint, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    total = seen.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = seen.join(F.broadcast(total), "lang").where(F.col("n") >= F.col("total") * min_share).select("lang", "gram")
    rows = kept.toArrow()          # at most 1 / min_share rows a language
    which, g = rows.column(0).to_numpy(), rows.column(1).to_numpy().astype(np.uint32)
    return Filter(langs, [np.sort(g[which == i]) for i in range(len(langs))])


def predict(docs: DataFrame, model: Filter, *, text: str = "text", prediction: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its share among the languages' corrected counts."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def work(col: pa.Array) -> list[pa.Array]:
        names, scores = held.value.predict(col)
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    return append_columns(docs, text, [(prediction, "string"), (score, "double")], work)


