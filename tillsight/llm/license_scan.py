"""License scan by diagonal voting.

1. Tasks hash every run of K words of every text; Spark joins the exploded hashes with the hashes of the
   templates' runs (a broadcast table of a few thousand rows: the templates are fixed text).
2. A match of text place p with template place q votes for the diagonal p - q of its (text,
   template). All votes of an uninterrupted copy fall on one diagonal.
3. Neighbouring diagonals (inserted or dropped words shift a copy by a few places) are merged by a
   session window over the diagonals of one (text, template). Longer insertions leave groups apart: from each group
   on, the template words matched by all groups within one template length of it are counted together.
4. Spans with enough votes are verified on the words of the text itself: only texts with a span are read
   again. A phrase must stand word for word; a longer template needs an ordered match (longest common
   subsequence) of at least `min_score` of its words.

**Enough votes** follows from `min_score`. A notice of n words may lack B = floor(n (1 - min_score)) of them. B changes
(a word dropped or replaced, or an insertion of any length that fits into a template length) cut a copy into at most
B + 1 pieces, and a piece shorter than K has no run: at least n - B - (K - 1)(B + 1) words are covered by votes,
and every span with that many (one run at least) is verified. A copy with more changes than B may be missed, whatever its ordered match.

Texts are known by (doc_id, hash of the text) in between, so repeated rows share their spans.

Defined cases: null and empty texts have no word, no label and score 0; repeated rows get the same
result each; a null doc_id is a value like any other; phrases that overlap are all counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.common import ASCII_LOWER, append_columns, buffers, chunks, in_arrow, stored, without
from tillsight.llm.ngram_lm import _BYTE, _STEP, _mix, _powers

K = 3
MIN_SCORE = 0.8
SLACK = 3

# The phrases of the base scan and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Wording of public licenses and their usual notices.
NOTICES = {
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the \"Software\"), to deal in the Software without restriction,"
        " including without limitation the rights to use, copy, modify, merge, publish, distribute,"
        " sublicense, and/or sell copies of the Software"],
    "apache-2": [
        "you may not use this file except in compliance with the License. You may obtain a copy of the"
        " License at http://www.apache.org/licenses/LICENSE-2.0"],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met"],
    "gpl": [
        "licensed under the GNU General Public License",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation"],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License"],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without"
        " fee is hereby granted"],
    "cc-by": [
        "licensed under a Creative Commons Attribution 4.0 International License"],
}

_WORD = np.zeros(256, bool)      # bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` after lower-casing
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


class Template(NamedTuple):
    number: int
    label: str
    words: list[bytes]
    phrase: bool           # must stand word for word; counts for the base columns


def words_of(text: bytes) -> list[bytes]:
    low = ASCII_LOWER[np.frombuffer(text, np.uint8)]
    return bytes(np.where(_WORD[low], low, 32).astype(np.uint8)).split()


def templates(phrases: dict[str, str] | None = None, notices: dict[str, list[str]] | None = None) -> list[Template]:
    rows = [(label, p, True) for p, label in (PHRASES if phrases is None else phrases).items()]
    rows += [(label, n, False) for label, ns in (NOTICES if notices is None else notices).items() for n in ns]
    out = [Template(i, label, words_of(t.encode()), phrase) for i, (label, t, phrase) in enumerate(rows)]
    if any(len(t.words) < K for t in out):
        raise ValueError(f"a template needs {K} words")
    return out


def word_hashes(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word."""
    low = ASCII_LOWER[buf]
    word = _WORD[low]
    if not len(buf) or not word.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    fresh = np.zeros(len(buf) + 1, bool)
    fresh[offs] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | fresh[1:-1]
    first = np.flatnonzero(start)
    at = np.flatnonzero(word)                    # bytes of words, in order
    which = np.cumsum(start)[at] - 1
    place = at - first[which]
    size = np.bincount(which)
    begin = np.cumsum(size) - size
    h = _mix(np.add.reduceat(_BYTE[low[at]] * _powers(int(size.max()))[place], begin) + size.astype(np.uint64))
    return h, np.searchsorted(offs, first, "right") - 1


def run_hashes(h: np.ndarray) -> np.ndarray:
    """Hash of every run of K words, by its first word."""
    if len(h) < K:
        return np.zeros(0, np.uint64)
    out = h[:len(h) - K + 1].copy()
    for k in range(1, K):
        out = _mix(out * _STEP + h[k:len(h) - K + 1 + k])
    return out


def _table(ts: list[Template]) -> list[tuple[int, int, int]]:
    """(hash, template, place) of every run of the templates."""
    rows = []
    for t in ts:
        line = b" ".join(t.words)
        h, _ = word_hashes(np.frombuffer(line, np.uint8), np.array([0, len(line)]))
        rows += [(int(x), t.number, q) for q, x in enumerate(run_hashes(h).view(np.int64))]
    return rows


def spans(docs: DataFrame, ts: list[Template], *, text: str = "text", doc_id: str = "doc_id",
          min_score: float = MIN_SCORE) -> DataFrame:
    """Verified spans: doc, key, template, label, phrase, start, score."""
    spark = docs.sparkSession
    keyed = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.xxhash64(f"`{text}`").alias("key"),
                        F.col(f"`{text}`").alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 2):
            h, at = word_hashes(*buffers(batch.column(2)))
            edge = np.searchsorted(at, np.arange(batch.num_rows + 1))
            runs = run_hashes(h)
            last = np.maximum(edge[1:] - K + 1, edge[:-1])           # runs end inside their text
            own = np.concatenate([np.arange(a, b) for a, b in zip(edge[:-1], last, strict=True)] or [[]]).astype(np.int64)
            offs = np.concatenate([[0], np.cumsum(last - edge[:-1])])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(runs[own].view(np.int64)))],
                names=["doc", "key", "runs"])

    kind = docs.schema[doc_id].dataType.simpleString()
    fed = keyed.select("doc", "key", F.col("text").cast("binary").alias("text"))
    runs = in_arrow(fed, hashed, f"doc {kind}, key bigint, runs array<bigint>").select(
        "doc", "key", F.posexplode("runs").alias("p", "run"))
    marks = spark.createDataFrame(_table(ts), "run bigint, template int, q int")
    votes = runs.join(F.broadcast(marks), "run").select(
        "doc", "key", "template", "p", "q", (F.col("p") - F.col("q")).alias("diagonal")).distinct()
    meta = spark.createDataFrame([(t.number, t.label, t.phrase, len(t.words)) for t in ts],
                                 "template int, label string, phrase boolean, size int")
    # One row a diagonal first; the session window then sees diagonals, not votes.
    lines = votes.groupBy("doc", "key", "template", "diagonal").agg(F.collect_set("q").alias("qs"))
    lines = lines.join(F.broadcast(meta), "template")
    w = Window.partitionBy("doc", "key", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(w)
    fresh = (F.col("phrase") | step.isNull() | (step > SLACK)).cast("int")
    lines = lines.withColumn("group", F.sum(fresh).over(w))
    # A group's template places are at most the template's, however many diagonals it merges.
    merged = lines.withColumn("q", F.explode("qs")).groupBy("doc", "key", "template", "label", "phrase", "size", "group").agg(
        F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.collect_set("q").alias("qs"))
    # What lies within a template length of a group's first diagonal: as many groups as the template has words at most.
    near = F.filter(F.collect_list(F.struct("low", "high", "qs")).over(
        Window.partitionBy("doc", "key", "template").orderBy("low").rangeBetween(0, max(len(t.words) for t in ts))),
        lambda g: ~F.col("phrase") & (g["low"] <= F.col("low") + F.col("size")) | (g["low"] == F.col("low")))
    merged = merged.withColumn("near", near).select(
        "doc", "key", "template", "phrase", "size", "low", F.array_max(F.transform("near", lambda g: g["high"])).alias("high"),
        F.flatten(F.transform("near", lambda g: g["qs"])).alias("qs"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("qs", lambda q: F.sequence(q, q + K - 1)))))
    lacking = F.floor(F.col("size") * F.lit(1 - min_score) + F.lit(1e-9))
    enough = F.greatest(F.lit(K), F.col("size") - lacking - (K - 1) * (lacking + 1))
    likely = merged.where(covered >= F.when(F.col("phrase"), F.col("size")).otherwise(enough))
    # Read the texts that have a span again, and verify on their words. A written table has a known size: the texts
    # are only shuffled to meet spans that are too many to broadcast.
    bag = stored(likely.groupBy("doc", "key").agg(F.collect_list(F.struct("template", "low", "high")).alias("found")), "license-spans")
    again = keyed.join(
        bag.withColumnsRenamed({"doc": "d", "key": "k"}), F.col("doc").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")))
    fed = again.select("doc", "key", F.col("text").cast("binary").alias("text"), "found")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 2):
            out = []
            for i, (t, found) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                ws = words_of(t or b"")
                for f in found:
                    s = verified(ws, ts[f["template"]], f["low"], f["high"])
                    if s >= (1.0 if ts[f["template"]].phrase else min_score):
                        out.append((i, f["template"], f["low"], s))
            rows = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(rows), batch.column(1).take(rows),
                pa.array([o[1] for o in out], pa.int32()), pa.array([ts[o[1]].label for o in out], pa.string()),
                pa.array([ts[o[1]].phrase for o in out], pa.bool_()),
                pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.float64())],
                names=["doc", "key", "template", "label", "phrase", "start", "score"])

    return in_arrow(fed, verify, f"doc {kind}, key bigint, template int, label string, phrase boolean,"
                                 " start bigint, score double").distinct()


def verified(words: list[bytes], t: Template, low: int, high: int) -> float:
    """Share of the template's words that the text has, in order, between its diagonals."""
    n = len(t.words)
    if t.phrase:
        return float(words[low:low + n] == t.words) if low >= 0 else 0.0
    part = words[max(0, low):max(0, high + n)]
    best = [0] * (n + 1)                        # longest common subsequence, one row at a time
    for x in part:
        before = 0
        for j, y in enumerate(t.words):
            up = best[j + 1]
            best[j + 1] = before + 1 if x == y else max(up, best[j])
            before = up
    return best[n] / n


def scan(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", phrases: dict[str, str] | None = None,
         notices: dict[str, list[str]] | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels and score."""
    ts = templates(phrases, notices)
    docs = without(docs, ["n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    found = spans(docs, ts, text=text, doc_id=doc_id, min_score=min_score)
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    base = F.when(F.col("phrase"), F.col("start"))
    bag = stored(found.groupBy("doc", "key").agg(
        F.count(base).alias("n_base"), F.min(base).alias("first_word"), F.max(base).alias("last_word"),
        joined(F.when(F.col("phrase"), F.col("label"))).alias("base_labels"), joined("label").alias("labels"),
        F.max("score").alias("score")), "license-labels")

    def count(col: pa.Array) -> list[pa.Array]:
        buf, offs = buffers(col)
        _, at = word_hashes(buf, offs)
        return [pa.array(np.bincount(at, minlength=len(col)).astype(np.int64))]

    counted = append_columns(docs, text, [("n_words", "bigint")], count)
    left = counted.withColumn("_key", F.xxhash64(F.col(f"`{text}`")))
    out = left.join(bag.withColumnsRenamed({"doc": "_d", "key": "_k"}),
                    F.col(f"`{doc_id}`").eqNullSafe(F.col("_d")) & (F.col("_key") == F.col("_k")), "left")
    return out.select(*[f"`{c}`" for c in counted.columns], F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
                      F.col("first_word").cast("long"), F.col("last_word").cast("long"),
                      F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                      F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
