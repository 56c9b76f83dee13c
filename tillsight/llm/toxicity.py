"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

**Kernel.** The gap-weighted subsequence kernel of length 4 between words: every increasing
quadruple of positions counts DECAY ** span, spans above MAX_SPAN are left out, and a word's features are
scaled by the norm that its length gives. Inserted or dropped characters ("idxiot", "id.iot")
therefore cost part of the similarity, not all of it. A word starts and ends with a boundary
symbol; runs of single characters ("i d i o t") count as one more word; words longer than WINDOW
are read as overlapping windows, so no text is cut.

**Landmarks.** A bounded set of training words; the kernel matrix of landmarks gives the Nyström
map, and the machine is linear on it. Since the kernel is an inner product over character
quadruples, the trained machine folds into one weight a quadruple: a word's margin is the sum of its
quadruples' weights, which numpy gathers for all distinct words of a chunk at once.

**Training** on labelled sentences with multiple instances: a sentence takes its document's label
(repeated sentences count once); words are counted over the sentences of either label in Spark;
words far more common under the toxic label are candidates, and each toxic
document shares its credit among the candidates in it (expectation maximisation), so that a word
beside an insult keeps little; those with credit left are the witnesses, also with a character
inserted. The machine is refitted in rounds, each adding the clean words of the largest margin as
hard negatives. A document's score is a logistic function of
the TOP (1) largest margins of its words, calibrated on training documents.

Everything is fitted on at most about `sample` documents of either label and `pool` words (both
parameters), so what reaches the driver is bounded; every document is scored, over its whole text.

Defined cases: null and empty texts have no word and get the score of a document without any
suspicious word; without both labels in training every score is the only label (0 if
none); repeated rows are scored alike; null labels are not used; other columns pass through.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import append_columns, chunks, in_arrow

DECAY, MAX_SPAN, WINDOW = 0.6, 7, 24
SAMPLE, POOL, LANDMARKS, TOP = 3000, 3000, 384, 1
CACHE_WORDS = 1_000_000
ORDER, ALPHABET = 4, 39
_RUN = re.compile(r"(?<!\S)(?:\S[ \t]+){2,}\S(?!\S)")
_SENTENCE = re.compile(r"[.!?\n]+")


def _code(ch: str) -> int:
    """1-26 for a-z, 27 for digits, other letters share 28-37; 0 for what is no letter or digit."""
    o = ord(ch)
    if 97 <= o <= 122:
        return o - 96
    if 48 <= o <= 57:
        return 27
    return 28 + o % 10 if ch.isalpha() else 0


class _Codes(dict):
    def __missing__(self, ch: str) -> int:
        self[ch] = _code(ch)
        return self[ch]


_CODE = _Codes()
BOUND = 38


def forms(text: str) -> set[str]:
    """The distinct words of a text, and its runs of single characters as words."""
    low = text.lower()
    out = set(low.split())
    for run in _RUN.findall(low):
        out.add("".join(run.split()))
    return out


def encode(word: str) -> list[tuple[int, ...]]:
    """Symbol strings of a word: itself, or its overlapping windows if it is long."""
    codes = [c for c in map(_CODE.__getitem__, word) if c]
    if not codes:
        return []
    codes = [BOUND, *codes, BOUND]
    if len(codes) <= WINDOW:
        return [tuple(codes)]
    return [tuple(codes[a:a + WINDOW]) for a in range(0, len(codes) - WINDOW // 2, WINDOW // 2)]


_SHAPES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _shape(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Tuples of positions in a word of ``n`` symbols and their weights, of norm one."""
    if n not in _SHAPES:
        at = np.array([(a, *t) for a in range(n) for t in combinations(range(a + 1, min(n, a + MAX_SPAN)), ORDER - 1)],
                      np.int64).reshape(-1, ORDER)
        w = DECAY ** (at[:, -1] - at[:, 0] + 1.0)
        _SHAPES[n] = at, w / max(1e-12, np.sqrt((w * w).sum()))
    return _SHAPES[n]


def _tuples(c: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Numbers of the symbol tuples at ``places`` of each row of ``c``."""
    out = c[:, places[0]]
    for p in places[1:]:
        out = out * ALPHABET + c[:, p]
    return out


def features(words: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, tuple, weight) of every tuple of every word (for small sets)."""
    row, col, val = [], [], []
    for i, w in enumerate(words):
        at, weight = _shape(len(w))
        t = _tuples(np.array(w, np.int64)[at], np.arange(ORDER))
        row.append(np.full(len(t), i))
        col.append(t)
        val.append(weight)
    return np.concatenate(row), np.concatenate(col), np.concatenate(val)


class Machine:
    """Folded weights of the machine and the calibration of document scores."""

    def __init__(self, theta: np.ndarray, bias: float, calibration: np.ndarray | None, constant: float | None = None):
        self.theta, self.bias, self.calibration, self.constant = theta, bias, calibration, constant
        self.known: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}

    def margins(self, words: list[str]) -> np.ndarray:
        """Largest margin over each word's windows; -1 for a word without enough letters or digits."""
        out = np.full(len(words), -1.0)
        if not words:
            return out
        points = np.frombuffer("\n".join(words).encode("utf-32-le", "replace"), "<u4")
        uniq, at = np.unique(points, return_inverse=True)
        codes = np.array([-1 if u == 10 else _CODE[chr(u)] for u in uniq.tolist()], np.int32)[at]
        word = np.cumsum(codes < 0)
        word, codes = word[codes > 0], codes[codes > 0]
        size = np.bincount(word, minlength=len(words))
        first = np.concatenate([[0], np.cumsum(size)])
        for n in np.unique(size[size > 0]).tolist():
            which = np.flatnonzero(size == n)
            c = np.empty((n + 2, len(which)), np.int32)      # a row a place: symbols side by side
            c[0] = c[-1] = BOUND
            c[1:-1] = codes[first[which][None, :] + np.arange(n)[:, None]]
            starts = [0] if n + 2 <= WINDOW else range(0, n + 2 - WINDOW // 2, WINDOW // 2)
            for a in starts:
                part = c[a:a + WINDOW]
                if len(part) >= ORDER:
                    out[which] = np.maximum(out[which], self._window(part))
        return out

    def _window(self, c: np.ndarray) -> np.ndarray:
        """Margins of windows of one length; columns are windows."""
        at, weight = _shape(len(c))
        head = {}
        total = np.full(c.shape[1], self.bias, np.float64)
        for w in np.unique(weight):
            part = np.zeros(c.shape[1], np.float32)
            for i, j, k, m in at[weight == w].tolist():
                for pair in ((i, j), (k, m)):
                    if pair not in head:
                        head[pair] = c[pair[0]] * ALPHABET + c[pair[1]]
                if (i, j, -1) not in head:
                    head[i, j, -1] = head[i, j] * (ALPHABET * ALPHABET)
                part += self.theta[head[i, j, -1] + head[k, m]]
            total += w * part
        return total

    def tops(self, texts: list[str]) -> np.ndarray:
        """The TOP largest margins of each text's distinct words, largest first."""
        per = [forms(t) for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        fresh = list(set().union(*per) - self.known.keys()) if per else []
        self.known.update(zip(fresh, self.margins(fresh).tolist(), strict=True))
        margin = self.known.__getitem__
        out = np.full((len(texts), TOP), -1.0)
        for i, ws in enumerate(per):
            if ws:
                best = heapq.nlargest(TOP, map(margin, ws))
                out[i, :len(best)] = best
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(_design(self.tops(texts)) @ self.calibration, -30, 30)))


def _design(tops: np.ndarray) -> np.ndarray:
    return np.hstack([tops, np.ones((len(tops), 1))])


def _svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0, steps: int = 30) -> np.ndarray:
    """Linear machine with squared hinge loss and a bias (last weight), by Newton steps."""
    x = np.hstack([z, np.ones((len(z), 1))])
    w = np.zeros(x.shape[1])
    reg = np.eye(x.shape[1])
    reg[-1, -1] = 1e-6
    last = None
    for _ in range(steps):
        active = (y * (x @ w) < 1)
        if last is not None and (active == last).all():
            break
        last = active
        xa = x[active] * weight[active, None]
        w = np.linalg.solve(reg + c * x[active].T @ xa, c * xa.T @ y[active])
    return w


def _fit_words(words: list[str], y: np.ndarray, weight: np.ndarray, landmarks: int) -> tuple[np.ndarray, float]:
    """Nyström landmarks, the machine on them, folded to a weight a tuple and a bias."""
    syms = [encode(w)[0] for w in words]
    rng = np.random.default_rng(1)
    pos, neg = np.flatnonzero(y > 0), np.flatnonzero(y < 0)
    # The positives of most weight, and as many negatives drawn at random.
    marks = np.concatenate([pos[np.argsort(-weight[pos], kind="stable")][:landmarks // 2],
                            rng.permutation(neg)[:landmarks // 2]])
    r, t, v = features([syms[i] for i in marks])
    cols, t = np.unique(t, return_inverse=True)
    phi = np.zeros((len(marks), len(cols)), np.float32)
    np.add.at(phi, (r, t), v)
    val, vec = np.linalg.eigh((phi @ phi.T).astype(np.float64))
    good = val > 1e-5 * val[-1]
    whiten = vec[:, good] / np.sqrt(val[good])
    fold = phi.T @ whiten.astype(np.float32)   # tuples seen in landmarks -> Nyström features
    del phi
    z = np.zeros((len(words), fold.shape[1]))
    for a in range(0, len(words), 200):        # a few words' tuples at a time: the driver stays small
        r, t, v = features(syms[a:a + 200])
        at = np.searchsorted(cols, t).clip(max=len(cols) - 1)
        hit = np.flatnonzero(cols[at] == t)
        if len(hit):
            rows, first = np.unique(r[hit], return_index=True)
            z[a + rows] = np.add.reduceat(fold[at[hit]] * v[hit, None].astype(np.float32), first, axis=0)
    w = _svm(z, y, weight)
    theta = np.zeros(ALPHABET ** ORDER, np.float32)
    theta[cols] = fold @ w[:-1]
    return theta, float(w[-1])


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, *, text: str = "text",
          doc_id: str = "doc_id", label: str = "toxic", sample: int = SAMPLE, pool: int = POOL,
          landmarks: int = LANDMARKS, rounds: int = 3) -> Machine:
    """Fit on labelled rows of ``docs`` where ``usable`` holds."""
    spark = docs.sparkSession
    marks = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(
        F.col(doc_id).alias("id")).agg(F.max(label).cast("int").alias("y"))
    if usable is not None:
        marks = marks.where(usable)
    counts = {r["y"]: r["count"] for r in marks.groupBy("y").count().collect() if r["y"] in (0, 1)}
    if len(counts) < 2:
        return Machine(np.zeros(1), 0.0, None, float(1 in counts))
    draw = F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("y") == 1, F.lit(min(1.0, sample / counts[1]))).otherwise(F.lit(min(1.0, sample / counts[0])))
    chosen = marks.where(draw < share)
    fed = (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
           .select("y", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")).checkpoint())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            rows = {(y, s.strip()) for y, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                    for s in _SENTENCE.split(t.decode("utf-8", "replace"))}
            yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in rows], pa.int32()),
                                              pa.array([s for _, s in rows], pa.string())], names=["y", "s"])

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for y, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for w in forms(s):
                    seen.setdefault(w, [0, 0])[y] += 1
            some = [w for w in seen if len(w) <= WINDOW - 2 and len(encode(w) and encode(w)[0]) >= ORDER]
            yield pa.RecordBatch.from_arrays([
                pa.array(some, pa.string()), pa.array([seen[w][1] for w in some], pa.int64()),
                pa.array([seen[w][0] for w in some], pa.int64())], names=["w", "bad", "fine"])

    sentences = in_arrow(fed, cut, "y int, s string").groupBy("s").agg(F.max("y").alias("y")).select("y", "s")
    counted = (in_arrow(sentences, words, "w string, bad bigint, fine bigint").groupBy("w")
               .agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine")).checkpoint())
    total = counted.agg(F.sum("bad").alias("b"), F.sum("fine").alias("f")).first()
    odds = max(1, total["b"] or 0) / max(1, total["f"] or 0)
    # Candidates: words far more common under the toxic label, bounded by `pool`.
    gain = F.col("bad") * F.log((F.col("bad") + 0.5) / (F.col("fine") * F.lit(odds) + 0.5))
    candidates = (counted.where((F.col("bad") >= 3) & (F.col("bad") > 10 * odds * F.col("fine")))
                  .orderBy(gain.desc(), "w").limit(pool).collect())
    strength = _witnesses(fed, [r["w"] for r in candidates])
    drawn = F.xxhash64("w", F.lit("negative"))
    clean = counted.where("fine > 0 and fine >= bad")
    negatives = {r["w"] for r in clean.orderBy(drawn, "w").limit(pool).collect()}
    negatives |= {r["w"] for r in clean.orderBy(F.desc("fine"), "w").limit(pool // 4).collect()}
    machine = Machine(np.zeros(ALPHABET ** ORDER, np.float32), -1.0, None)
    for k in range(rounds if strength and negatives else 0):
        if k:
            negatives |= set(_hardest(counted, machine, pool // 2))
        neg = sorted(negatives - strength.keys())
        # Both sides weigh alike in sum; a witness weighs by the square root of its credit, as
        # do its variants with a letter inserted at each place, which share that credit.
        bent = {w[:i] + "qxzkwj"[(i + len(w)) % 6] + w[i:]: c / len(w)
                for w, c in strength.items() for i in range(1, len(w))}
        bent = {w: c for w, c in bent.items() if w not in strength and len(w) <= WINDOW - 2}
        names = [*strength, *bent, *neg]
        s = np.sqrt(np.array([*strength.values(), *bent.values()]))
        y = np.concatenate([np.ones(len(s)), -np.ones(len(neg))])
        weight = np.concatenate([s / s.sum(), np.full(len(neg), 1 / len(neg))]) * len(names) / 2
        theta, bias = _fit_words(names, y, weight, landmarks)
        machine = Machine(theta, bias, None)
    return _calibrated(machine, fed, counts[1] / (counts[0] + counts[1]))


def _witnesses(fed: DataFrame, candidates: list[str]) -> dict[str, float]:
    """Candidates that explain sampled toxic documents: word -> credit in documents."""
    number = {w: i for i, w in enumerate(candidates)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            has = [sorted({number[w] for w in forms(t.decode("utf-8", "replace")) & number.keys()})
                   for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(has, pa.list_(pa.int32()))], names=["has"])

    rows = in_arrow(fed.where("y = 1"), run, "has array<int>").distinct().toArrow().column(0).to_pylist()
    rows = [np.array(r) for r in rows if r]
    credit = np.bincount(np.concatenate([*rows, np.zeros(0, int)]).astype(int), minlength=len(candidates)).astype(float)
    for _ in range(40):
        fresh = np.zeros(len(candidates))
        for r in rows:
            share = credit[r] + 1e-9
            fresh[r] += share / share.sum()
        credit = fresh
    return {w: c for w, c in zip(candidates, credit.tolist(), strict=True) if c >= 2}


def _hardest(counted: DataFrame, machine: Machine, n: int) -> list[str]:
    """The ``n`` words of clean sentences with the largest margins."""
    held = counted.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            if words:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held.value.margins(words))], names=["w", "m"])

    rows = (in_arrow(counted.where("fine > 0 and fine >= bad").select("w"), run, "w string, m double")
            .orderBy(F.desc("m"), "w").limit(n).collect())
    return [r["w"] for r in rows]


def _calibrated(machine: Machine, fed: DataFrame, prior: float) -> Machine:
    """Logistic calibration of the largest margins on the sampled training documents."""
    held = fed.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            tops = held.value.tops([t.decode("utf-8", "replace") for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(tops[:, i]) for i in range(TOP)]],
                                             names=["y", *[f"m{i}" for i in range(TOP)]])

    got = in_arrow(fed, run, "y int, " + ", ".join(f"m{i} double" for i in range(TOP))).toArrow()
    y = got.column(0).to_numpy().astype(float)
    if len(set(y)) < 2:        # the labelled documents are not in the table, or only those of one label
        return Machine(machine.theta, machine.bias, None, float(y.mean()) if len(y) else 0.0)
    x = _design(np.column_stack([got.column(i + 1).to_numpy() for i in range(TOP)]))
    # The sample may hold the labels in another proportion than all labelled rows.
    weight = np.where(y > 0, prior / max(1, (y > 0).sum()), (1 - prior) / max(1, (y == 0).sum())) * len(y)
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-2] * (x.shape[1] - 1) + [1e-4])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + ridge @ w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        w -= np.linalg.solve(h, g)
    machine.calibration = w
    return machine


def score(docs: DataFrame, machine: Machine, *, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the toxicity score of every text, 0 to 1."""
    held = docs.sparkSession.sparkContext.broadcast(machine)

    def work(col: pa.Array) -> list[pa.Array]:
        return [pa.array(held.value.scores([(t or b"").decode("utf-8", "replace") for t in col.to_pylist()]))]

    return append_columns(docs, text, [(name, "double")], work)
