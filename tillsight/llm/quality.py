"""Quality rules with a verdict on hosts, in DataFrame functions only.

Every document gets its counts from array functions on its own row (no text is exploded or
shuffled). Rule failures are then summed by host (partial aggregation first, so a host with a third
of all rows costs its task one row a map task). Per rule, a beta prior is fitted to the hosts' rates
by moments (the rates' mean, and their variance weighted by documents); a host's rate is shrunk to
(failures + a) / (documents + a + b), so a host with few documents is judged by what is usual. A host
is rejected if a shrunk rate exceeds `max_rate`; the verdicts, one row a host, are joined back.
A document is kept if it passes the base rule and its host is not rejected.

Rules: base (fewer than 10 words, or over 20 % of the words in repeated five-word windows),
symbols (over 10 symbols for 100 characters in words), lines (over 30 repeated lines for 100 lines).

Defined cases: a null text has no word and fails the base rule; a null host is one host; repeated rows
count and are judged each; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import WORD_PATTERN, free_name, if_small, stored, without
from tillsight.session import checkpoint_dir

WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
MAX_SYMBOL_PERCENT, MAX_DUP_LINE_PERCENT = 10, 30
MAX_RATE = 0.5
STRENGTH = (1.0, 1e6)          # bounds of the prior's weight in documents
SYMBOLS = r"[#*$%&|<>]"        # fixed: the symbols that are counted

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RULES = ("base", "symbols", "lines")


def counted(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the count columns, ``n_lines`` and ``base_failed`` (names after ``prefix``)."""
    name = {k: prefix + k for k in (*COUNTS, "n_lines", "base_failed")}
    docs = without(docs, list(name.values()))
    own = docs.columns
    tmp = {k: free_name(docs, f"{prefix}_{k}") for k in ("t", "w", "l", "h", "s", "p")}
    c = {k: F.col(f"`{v}`") for k, v in (tmp | name).items()}
    keep = [F.col(f"`{x}`") for x in own]
    a = docs.select(*keep, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(tmp["t"]))
    # Words and lines once; each later step is its own projection, so nothing is evaluated twice.
    a = a.select(*keep, F.regexp_extract_all(c["t"], F.lit(WORD_PATTERN), F.lit(0)).alias(tmp["w"]),
                 F.filter(F.split(c["t"], "\n"), lambda x: x.rlike(WORD_PATTERN)).alias(tmp["l"]),
                 F.regexp_count(c["t"], F.lit(SYMBOLS)).cast("long").alias(name["n_symbols"]))
    w = c["w"]
    a = a.select(*keep, c["n_symbols"], F.size(w).cast("long").alias(name["n_words"]),
                 F.length(F.array_join(w, "")).cast("long").alias(name["word_chars"]),
                 F.size(c["l"]).cast("long").alias(name["n_lines"]),
                 (F.size(c["l"]) - F.size(F.array_distinct(c["l"]))).cast("long").alias(name["n_dup_lines"]),
                 F.when(F.size(w) > WINDOW, F.transform(
                     F.sequence(F.lit(0), F.size(w) - WINDOW),
                     lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))).alias(tmp["h"]))
    early = [*keep, *[c[k] for k in ("n_symbols", "n_words", "word_chars", "n_lines", "n_dup_lines")]]
    # Windows of a text with a repeated one, sorted by hash; other texts stop at the distinct count.
    a = a.select(*early, F.when(F.size(F.array_distinct(c["h"])) < F.size(c["h"]), F.sort_array(
        F.transform(c["h"], lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias(tmp["s"]))
    s = c["s"]

    def repeated(j: Column) -> Column:
        here = F.get(s, j)["h"]
        return F.coalesce(here == F.get(s, j - 1)["h"], F.lit(False)) | F.coalesce(here == F.get(s, j + 1)["h"], F.lit(False))

    a = a.select(*early, F.when(s.isNotNull(), F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), F.size(s) - 1), repeated), lambda j: F.get(s, j)["i"]))).alias(tmp["p"]))
    p = c["p"]
    # Words covered by the repeated windows, which start at the sorted places p.
    cover = F.aggregate(p, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
                        lambda acc, x: F.struct((acc["n"] + F.least(F.lit(WINDOW), x - acc["last"])).alias("n"),
                                                x.alias("last")), lambda acc: acc["n"])
    a = a.select(*early, F.coalesce(cover, F.lit(0).cast("long")).alias(name["n_repeat_words"]))
    failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
    return a.select(*keep, *[c[k] for k in (*COUNTS, "n_lines")], failed.alias(name["base_failed"]))


def failures(prefix: str = "") -> dict[str, Column]:
    """Rule -> whether the document fails it."""
    c = lambda k: F.col(f"`{prefix}{k}`")
    return {"base": c("base_failed"),
            "symbols": 100 * c("n_symbols") > MAX_SYMBOL_PERCENT * c("word_chars"),
            "lines": 100 * c("n_dup_lines") > MAX_DUP_LINE_PERCENT * c("n_lines")}


def host_verdicts(rated: DataFrame, host: str = "source", prefix: str = "", max_rate: float = MAX_RATE) -> DataFrame:
    """(host, n_docs, rate of every rule after shrinkage, rejected), one row a host."""
    hosts = rated.groupBy(F.col(f"`{host}`").alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(cond.cast("int")).alias(f"f_{r}") for r, cond in failures(prefix).items()])
    n = F.sum("n_docs")
    means = hosts.agg(n.alias("n"), *[(F.sum(f"f_{r}") / n).alias(f"m_{r}") for r in RULES]).first()   # one row
    mean = {r: float(means[f"m_{r}"] or 0.0) for r in RULES}
    spread = hosts.agg(*[(F.sum(F.col("n_docs") * F.pow(F.col(f"f_{r}") / F.col("n_docs") - mean[r], 2)) / n).alias(r)
                         for r in RULES]).first()
    out = hosts
    for r in RULES:
        m, v = mean[r], float(spread[r] or 0.0)
        weight = min(max(m * (1 - m) / v - 1 if v > 0 else STRENGTH[1], STRENGTH[0]), STRENGTH[1])
        out = out.withColumn(f"rate_{r}", (F.col(f"f_{r}") + m * weight) / (F.col("n_docs") + weight))
    return out.select("host", "n_docs", *[f"rate_{r}" for r in RULES],
                      (F.greatest(*[f"rate_{r}" for r in RULES]) > max_rate).alias("rejected"))


def judge(docs: DataFrame, *, text: str = "text", host: str = "source", prefix: str = "", kept: str = "kept",
          carry: list[str] | None = None, max_rate: float = MAX_RATE) -> DataFrame:
    """``docs`` (or its columns ``carry``) with the counts, base_failed and ``kept``.

    The counts are stored once, for the hosts' sums and the result."""
    checkpoint_dir(docs.sparkSession)
    made = {prefix + k for k in (*COUNTS, "n_lines", "base_failed")} | {kept}
    own = [c for c in carry or docs.columns if c.lower() not in made]
    rated = counted(docs, text, prefix).select(
        *[f"`{x}`" for x in dict.fromkeys([*own, host])],
        *[f"`{prefix}{k}`" for k in (*COUNTS, "n_lines", "base_failed")])
    rated = stored(rated, "quality")
    bad = host_verdicts(rated, host, prefix, max_rate).where("rejected").select(F.col("host").alias("_host"), "rejected")
    bad = if_small(bad)        # documents are not shuffled to meet a few rejected hosts
    out = rated.join(bad, rated[f"`{host}`"].eqNullSafe(bad["_host"]), "left")
    verdict = ~F.col(f"`{prefix}base_failed`") & bad["rejected"].isNull()
    return out.select(*[rated[f"`{x}`"] for x in own], *[rated[f"`{prefix}{k}`"] for k in (*COUNTS, "base_failed")],
                      verdict.alias(kept))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The documents that the rules and their host's verdict keep; ``docs``' columns."""
    prefix = free_name(docs, "q_")
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    rated = judge(docs, prefix=prefix, kept=f"{prefix}kept", **options)
    return rated.where(F.col(f"`{prefix}kept`")).select(*[f"`{c}`" for c in docs.columns])


#: DuckDB form of the op10 query.
ORACLE = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, source, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d
), l AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY r
), g AS (
  SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS x
  FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w WHERE len(ws) >= 5)
), hit AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM g) WHERE n > 1
), rep AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(generate_series(i, i + 4)) AS p FROM hit) GROUP BY r
), c AS (
  SELECT w.r, doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(coalesce(l.n_dup_lines, 0) AS BIGINT) AS n_dup_lines, coalesce(l.n_lines, 0) AS n_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN l ON l.r = w.r LEFT JOIN rep ON rep.r = w.r
), f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         100 * n_symbols > 10 * word_chars AS sym_failed, 100 * n_dup_lines > 30 * n_lines AS line_failed FROM c
), h AS (
  SELECT source, rule, count(*) AS n, sum(CAST(bad AS INT)) AS k
  FROM (SELECT source, unnest(['b', 's', 'l']) AS rule, unnest([base_failed, sym_failed, line_failed]) AS bad FROM f)
  GROUP BY source, rule
), m AS (
  SELECT rule, sum(k) / sum(n) AS m FROM h GROUP BY rule
), v AS (
  SELECT h.rule, any_value(m.m) AS m, sum(n * (k / n - m.m) * (k / n - m.m)) / sum(n) AS v
  FROM h JOIN m ON m.rule = h.rule GROUP BY h.rule
), p AS (
  SELECT rule, m, least(greatest(CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE 1e6 END, 1.0), 1e6) AS s FROM v
), bad AS (
  SELECT h.source, max((k + m * s) / (n + s)) > 0.5 AS rejected FROM h JOIN p ON p.rule = h.rule GROUP BY h.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT bad.rejected AS kept
FROM f JOIN bad ON bad.source IS NOT DISTINCT FROM f.source
"""
