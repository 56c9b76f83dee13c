"""T8 — surrogate keys.

``dense``: 1..n in order of first appearance, as the reference numbers them. The order is the
entity's first line (timestamp, invoice, part, line number), then the natural key, so it is total.
Numbering is a global row number, computed with ``ranking.sequence`` over the entity table (one
row per entity), never in a single partition.

``hash``: ``xxhash64`` of the natural key. No ranking and no join back to the lines are
needed, which suits a fact table too large to shuffle again; the dimension check (Q3) reports
any collision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.operators.ranking import sequence

APPEARANCE = ["first_ts", "first_invoice", "first_line"]


def part_of(df: DataFrame) -> Column:
    """The part's number, which orders lines before their place in the part."""
    return (F.col("part_no") if "part_no" in df.columns else F.lit(0)).alias("part_no")


def invoice_grain(df: DataFrame, *keys: str) -> DataFrame:
    """Lines summed to one row per (keys, invoice, timestamp, part): first line number and revenue. A hash
    aggregate (its buffers are numbers), combined map-side; what needs the first line of an entity
    then orders invoices instead of lines."""
    return df.groupBy(*keys, "invoice", "invoice_ts", part_of(df)).agg(
        F.min("line_no").alias("line_no"), F.sum("revenue").alias("revenue"))


def first_seen(df: DataFrame, natural: str, carry: list[str] | None = None) -> DataFrame:
    """One row per natural key with its first line's (timestamp, invoice, line) and carried
    attributes taken from that same line."""
    carry = carry or []
    first = F.min(F.struct("invoice_ts", "invoice", part_of(df), "line_no", *carry)).alias("_f")
    return df.groupBy(natural).agg(first).select(
        natural, F.col("_f.invoice_ts").alias("first_ts"), F.col("_f.invoice").alias("first_invoice"),
        F.col("_f.line_no").alias("first_line"), *[F.col(f"_f.{c}").alias(c) for c in carry])


def surrogate_key(entities: DataFrame, natural: str, key: str, mode: str = "dense") -> DataFrame:
    """Add ``key`` to a one-row-per-entity frame that has the ``first_*`` appearance columns."""
    if mode == "hash":
        return entities.withColumn(key, F.xxhash64(F.col(natural)))
    if mode != "dense":
        raise ValueError(f"unknown key mode {mode!r}")
    order = [(c, True) for c in APPEARANCE] + [(natural, True)]
    return sequence(entities, order, row_number=key)
