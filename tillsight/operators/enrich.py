"""T2–T7, T16 — money columns, date parts, RFM metrics and scores, segments.

Shuffles at line grain: one by invoice, which dedups the lines and gives the order value. Everything
per customer is an aggregation (partial aggregation first), and the scores rank customers with
``ranking.sequence``, never in a single partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.functions.classify import segment
from tillsight.functions.dates import date_parts, recency_days
from tillsight.functions.numeric import money
from tillsight.operators.clean import by_invoice, dedup
from tillsight.operators.joins import Hot, lookup_join
from tillsight.operators.keys import part_of
from tillsight.operators.ranking import quantile_bins

MARGIN = 0.4            # fixed value: assumed profit margin
SNAPSHOT = "2012-01-01"  # reference default; a parameter everywhere


def enrich_money(df: DataFrame, margin: float = MARGIN, hot_invoices: Hot | None = None) -> DataFrame:
    """revenue = round(qty × price, 2) half-up; discount 0.0; profit = round(margin × revenue,
    2); order_value = the invoice's total of cleaned revenue (null for a null invoice).

    The invoice total is a partial aggregation joined back on the invoice; a hot invoice is split
    by the join (``joins.lookup_join``) rather than sorted in one task as a window would be.
    """
    df = line_money(df, margin)
    totals = df.groupBy("invoice").agg(F.sum("revenue").cast("decimal(18,2)").alias("order_value"))
    return lookup_join(df, totals, ["invoice"], hot=hot_invoices)


def line_money(df: DataFrame, margin: float = MARGIN) -> DataFrame:
    """T2's columns that follow from the line alone: revenue, discount, profit."""
    for name, col in measures(margin).items():
        df = df.withColumn(name, col)
    return df


def measures(margin: float = MARGIN, price: str = "price") -> dict[str, Column]:
    """Revenue, discount and profit of a line."""
    revenue = money(F.col("quantity") * F.col(price))
    return {"revenue": revenue, "discount": F.lit(0.0), "profit": money(revenue * F.lit(margin).cast("decimal(3,2)"))}


def priced_lines(valid: DataFrame, order=None, margin: float = MARGIN, hot_invoices: Hot | None = None,
                 tasks: int | None = None) -> DataFrame:
    """T1's dedup and T2's order value in one exchange: ``clean.by_invoice`` gives a task all lines of its invoices. The
    lines of ``hot_invoices`` meet their totals in ``enrich_money`` instead."""
    rest, cut = by_invoice(valid, hot_invoices, tasks)
    total = F.sum("revenue").over(Window.partitionBy("invoice")).cast("decimal(18,2)")
    out = line_money(dedup(rest, order), margin).withColumn("order_value", F.when(F.col("invoice").isNotNull(), total))
    out = out.select(*valid.columns, "order_value")
    if cut is not None:
        cut = enrich_money(dedup(cut, order), margin, hot_invoices)
        out = out.unionByName(cut.select(*valid.columns, "order_value"))
    return out


def with_date_parts(df: DataFrame, ts: str = "invoice_ts") -> DataFrame:
    """The ten date columns."""
    return df.withColumns(date_parts(ts))


def rfm(df: DataFrame, snapshot=SNAPSHOT) -> DataFrame:
    """T4 + first-appearance attributes: lines to (customer, invoice) pairs, pairs to customers, so that the
    distinct invoices are counted as rows.

    recency = whole days from the last purchase to the snapshot; frequency = distinct invoices;
    monetary = Σ revenue (exact decimal). ``first_*`` come from the customer's first line in the
    appearance order (timestamp, invoice, line) and give the dimension's country and key order.
    """
    pairs = df.groupBy("customer_id", "invoice").agg(
        F.max("invoice_ts").alias("_last"), F.sum("revenue").alias("_sum"),
        F.min(F.struct("invoice_ts", part_of(df), "line_no", "country")).alias("_f"))
    agg = pairs.groupBy("customer_id").agg(
        F.max("_last").alias("last_purchase"),
        F.count("invoice").alias("frequency"),
        F.sum("_sum").alias("monetary"),
        F.min(F.struct("_f.invoice_ts", "invoice", "_f.part_no", "_f.line_no", "_f.country")).alias("_first"))
    return agg.select(
        "customer_id", "last_purchase",
        recency_days("last_purchase", snapshot).alias("recency_days"),
        F.col("frequency").cast("long").alias("frequency"),
        F.col("monetary").cast("decimal(28,2)").alias("monetary"),
        F.col("_first.country").alias("country"),
        F.col("_first.invoice_ts").alias("first_ts"),
        F.col("_first.invoice").alias("first_invoice"),
        F.col("_first.line_no").alias("first_line"))


def rfm_scores(rfm_df: DataFrame, k: int = 5, on_duplicate_edges: str = "raise") -> DataFrame:
    """T5–T7. R: quintile of recency by value, labels reversed (k = most recent). F and M:
    quintile bins of the first-come rank, ties broken by customer id ascending (the order the
    reference's group-by leaves rows in). Then rfm_score, segment and clv."""
    out = quantile_bins(rfm_df, "recency_days", k, "r_score", "customer_id", method="value",
                        labels=list(range(k, 0, -1)), on_duplicate_edges=on_duplicate_edges)
    out = quantile_bins(out, "frequency", k, "f_score", "customer_id", method="first")
    out = quantile_bins(out, "monetary", k, "m_score", "customer_id", method="first")
    out = out.withColumns({c: F.col(c).cast("int") for c in ["r_score", "f_score", "m_score"]})
    out = out.withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
    out = out.withColumn("segment", segment("r_score", "f_score", "m_score"))
    return out.withColumn("clv", F.round(F.col("monetary"), 2).cast("decimal(28,2)"))


def attach_rfm(df: DataFrame, scored: DataFrame) -> DataFrame:
    """Customer metrics onto every line (left join on the customer id)."""
    cols = ["customer_id", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score",
            "rfm_score", "segment", "clv"]
    return lookup_join(df, scored.select(*cols), ["customer_id"])
