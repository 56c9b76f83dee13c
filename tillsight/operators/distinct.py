"""A2–A4: exact distinct counts that merge, as bitmaps over dense keys.

``order_bitmaps`` turns the order grain into one row per (kind, month, location, bucket of 32,768 keys) with a
bitmap of the keys seen there: orders by ``order_no``, customers by ``customer_key``. Bitmaps merge by OR, so the
distinct counts of a year, a region or the whole come from this table alone, without the orders and without
expanding them once a counted column. It is written with the star.

Month and location are the finest grain that the marts count by. A bitmap takes 4 KB however few keys it holds, which
is why days are not kept apart: a month's buckets hold thirty times the keys of a day's. Its size is bounded by
4 KB x months x locations x (keys / 32,768), and by one bitmap a pair of order row and kind.

Only dense keys pay: ``dense`` tells from a dimension whether its keys are numbered. With hashed keys every row would
have a bitmap of its own; the marts then count distinct values of the orders instead, with the same results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER_NO = "order_no"
KINDS = {"order": ORDER_NO, "customer": "customer_key"}


def with_order_no(grain: DataFrame) -> DataFrame:
    """The order grain with a number per invoice: the place of its first row, so numbers grow along each task and
    leave few gaps. Rows are dealt by invoice and sorted by all columns, so a repeated task numbers them alike; a null
    invoice has no number, as a distinct count ignores it."""
    rest = [c for c in grain.columns if c != ORDER_NO]
    placed = grain.select(rest).repartition("invoice_id").sortWithinPartitions("invoice_id", *[c for c in rest if c != "invoice_id"])
    first = F.min("_place").over(Window.partitionBy("invoice_id"))
    return (placed.withColumn("_place", F.monotonically_increasing_id() + 1)
            .withColumn(ORDER_NO, F.when(F.col("invoice_id").isNotNull(), first)).drop("_place"))


def dense(dim: DataFrame, key: str) -> bool:
    """Whether a dimension's keys are positive numbers with at least every second one taken."""
    r = dim.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n")).first()
    return r["n"] == 0 or (r["low"] is not None and r["low"] >= 1 and r["high"] <= 2 * r["n"] + 32_768)


def order_bitmaps(grain: DataFrame) -> DataFrame:
    """(kind, month_no, location_key, bucket, bits) of an order grain that has ``order_no``."""
    named = ", ".join(f"'{k}', {c}" for k, c in KINDS.items())
    keys = grain.select(F.floor(F.col("date_key") / 100).cast("int").alias("month_no"), "location_key",
                        F.expr(f"stack({len(KINDS)}, {named}) AS (kind, key)")).where("key IS NOT NULL")
    return (keys.groupBy("kind", "month_no", "location_key", F.bitmap_bucket_number("key").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bits")))


def merged_counts(bits: DataFrame, by: list[str], **names: str) -> DataFrame:
    """``bits`` merged to one row per ``by``; ``names`` gives a result column the kind that it counts."""
    per = bits.groupBy(*by, "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return per.groupBy(*by).agg(*[_total(kind).alias(name) for name, kind in names.items()])


def _total(kind: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).cast("long")
