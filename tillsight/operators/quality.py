"""Checks the reference logs or runs by hand: source profile (X2), row counts (Q1), the sanity
top five (Q2), and the declared keys turned into checks (Q3)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.operators.ranking import top_k


def profile(df: DataFrame, ts: str = "invoice_ts", customer: str = "customer_id",
            product: str = "stock_code", approx: bool = False) -> DataFrame:
    """Row and column count, date range, distinct customers and products, nulls per column,
    as (metric, column_name, value) rows. One aggregation pass over the source, and one per exact
    distinct count (values reduced map-side; together they would multiply every row).
    ``approx=True`` counts distincts with HyperLogLog (``approx_count_distinct``) in the same pass,
    for sources too large for exact distinct counts."""
    aggs = {"row_count|*": F.count(F.lit(1)).cast("string"), "column_count|*": F.lit(str(len(df.columns))),
            f"min|{ts}": F.min(ts).cast("string"), f"max|{ts}": F.max(ts).cast("string")}
    if approx:
        aggs |= {f"distinct|{c}": F.approx_count_distinct(c, 0.01).cast("string") for c in (customer, product)}
    aggs |= {f"nulls|{c}": (F.count(F.lit(1)) - F.count(c)).cast("string") for c in df.columns}
    row = df.agg(*[e.alias(n) for n, e in aggs.items()])
    pairs = ", ".join(f"'{n.split('|')[0]}', '{n.split('|')[1]}', `{n}`" for n in aggs)
    out = row.selectExpr(f"stack({len(aggs)}, {pairs}) AS (metric, column_name, value)")
    for c in () if approx else (customer, product):
        n = df.where(F.col(c).isNotNull()).select(c).distinct().agg(F.count(F.lit(1)).cast("string").alias("value"))
        out = out.unionByName(n.select(F.lit("distinct").alias("metric"), F.lit(c).alias("column_name"), "value"))
    return out


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q1: row count per star table (one plan, a UNION ALL of counts)."""
    out = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name.upper()).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out.orderBy("table_name")


def sanity_top5(star, k: int = 5) -> DataFrame:
    """Q2: top customers by revenue with segment and country (ties broken by customer id)."""
    g = star.fact_sales.groupBy("customer_key").agg(F.sum("revenue").alias("_rev"))
    g = g.join(star.dim_customer.select("customer_key", "customer_id", "segment", "country"), "customer_key")
    top = top_k(g, [("_rev", False), ("customer_id", True)], k)
    return top.select("customer_id", "segment", "country", F.col("_rev").cast("double").alias("total_revenue"))


def _dup_null(df: DataFrame, table: str, key: str, not_null: str) -> DataFrame:
    """Duplicates and nulls of a table's key, nulls of its natural key: one aggregate, stacked."""
    a = df.agg((F.count(F.lit(1)) - F.count_distinct(key)).alias("d"), (F.count(F.lit(1)) - F.count(key)).alias("n"),
               (F.count(F.lit(1)) - F.count(not_null)).alias("nn"))
    return a.selectExpr(f"stack(3, '{table}.{key} duplicate', d, '{table}.{key} null', n, '{table}.{not_null} null', nn)"
                        " AS (check_name, violations)")


def unique_longs(df: DataFrame, key: str) -> DataFrame:
    """One row: ``rows``, ``keys`` (rows with a key) and ``distinct_keys``, exact, of a non-negative integer key.

    Distinct keys are counted as bits: one bitmap of 32,768 keys a bucket, filled map-side and merged by OR. Keys that
    lie close together in a task (as ids given along a write do) shuffle as an eighth of a byte each."""
    bits = df.groupBy(F.bitmap_bucket_number(key).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(key).alias("keys"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(F.coalesce(F.col(key), F.lit(1))))).alias("bits"))
    known = F.when(F.col("bucket").isNotNull(), F.col("bits"))      # the null keys have a bucket of their own
    return bits.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("rows", "rows"), ("keys", "keys"), (known, "distinct_keys"))])


def key_integrity(star) -> DataFrame:
    """Q3: the DDL's PRIMARY KEY / NOT NULL / REFERENCES, which Parquet does not enforce, as
    counts of violations (duplicates and nulls per key, fact rows whose key has no dimension
    row, found with anti joins)."""
    parts = [_dup_null(star.dim_customer, "dim_customer", "customer_key", "customer_id"),
             _dup_null(star.dim_product, "dim_product", "product_key", "product_id"),
             _dup_null(star.dim_date, "dim_date", "date_key", "full_date"),
             _dup_null(star.dim_location, "dim_location", "location_key", "country")]
    f = star.fact_sales
    parts.append(f.agg((F.count(F.lit(1)) - F.count("invoice_id")).alias("violations"))
                 .select(F.lit("fact_sales.invoice_id null").alias("check_name"), "violations"))
    if "sale_id" in f.columns:          # a star that was saved
        parts.append(unique_longs(f, "sale_id").selectExpr(
            "stack(2, 'fact_sales.sale_id duplicate', keys - distinct_keys, 'fact_sales.sale_id null', rows - keys) AS (check_name, violations)"))
    # Keys the order-grain table carries are checked there (one row per order, with its line
    # count), so the anti joins shuffle orders rather than lines; the product key needs the lines.
    grain = getattr(star, "fact_orders", None)
    for key, dim in [("customer_key", star.dim_customer), ("product_key", star.dim_product),
                     ("date_key", star.dim_date), ("location_key", star.dim_location)]:
        if grain is not None and key != "product_key":
            src, rows = grain.select(key, "lines"), F.sum("lines")
        else:
            src, rows = f.select(key), F.count(F.lit(1))
        orphans = src.where(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti")
        parts.append(orphans.agg(F.coalesce(rows, F.lit(0)).alias("violations"))
                     .select(F.lit(f"fact_sales.{key} orphan").alias("check_name"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("check_name", F.col("violations").cast("long"))
