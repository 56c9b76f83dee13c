"""T9–T13 — build the star schema from raw invoice lines.

The cleaned lines with their order value feed five outputs, so they are written
once to the shared checkpoint folder and read back (a written table cuts the lineage and survives
executor loss); money and date columns follow from a line and are derived where they are read. Dimension keys come from ``keys.surrogate_key``; the fact picks them up by joins
on the natural keys (location: broadcast, one row per country; customer and product: AQE turns
the join into a broadcast only when the measured side is below its threshold).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.functions.classify import (DEFAULT_CATEGORY, DEFAULT_REGION, REFERENCE_CATEGORY_RULES,
                                          REFERENCE_REGION_RULES, classify, region_from_table, region_of)
from tillsight.operators.clean import clean, valid_lines
from tillsight.operators.enrich import (SNAPSHOT, enrich_money, line_money, priced_lines, rfm, rfm_scores,
                                        with_date_parts)
from tillsight.operators.joins import Hot, heavy_keys, lookup_join, tasks_for
from tillsight.operators.keys import APPEARANCE, first_seen, surrogate_key
from tillsight.schemas import DIM_CUSTOMER_COLUMNS, DIM_DATE_COLUMNS, DIM_LOCATION_COLUMNS
from tillsight.session import scratch_path


# The keys that lines are joined on.
LINE_KEYS = {"invoice": ["invoice"], "customer": ["customer_id"], "product": ["stock_code"]}


@dataclass
class Star:
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    dim_location: DataFrame
    fact_sales: DataFrame
    extras: dict = field(default_factory=dict)
    fact_orders: DataFrame | None = None
    order_bits: DataFrame | None = None
    snapshot: str = SNAPSHOT

    def tables(self) -> dict[str, DataFrame]:
        return {"dim_customer": self.dim_customer, "dim_product": self.dim_product,
                "dim_date": self.dim_date, "dim_location": self.dim_location,
                "fact_sales": self.fact_sales}


@dataclass
class StarConfig:
    snapshot: str = SNAPSHOT
    dedup_order: Sequence[str] | None = None          # clean.DEFAULT_ORDER
    category_rules: Sequence = tuple(REFERENCE_CATEGORY_RULES)
    region_rules: Sequence = tuple(REFERENCE_REGION_RULES)
    region_table: DataFrame | None = None
    key_mode: str = "dense"
    on_duplicate_edges: str = "raise"
    margin: float = 0.4


def enriched_lines(raw: DataFrame, cfg: StarConfig) -> DataFrame:
    """clean → money → date parts (one lazy plan)."""
    return with_date_parts(enrich_money(clean(raw, cfg.dedup_order), cfg.margin))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back: cuts lineage, survives executor loss."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def dim_customer(scored: DataFrame, key_mode: str = "dense") -> DataFrame:
    """RFM attributes, first country, Returning if more than one invoice, else New."""
    keyed = surrogate_key(scored, "customer_id", "customer_key", key_mode)
    keyed = keyed.withColumn("customer_type",
                             F.when(F.col("frequency") > 1, "Returning").otherwise("New"))
    return keyed.select(*DIM_CUSTOMER_COLUMNS)


def dim_product(lines: DataFrame, rules=REFERENCE_CATEGORY_RULES, key_mode: str = "dense") -> DataFrame:
    """First description per stock code, keyword category."""
    ent = first_seen(lines, "stock_code", carry=["description"])
    keyed = surrogate_key(ent, "stock_code", "product_key", key_mode)
    return keyed.select(F.col("product_key"), F.col("stock_code").alias("product_id"),
                        F.col("description").alias("product_name"),
                        classify("description", rules, DEFAULT_CATEGORY).alias("category"))


def dim_date(lines: DataFrame) -> DataFrame:
    """One row per calendar date (bounded by the date span), sorted by key. Every column is
    a function of the date, so a DISTINCT over them (a hash aggregate) gives one row per date."""
    return lines.select(*DIM_DATE_COLUMNS).distinct().orderBy("date_key")


def dim_location(lines: DataFrame, rules=REFERENCE_REGION_RULES, table: DataFrame | None = None,
                 key_mode: str = "dense") -> DataFrame:
    """One row per country (bounded by the number of countries), region by T15 rules or by a
    lookup table. Numbering in first-appearance order over this bounded set."""
    ent = first_seen(lines, "country")
    if key_mode == "hash":
        keyed = ent.withColumn("location_key", F.xxhash64("country"))
    else:
        w = Window.orderBy(*[F.col(c).asc_nulls_last() for c in APPEARANCE + ["country"]])
        keyed = ent.withColumn("location_key", F.row_number().over(w).cast("long"))
    if table is not None:
        keyed = region_from_table(keyed, "country", table, DEFAULT_REGION)
    else:
        keyed = keyed.withColumn("region", region_of("country", rules, DEFAULT_REGION))
    return keyed.select(*DIM_LOCATION_COLUMNS)


def fact_sales(lines: DataFrame, dc: DataFrame, dp: DataFrame, dl: DataFrame,
               hot: Mapping[str, Hot] | None = None, margin: float = 0.4) -> DataFrame:
    """Lines with the three dimension keys (date key is computed) and the measures, at the source's
    precision; measures that follow from the line are derived behind the joins, so no shuffle carries them. The product join is paid here, so the product's category comes along with its key and no
    mart has to join the lines with the products again. ``hot`` has the hot keys by name (``LINE_KEYS``)."""
    hot = hot or {}
    # Null-safe keys: a null stock code survives cleaning and must find its own product row.
    # Locations are one row per distinct country text; Spark broadcasts them by their measured size.
    loc = dl.select(F.col("country").alias("_loc_nat"), "location_key")
    f = lines.drop("revenue", "discount", "profit").join(loc, F.col("country").eqNullSafe(F.col("_loc_nat")), "left")
    f = lookup_join(f, dc.select("customer_id", "customer_key"), ["customer_id"], hot=hot.get("customer"))
    f = lookup_join(f, dp.select("product_id", "product_key", "category"), ["stock_code"], ["product_id"],
                    null_safe=True, hot=hot.get("product"))
    f = line_money(f, margin)
    return f.select(F.col("invoice").alias("invoice_id"), "customer_key", "product_key", "date_key",
                    "location_key", "quantity", F.col("price").alias("unit_price"),
                    "revenue", "discount", "profit", "order_value", "category")


def order_grain(fact: DataFrame) -> DataFrame:
    """Aggregate table, one row per (invoice, customer, date, location): exact sums, the line
    count and the count of order values. Every date, location and customer mart reads this
    instead of the lines; distinct counts, sums and line-weighted means are unchanged."""
    return fact.groupBy("invoice_id", "customer_key", "date_key", "location_key").agg(
        F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"),
        F.sum("order_value").alias("order_value"), F.count("order_value").alias("ov_n"),
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").cast("long").alias("quantity"))


def build_star(raw: DataFrame, cfg: StarConfig | None = None, persist: bool = True) -> Star:
    """The whole ETL: raw lines → star. ``persist`` writes the enriched lines and the dimensions
    to the shared folder so each is computed once."""
    cfg = cfg or StarConfig()
    hot = {}
    if persist:
        valid = valid_lines(raw)
        found = heavy_keys(valid, {"invoice": LINE_KEYS["invoice"]}).get("invoice")
        priced = materialize(priced_lines(valid, cfg.dedup_order, cfg.margin, found, tasks_for(raw)), "lines")
        # One pass over the written lines finds the hot keys of the other line joins.
        hot = heavy_keys(priced, {k: v for k, v in LINE_KEYS.items() if k != "invoice"})
        cleaned = priced.drop("order_value")       # T1's output, also served by the etl_clean query
        lines = line_money(priced, cfg.margin).select(*cleaned.columns, "revenue", "discount", "profit", "order_value")
    else:
        cleaned = clean(raw, cfg.dedup_order)
        lines = enrich_money(cleaned, cfg.margin)
    lines = with_date_parts(lines)
    metrics = rfm(lines, cfg.snapshot)
    if persist:
        metrics = materialize(metrics, "rfm")      # read by the recency histogram and the ranking
    scored = rfm_scores(metrics, on_duplicate_edges=cfg.on_duplicate_edges)
    if persist:
        scored = materialize(scored, "scored")     # feeds the customer dimension and T4–T7 queries
    dc = dim_customer(scored, cfg.key_mode)
    dp = dim_product(lines, cfg.category_rules, cfg.key_mode)
    dl = dim_location(lines, cfg.region_rules, cfg.region_table, cfg.key_mode)
    if persist:
        dc, dp, dl = materialize(dc, "dim_customer"), materialize(dp, "dim_product"), materialize(dl, "dim_location")
    dd = dim_date(lines)
    fact = fact_sales(lines, dc, dp, dl, hot, cfg.margin)
    return Star(dc, dp, dd, dl, fact, extras={"cleaned": cleaned, "lines": lines, "scored": scored},
                snapshot=cfg.snapshot)
