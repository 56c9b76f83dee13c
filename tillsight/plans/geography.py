"""Geography marts G1–G6. The location dimension is broadcast (one row per country); after the
aggregation there is one row per country or region, so ranks and shares run over few rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.functions.numeric import pct, round_money
from tillsight.operators.ranking import ranked_top
from tillsight.operators.star import Star
from tillsight.oracle import sql as O
from tillsight.plans.common import (bigint_cols, counted, money_sum, n_customers, n_orders, order_value_avg, orders,
                                    units, with_customer, with_date, with_location)


def _rank_desc(c: str, *part: str):
    return F.rank().over(Window.partitionBy(*part).orderBy(F.col(c).desc()))


def by_region(star: Star) -> DataFrame:
    """G1."""
    g = counted(star, ["region"], "order_count", "unique_customers", [
        F.count_distinct("country").alias("country_count"),
        F.sum("revenue").alias("_rev"), money_sum("profit").alias("total_profit"),
        order_value_avg().alias("avg_order_value")], place=["region", "country"])
    g = (g.withColumn("revenue_rank", _rank_desc("_rev"))
          .withColumn("revenue_share_pct", pct("_rev", F.sum("_rev").over(Window.partitionBy())))
          .withColumn("total_revenue", round_money("_rev")))
    return bigint_cols(g.select("region", "country_count", "order_count", "unique_customers", "total_revenue",
                                "total_profit", "avg_order_value", "revenue_rank", "revenue_share_pct")
                        .orderBy("revenue_rank"))


def by_country(star: Star) -> DataFrame:
    """Global and regional ranks and shares."""
    g = counted(star, ["region", "country"], "order_count", "unique_customers", [
        F.sum("revenue").alias("_rev"), money_sum("profit").alias("total_profit"),
        order_value_avg().alias("avg_order_value"), units().alias("total_units_sold")], place=["region", "country"])
    g = (g.withColumn("global_rank", _rank_desc("_rev"))
          .withColumn("region_rank", _rank_desc("_rev", "region"))
          .withColumn("global_revenue_share_pct", pct("_rev", F.sum("_rev").over(Window.partitionBy())))
          .withColumn("region_revenue_share_pct", pct("_rev", F.sum("_rev").over(Window.partitionBy("region"))))
          .withColumn("total_revenue", round_money("_rev")))
    return bigint_cols(g.select("region", "country", "order_count", "unique_customers", "total_revenue",
                                "total_profit", "avg_order_value", "total_units_sold", "global_rank",
                                "region_rank", "global_revenue_share_pct", "region_revenue_share_pct")
                        .orderBy("global_rank"))


def top_markets(star: Star, k: int = 10) -> DataFrame:
    """Top k countries (ties at the cut broken by country)."""
    g = counted(star, ["country", "region"], "order_count", "unique_customers", [
        F.sum("revenue").alias("_rev"), order_value_avg().alias("avg_order_value")], place=["region", "country"])
    top = ranked_top(g, [("_rev", False), ("country", True)], k, "_rev", "revenue_rank")
    top = top.withColumn("total_revenue", round_money("_rev"))
    return bigint_cols(top.select("country", "region", "unique_customers", "order_count", "total_revenue",
                                  "avg_order_value", "revenue_rank").orderBy("revenue_rank", "country"))


def segment_by_region(star: Star) -> DataFrame:
    """Segment share of each region's customers (a customer counts once per region it bought
    in). The fact is first reduced to (customer, location) grain."""
    f = orders(star).groupBy("customer_key", "location_key").agg(F.sum("revenue").alias("revenue"))
    f = with_customer(with_location(f, star.dim_location, "region"), star.dim_customer, "segment")
    g = f.groupBy("region", "segment").agg(F.count_distinct("customer_key").alias("customer_count"),
                                           money_sum("revenue").alias("total_revenue"))
    g = g.withColumn("segment_pct_in_region",
                     pct("customer_count", F.sum("customer_count").over(Window.partitionBy("region"))))
    return bigint_cols(g.select("region", "segment", "customer_count", "total_revenue", "segment_pct_in_region")
                        .orderBy("region", F.col("total_revenue").desc()))


def region_trend(star: Star) -> DataFrame:
    """Monthly revenue per region with the change from the previous month present."""
    f = with_date(with_location(orders(star), star.dim_location, "region"), star.dim_date,
                  "year", "month", "month_name")
    g = f.groupBy("year", "month", "month_name", "region").agg(
        F.sum("revenue").alias("_rev"), n_orders().alias("order_count"))
    prev = F.lag("_rev").over(Window.partitionBy("region").orderBy("year", "month"))
    g = (g.withColumn("mom_revenue_change", round_money(F.col("_rev") - prev))
          .withColumn("total_revenue", round_money("_rev")))
    return bigint_cols(g.select("year", "month", "month_name", "region", "total_revenue", "order_count",
                                "mom_revenue_change").orderBy("region", "year", "month"))


def aov_by_country(star: Star, min_orders: int = 10, k: int = 15) -> DataFrame:
    """Line-weighted mean order value per country with at least ``min_orders`` orders."""
    f = with_location(orders(star), star.dim_location, "region", "country")
    g = f.groupBy("country", "region").agg(
        n_orders().alias("order_count"), order_value_avg(None).alias("_aov"),
        money_sum("revenue").alias("total_revenue"))
    g = g.where(F.col("order_count") >= min_orders)
    top = ranked_top(g, [("_aov", False), ("country", True)], k, "_aov", "aov_rank")
    top = top.withColumn("avg_order_value", F.round(F.col("_aov").cast("decimal(38,8)"), 2).cast("double"))
    return bigint_cols(top.select("country", "region", "order_count", "avg_order_value", "total_revenue",
                                  "aov_rank").orderBy("aov_rank", "country"))


MARTS = {"by_region": by_region, "by_country": by_country, "top_markets": top_markets,
         "segment_by_region": segment_by_region, "region_trend": region_trend,
         "aov_by_country": aov_by_country}

_FL = "FROM fact_sales f JOIN dim_location l ON f.location_key = l.location_key"

ORACLE = {
    "by_region": O.with_prelude(f"""
SELECT l.region, count(DISTINCT l.country) AS country_count, count(DISTINCT f.invoice_id) AS order_count,
       count(DISTINCT f.customer_key) AS unique_customers, {O.money('sum(f.revenue)')} AS total_revenue,
       {O.money('sum(f.profit)')} AS total_profit, {O.avg('f.order_value', 2)} AS avg_order_value,
       CAST(RANK() OVER (ORDER BY sum(f.revenue) DESC) AS BIGINT) AS revenue_rank,
       {O.pct('sum(f.revenue)', 'SUM(sum(f.revenue)) OVER ()')} AS revenue_share_pct
{_FL} GROUP BY l.region ORDER BY revenue_rank"""),

    "by_country": O.with_prelude(f"""
SELECT l.region, l.country, count(DISTINCT f.invoice_id) AS order_count, count(DISTINCT f.customer_key) AS unique_customers,
       {O.money('sum(f.revenue)')} AS total_revenue, {O.money('sum(f.profit)')} AS total_profit,
       {O.avg('f.order_value', 2)} AS avg_order_value, CAST(sum(f.quantity) AS BIGINT) AS total_units_sold,
       CAST(RANK() OVER (ORDER BY sum(f.revenue) DESC) AS BIGINT) AS global_rank,
       CAST(RANK() OVER (PARTITION BY l.region ORDER BY sum(f.revenue) DESC) AS BIGINT) AS region_rank,
       {O.pct('sum(f.revenue)', 'SUM(sum(f.revenue)) OVER ()')} AS global_revenue_share_pct,
       {O.pct('sum(f.revenue)', 'SUM(sum(f.revenue)) OVER (PARTITION BY l.region)')} AS region_revenue_share_pct
{_FL} GROUP BY l.region, l.country ORDER BY global_rank"""),

    "top_markets": O.with_prelude(f"""
SELECT l.country, l.region, count(DISTINCT f.customer_key) AS unique_customers, count(DISTINCT f.invoice_id) AS order_count,
       {O.money('sum(f.revenue)')} AS total_revenue, {O.avg('f.order_value', 2)} AS avg_order_value,
       CAST(RANK() OVER (ORDER BY sum(f.revenue) DESC) AS BIGINT) AS revenue_rank
{_FL} GROUP BY l.country, l.region ORDER BY revenue_rank, l.country LIMIT 10"""),

    "segment_by_region": O.with_prelude(f"""
SELECT l.region, c.segment, count(DISTINCT c.customer_key) AS customer_count, {O.money('sum(f.revenue)')} AS total_revenue,
       {O.pct('count(DISTINCT c.customer_key)', 'SUM(count(DISTINCT c.customer_key)) OVER (PARTITION BY l.region)')} AS segment_pct_in_region
FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key
JOIN dim_location l ON f.location_key = l.location_key
GROUP BY l.region, c.segment ORDER BY l.region, total_revenue DESC"""),

    "region_trend": O.with_prelude(f"""
SELECT CAST(d.year AS BIGINT) AS year, CAST(d.month AS BIGINT) AS month, d.month_name, l.region,
       {O.money('sum(f.revenue)')} AS total_revenue, count(DISTINCT f.invoice_id) AS order_count,
       {O.money('sum(f.revenue) - LAG(sum(f.revenue)) OVER (PARTITION BY l.region ORDER BY d.year, d.month)')} AS mom_revenue_change
FROM fact_sales f JOIN dim_date d ON f.date_key = d.date_key JOIN dim_location l ON f.location_key = l.location_key
GROUP BY d.year, d.month, d.month_name, l.region ORDER BY l.region, d.year, d.month"""),

    "aov_by_country": O.with_prelude(f"""
SELECT l.country, l.region, count(DISTINCT f.invoice_id) AS order_count, {O.avg('f.order_value', 2)} AS avg_order_value,
       {O.money('sum(f.revenue)')} AS total_revenue,
       CAST(RANK() OVER (ORDER BY CAST(sum(f.order_value) AS DOUBLE) / count(f.order_value) DESC) AS BIGINT) AS aov_rank
{_FL} GROUP BY l.country, l.region HAVING count(DISTINCT f.invoice_id) >= 10
ORDER BY aov_rank, l.country LIMIT 15"""),
}
