"""Sales marts S1–S7. The fact is aggregated to calendar grain first (date dimension broadcast);
windows then run over months, quarters or years, a set bounded by the calendar span."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.functions.numeric import growth_pct, pct, ratio, round_to
from tillsight.operators.ranking import top_k
from tillsight.operators.star import Star
from tillsight.oracle import sql as O
from tillsight.plans.common import (bigint_cols, counted, money_sum, n_customers, n_orders, order_value_avg,
                                    orders, with_date)

_UNB = Window.unboundedPreceding


def monthly(star: Star) -> DataFrame:
    """Per (year, month): orders, customers, revenue (exact, rounded), profit, line-weighted AOV."""
    month = ["year", "month", "month_name"]
    return counted(star, month, "order_count", "unique_customers", [
        F.round(F.sum("revenue"), 2).alias("total_revenue"),
        money_sum("profit").alias("total_profit"),
        order_value_avg().alias("avg_order_value")], calendar=month)


def monthly_growth(star: Star) -> DataFrame:
    """MoM and YoY growth (LAG over the previous row present), year-to-date revenue."""
    m = monthly(star)
    by_month = Window.partitionBy("month").orderBy("year")
    seq = Window.orderBy("year", "month")
    ytd = Window.partitionBy("year").orderBy("month").rowsBetween(_UNB, 0)
    m = (m.withColumn("prev_year_revenue", F.lag("total_revenue").over(by_month))
          .withColumn("prev_month_revenue", F.lag("total_revenue").over(seq))
          .withColumn("ytd_revenue", F.sum("total_revenue").over(ytd)))
    m = (m.withColumn("yoy_growth_pct", growth_pct("total_revenue", "prev_year_revenue"))
          .withColumn("mom_growth_pct", growth_pct("total_revenue", "prev_month_revenue")))
    return bigint_cols(m.select("year", "month", "month_name", "order_count", "unique_customers",
                                "total_revenue", "total_profit", "avg_order_value", "prev_year_revenue",
                                "yoy_growth_pct", "prev_month_revenue", "mom_growth_pct", "ytd_revenue")
                        .orderBy("year", "month"))


def annual(star: Star) -> DataFrame:
    a = counted(star, ["year"], "total_orders", "total_customers", [
        F.sum("revenue").alias("_rev"),
        F.round(F.sum("revenue"), 2).alias("total_revenue"),
        F.round(F.sum("profit"), 2).alias("total_profit"),
        order_value_avg().alias("avg_order_value")], calendar=["year"])
    return a.withColumn("revenue_per_customer", ratio("_rev", "total_customers", 2)).drop("_rev")


def annual_summary(star: Star) -> DataFrame:
    """Yearly totals, YoY against the previous year present, next year's revenue (LEAD)."""
    a = annual(star)
    w = Window.orderBy("year")
    a = (a.withColumn("prev_year_revenue", F.lag("total_revenue").over(w))
          .withColumn("next_year_revenue", F.lead("total_revenue").over(w)))
    a = a.withColumn("yoy_growth_pct", growth_pct("total_revenue", "prev_year_revenue"))
    return bigint_cols(a.select("year", "total_orders", "total_customers", "total_revenue", "total_profit",
                                "avg_order_value", "revenue_per_customer", "prev_year_revenue",
                                "yoy_growth_pct", "next_year_revenue").orderBy("year"))


def quarterly(star: Star) -> DataFrame:
    """S3: quarters with their share of the year's revenue."""
    f = with_date(orders(star), star.dim_date, "year", "quarter")
    q = f.groupBy("year", "quarter").agg(
        n_orders().alias("order_count"), n_customers().alias("unique_customers"),
        F.sum("revenue").alias("_rev"), money_sum("profit").alias("total_profit"),
        order_value_avg().alias("avg_order_value"))
    q = q.withColumn("pct_of_annual_revenue", pct("_rev", F.sum("_rev").over(Window.partitionBy("year"))))
    q = q.withColumn("total_revenue", F.round("_rev", 2))
    return bigint_cols(q.select("year", "quarter", "order_count", "unique_customers", "total_revenue",
                                "total_profit", "avg_order_value", "pct_of_annual_revenue")
                        .orderBy("year", "quarter"))


def by_weekday(star: Star) -> DataFrame:
    """Revenue by day of week, ranked."""
    f = with_date(orders(star), star.dim_date, "day_of_week")
    d = f.groupBy("day_of_week").agg(
        n_orders().alias("order_count"), F.sum("revenue").alias("_rev"),
        order_value_avg().alias("avg_order_value"))
    d = d.withColumn("revenue_rank", F.rank().over(Window.orderBy(F.col("_rev").desc())))
    d = d.withColumn("total_revenue", F.round("_rev", 2))
    return bigint_cols(d.select("day_of_week", "order_count", "total_revenue", "avg_order_value",
                                "revenue_rank").orderBy("revenue_rank"))


def weekend_split(star: Star) -> DataFrame:
    """Weekday against weekend."""
    f = with_date(orders(star), star.dim_date, "is_weekend")
    d = f.groupBy("is_weekend").agg(
        n_orders().alias("order_count"), n_customers().alias("unique_customers"),
        F.sum("revenue").alias("_rev"), order_value_avg().alias("avg_order_value"))
    d = d.withColumn("revenue_pct", pct("_rev", F.sum("_rev").over(Window.partitionBy())))
    d = d.withColumn("day_type", F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday"))
    d = d.withColumn("total_revenue", F.round("_rev", 2))
    return bigint_cols(d.select("day_type", "order_count", "unique_customers", "total_revenue",
                                "avg_order_value", "revenue_pct").orderBy(F.col("total_revenue").desc()))


def top_days(star: Star, k: int = 10) -> DataFrame:
    """The k best days (ties broken by date)."""
    f = with_date(orders(star), star.dim_date, "full_date", "day_of_week", "month_name", "year")
    d = f.groupBy("full_date", "day_of_week", "month_name", "year").agg(
        n_orders().alias("order_count"), n_customers().alias("unique_customers"),
        F.round(F.sum("revenue"), 2).alias("total_revenue"))
    return bigint_cols(top_k(d, [("total_revenue", False), ("full_date", True)], k))


def rolling_3m(star: Star) -> DataFrame:
    """Three-row moving average of monthly revenue (the previous rows present)."""
    f = with_date(orders(star), star.dim_date, "year", "month")
    m = f.groupBy("year", "month").agg(F.round(F.sum("revenue"), 2).alias("total_revenue"))
    w = Window.orderBy("year", "month").rowsBetween(-2, 0)
    m = m.withColumn("rolling_3m_avg_revenue",
                     round_to(F.sum("total_revenue").over(w).cast("double") / F.count("total_revenue").over(w), 2))
    return bigint_cols(m.select("year", "month", "total_revenue", "rolling_3m_avg_revenue").orderBy("year", "month"))


MARTS = {
    "monthly_growth": monthly_growth,
    "annual_summary": annual_summary,
    "quarterly": quarterly,
    "by_weekday": by_weekday,
    "weekend_split": weekend_split,
    "top_days": top_days,
    "rolling_3m": rolling_3m,
}

_FD = "FROM fact_sales f JOIN dim_date d ON f.date_key = d.date_key"

ORACLE = {
    "monthly_growth": O.with_prelude(f"""
SELECT CAST(ym // 100 AS BIGINT) AS year, CAST(ym % 100 AS BIGINT) AS month, {O.month_name_of('ym')} AS month_name,
       orders AS order_count, buyers AS unique_customers, CAST(rev AS DOUBLE) AS total_revenue, gain AS total_profit,
       basket AS avg_order_value, CAST(earlier AS DOUBLE) AS prev_year_revenue, {O.growth('rev', 'earlier')} AS yoy_growth_pct,
       CAST(last AS DOUBLE) AS prev_month_revenue, {O.growth('rev', 'last')} AS mom_growth_pct, CAST(ytd AS DOUBLE) AS ytd_revenue
FROM (SELECT a.*, (SELECT arg_max(b.rev, b.ym) FROM months b WHERE b.ym < a.ym AND b.ym % 100 = a.ym % 100) AS earlier,
             (SELECT arg_max(b.rev, b.ym) FROM months b WHERE b.ym < a.ym) AS last,
             (SELECT sum(b.rev) FROM months b WHERE b.ym <= a.ym AND b.ym // 100 = a.ym // 100) AS ytd FROM months a)
ORDER BY ym""", f"""
months AS (
  SELECT date_key // 100 AS ym, count(DISTINCT invoice_id) AS orders, count(DISTINCT customer_key) AS buyers,
         sum(revenue) AS rev, {O.money('sum(profit)')} AS gain, {O.avg('order_value', 2)} AS basket FROM fact_sales GROUP BY 1)"""),

    "annual_summary": O.with_prelude(f"""
SELECT CAST(a.y AS BIGINT) AS year, a.orders AS total_orders, a.buyers AS total_customers, CAST(a.rev AS DOUBLE) AS total_revenue,
       CAST(a.gain AS DOUBLE) AS total_profit, a.basket AS avg_order_value, a.each AS revenue_per_customer,
       CAST(b.rev AS DOUBLE) AS prev_year_revenue, {O.growth('a.rev', 'b.rev')} AS yoy_growth_pct,
       CAST(z.rev AS DOUBLE) AS next_year_revenue
FROM years a LEFT JOIN years b ON b.y = (SELECT max(y) FROM years c WHERE c.y < a.y)
LEFT JOIN years z ON z.y = (SELECT min(y) FROM years c WHERE c.y > a.y) ORDER BY a.y""", f"""
years AS (
  SELECT date_key // 10000 AS y, count(DISTINCT invoice_id) AS orders, count(DISTINCT customer_key) AS buyers,
         sum(revenue) AS rev, sum(profit) AS gain, {O.avg('order_value', 2)} AS basket,
         {O.ratio('sum(revenue)', 'count(DISTINCT customer_key)', 2)} AS each FROM fact_sales GROUP BY 1)"""),

    "quarterly": O.with_prelude(f"""
SELECT CAST(d.year AS BIGINT) AS year, CAST(d.quarter AS BIGINT) AS quarter,
       count(DISTINCT f.invoice_id) AS order_count, count(DISTINCT f.customer_key) AS unique_customers,
       {O.money('sum(f.revenue)')} AS total_revenue, {O.money('sum(f.profit)')} AS total_profit,
       {O.avg('f.order_value', 2)} AS avg_order_value,
       {O.pct('sum(f.revenue)', 'SUM(sum(f.revenue)) OVER (PARTITION BY d.year)')} AS pct_of_annual_revenue
{_FD} GROUP BY d.year, d.quarter ORDER BY d.year, d.quarter"""),

    "by_weekday": O.with_prelude(f"""
SELECT d.day_of_week, count(DISTINCT f.invoice_id) AS order_count, {O.money('sum(f.revenue)')} AS total_revenue,
       {O.avg('f.order_value', 2)} AS avg_order_value,
       CAST(RANK() OVER (ORDER BY sum(f.revenue) DESC) AS BIGINT) AS revenue_rank
{_FD} GROUP BY d.day_of_week ORDER BY revenue_rank"""),

    "weekend_split": O.with_prelude(f"""
SELECT CASE WHEN d.is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       count(DISTINCT f.invoice_id) AS order_count, count(DISTINCT f.customer_key) AS unique_customers,
       {O.money('sum(f.revenue)')} AS total_revenue, {O.avg('f.order_value', 2)} AS avg_order_value,
       {O.pct('sum(f.revenue)', 'SUM(sum(f.revenue)) OVER ()')} AS revenue_pct
{_FD} GROUP BY d.is_weekend ORDER BY total_revenue DESC"""),

    "top_days": O.with_prelude(f"""
SELECT d.full_date, d.day_of_week, d.month_name, CAST(d.year AS BIGINT) AS year,
       count(DISTINCT f.invoice_id) AS order_count, count(DISTINCT f.customer_key) AS unique_customers,
       {O.money('sum(f.revenue)')} AS total_revenue
{_FD} GROUP BY d.full_date, d.day_of_week, d.month_name, d.year
ORDER BY round(sum(f.revenue), 2) DESC, d.full_date LIMIT 10"""),

    "rolling_3m": O.with_prelude(f"""
SELECT CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, CAST(total_revenue AS DOUBLE) AS total_revenue,
       {O.r('CAST(SUM(total_revenue) OVER w AS DOUBLE) / COUNT(total_revenue) OVER w', 2)} AS rolling_3m_avg_revenue
FROM monthly WINDOW w AS (ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
ORDER BY year, month""", f"""
monthly AS (SELECT d.year, d.month, round(sum(f.revenue), 2) AS total_revenue {_FD} GROUP BY d.year, d.month)"""),
}
