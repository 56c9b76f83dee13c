"""Shared pieces of the marts: dimension joins and the measures the reference repeats.

Join policy: ``dim_date`` (one row per calendar day of the span) is bounded by the calendar, so it is
broadcast and the fact is never shuffled to meet it. ``dim_location`` has one row per distinct
country text, usually few: Spark broadcasts it by its measured size, and joins otherwise.
``dim_customer`` and ``dim_product`` grow with the data: marts
first aggregate the fact to customer or product grain and join there, and AQE converts that
join to a broadcast only when the measured side is under its threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions.numeric import round_money, round_to
from tillsight.operators.distinct import merged_counts


def orders(star) -> DataFrame:
    """The order-grain aggregate (see ``operators.star.order_grain``), read from the warehouse
    when it was written there, else computed from the fact."""
    if getattr(star, "fact_orders", None) is not None:
        return star.fact_orders
    from tillsight.operators.star import order_grain
    return order_grain(star.fact_sales)


def counted(star, by: list[str], n_of_orders: str, n_of_customers: str, aggs: list[Column],
            calendar: list[str] | None = None, place: list[str] | None = None) -> DataFrame:
    """Orders grouped by ``by`` (columns of the calendar or of the location) with ``aggs`` and the distinct numbers of
    orders and customers.

    Where the star has bitmaps, the numbers come from them and meet the sums by ``by``, one row a group; otherwise the
    orders are counted. The calendar's ``year`` and ``month`` name a month's bitmaps, other columns follow from them."""
    f = orders(star)
    if calendar:
        f = with_date(f, star.dim_date, *calendar)
    if place:
        f = with_location(f, star.dim_location, *place)
    if getattr(star, "order_bits", None) is None:
        return f.groupBy(*by).agg(n_orders().alias(n_of_orders), n_customers().alias(n_of_customers), *aggs)
    on = [c for c in by if not calendar or c not in calendar or c in ("year", "month")]
    bits = star.order_bits.withColumns({"year": F.floor(F.col("month_no") / 100).cast("int"),
                                        "month": (F.col("month_no") % 100).cast("int")})
    if place:
        bits = with_location(bits, star.dim_location, *place)
    counts = merged_counts(bits, on, **{n_of_orders: "order", n_of_customers: "customer"})
    counts = counts.select(*[F.col(c).alias(f"_on_{c}") for c in on], n_of_orders, n_of_customers)
    sums = f.groupBy(*by).agg(*aggs)
    met = sums.join(counts, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on], "left").drop(*[f"_on_{c}" for c in on])
    return met.fillna(0, [n_of_orders, n_of_customers])


def with_date(fact: DataFrame, dim_date: DataFrame, *cols: str) -> DataFrame:
    return fact.join(F.broadcast(dim_date.select("date_key", *cols)), "date_key")


def with_location(fact: DataFrame, dim_location: DataFrame, *cols: str) -> DataFrame:
    return fact.join(dim_location.select("location_key", *cols), "location_key")


def with_product(df: DataFrame, dim_product: DataFrame, *cols: str) -> DataFrame:
    return df.join(dim_product.select("product_key", *cols), "product_key")


def with_customer(df: DataFrame, dim_customer: DataFrame, *cols: str) -> DataFrame:
    return df.join(dim_customer.select("customer_key", *cols), "customer_key")


# ---- measures (alias applied by callers) ------------------------------------------------------

def n_orders() -> Column:
    return F.count_distinct("invoice_id")


def n_customers() -> Column:
    return F.count_distinct("customer_key")


def money_sum(c: str = "revenue") -> Column:
    """ROUND(SUM(c), 2) on exact decimals, as double."""
    return round_money(F.sum(c))


def avg_of(c: str, n: int | None = 2) -> Column:
    """ROUND(AVG(c), n) as sum / count in double (nulls ignored)."""
    v = F.sum(c).cast("double") / F.count(c)
    return round_to(v, n) if n is not None else v


def order_value_avg(n: int | None = 2) -> Column:
    """ROUND(AVG(order_value), n) over lines, from the order grain (Σ order value / Σ count)."""
    v = F.sum("order_value").cast("double") / F.sum("ov_n")
    return round_to(v, n) if n is not None else v


def line_avg(sum_col: str = "revenue", n: int | None = 2) -> Column:
    """Mean per line from the order grain (Σ sum_col / Σ lines)."""
    v = F.sum(sum_col).cast("double") / F.sum("lines")
    return round_to(v, n) if n is not None else v


def units(c: str = "quantity") -> Column:
    return F.sum(c).cast("long")


def bigint_cols(df: DataFrame) -> DataFrame:
    """Integers leave as BIGINT, exact decimals as DOUBLE (one output type per column for both
    engines)."""
    out = []
    for name, t in df.dtypes:
        if t in ("int", "smallint", "tinyint"):
            out.append(F.col(name).cast("long").alias(name))
        elif t.startswith("decimal"):
            out.append(F.col(name).cast("double").alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)
