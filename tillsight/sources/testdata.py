"""Map the driver's TPC-H-shaped tables to raw invoice lines (FIXTURES.md §2).

Every line item becomes one raw line; returned items become cancellations (invoice prefixed
with ``C``). The joins are written orders-side first, so the only join at line grain that must
shuffle the line items is the one on the order key; part and nation/region are dimension-sized.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.functions.text import strip, title_case
from tillsight.schemas import RAW_COLUMNS

# Parameters that belong to these tables.
SNAPSHOT = "2001-08-02"      # one day after the last order date
AS_OF = "2001-08-02"
SOURCE_NAME = "tpch"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw invoice lines with the schema of ``schemas.RAW_TRANSACTIONS`` plus ``source`` and ``part_no``."""
    li = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")   # 25 rows: broadcast
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_name")

    cust_country = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left")
    orders_c = orders.join(cust_country, orders.o_custkey == cust_country.c_custkey, "left")
    lines = (li.join(orders_c, li.l_orderkey == orders_c.o_orderkey, "inner")
               .join(part, li.l_partkey == part.p_partkey, "left"))

    unit = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    return lines.select(
        F.concat(F.when(F.col("l_returnflag") == "R", F.lit("C")).otherwise(F.lit("")),
                 F.col("l_orderkey").cast("string")).alias("invoice"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        F.upper(F.col("p_name")).alias("description"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("invoice_ts"),
        F.round(unit.cast("decimal(38,8)"), 2).cast("decimal(18,2)").cast("decimal(18,3)").alias("price"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("n_name").alias("country"),
        F.col("l_linenumber").cast("long").alias("line_no"),
    ).select(*RAW_COLUMNS).withColumns({"source": F.lit(SOURCE_NAME), "part_no": F.lit(0)})


def region_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(country, region) lookup from nation ⋈ region, in the cleaned country spelling."""
    nation = _t(spark, sf_dir, "nation")
    region = _t(spark, sf_dir, "region")
    return (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "left")
                  .select(title_case(strip("n_name")).alias("country"),
                          title_case(strip("r_name")).alias("region")))
