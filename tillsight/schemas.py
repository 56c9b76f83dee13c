"""Explicit schemas: raw invoice lines and the five star tables. Nothing is inferred."""

from pyspark.sql import types as T

RAW_TRANSACTIONS = T.StructType([
    T.StructField("invoice", T.StringType(), True),
    T.StructField("stock_code", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("quantity", T.IntegerType(), True),
    T.StructField("invoice_ts", T.TimestampNTZType(), True),
    T.StructField("price", T.DecimalType(18, 3), True),
    T.StructField("customer_id", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("line_no", T.LongType(), True),
])
"""Raw line. ``line_no`` is the source ordinal (the position of the line in its part); with the part's
number it decides which duplicate is "first". ``source`` and ``part_no`` are added by the reader."""

# How the source spells its columns (compared in lower case).
SOURCE_HEADERS = {"invoice": "invoice", "stockcode": "stock_code", "description": "description", "quantity": "quantity",
                  "invoicedate": "invoice_ts", "price": "price", "customer id": "customer_id", "country": "country"}

RAW_COLUMNS = [f.name for f in RAW_TRANSACTIONS.fields]

DIM_CUSTOMER = T.StructType([
    T.StructField("customer_key", T.LongType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("country", T.StringType(), True),
    T.StructField("segment", T.StringType(), True),
    T.StructField("recency_days", T.IntegerType(), True),
    T.StructField("frequency", T.LongType(), True),
    T.StructField("monetary", T.DecimalType(28, 2), True),
    T.StructField("clv", T.DecimalType(28, 2), True),
    T.StructField("r_score", T.IntegerType(), True),
    T.StructField("f_score", T.IntegerType(), True),
    T.StructField("m_score", T.IntegerType(), True),
    T.StructField("rfm_score", T.IntegerType(), True),
    T.StructField("customer_type", T.StringType(), True),
])

DIM_PRODUCT_COLUMNS = ["product_key", "product_id", "product_name", "category"]
DIM_DATE_COLUMNS = ["date_key", "full_date", "day", "day_of_week", "week", "month", "month_name",
                    "quarter", "year", "is_weekend"]
DIM_LOCATION_COLUMNS = ["location_key", "country", "region"]
FACT_SALES_COLUMNS = ["invoice_id", "customer_key", "product_key", "date_key", "location_key",
                      "quantity", "unit_price", "revenue", "discount", "profit", "order_value"]
DIM_CUSTOMER_COLUMNS = [f.name for f in DIM_CUSTOMER.fields]

STAR_TABLES = ["dim_customer", "dim_product", "dim_date", "dim_location", "fact_sales"]
