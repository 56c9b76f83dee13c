"""The ETL steps and warehouse checks as queries.

These take ``(spark, sf_dir)``: the early steps run from the raw lines, the later ones read the
star the ETL wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillsight import warehouse
from tillsight.operators.clean import clean_accounting, dedup_dealt, valid_lines
from tillsight.operators.enrich import attach_rfm, enrich_money, with_date_parts
from tillsight.operators.joins import heavy_keys, row_tasks, tasks_for
from tillsight.operators.quality import key_integrity, profile, sanity_top5, table_counts
from tillsight.oracle import sql as O
from tillsight.plans.common import bigint_cols
from tillsight.session import scratch_path
from tillsight.sources.raw import read_transactions, write_table
from tillsight.schemas import FACT_SALES_COLUMNS, RAW_COLUMNS

PART_YEAR = 1998
_DEDUP = ("line_no", "quantity", "price")
_LINE_COLS = ["invoice", "stock_code", "description", "quantity", "invoice_ts", "price", "customer_id",
              "country", "line_no"]


def _cleaned(spark, sf_dir) -> DataFrame:
    """The cleaned lines the ETL wrote (T1 runs once per session, inside the star build)."""
    return warehouse.star(spark, sf_dir).extras["cleaned"]


def etl_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned raw lines."""
    return bigint_cols(_cleaned(spark, sf_dir).select(*_LINE_COLS))


def etl_enrich_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue, discount, profit, order value per cleaned line."""
    df = enrich_money(_cleaned(spark, sf_dir))
    return bigint_cols(df.select("invoice", "stock_code", "customer_id", "quantity", "price", "revenue",
                                 "discount", "profit", "order_value"))


def etl_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date columns of each cleaned line."""
    df = with_date_parts(_cleaned(spark, sf_dir))
    return bigint_cols(df.select("invoice", "stock_code", "customer_id", "date_key", "full_date", "day",
                                 "day_of_week", "week", "month", "month_name", "quarter", "year", "is_weekend"))


def _scored(spark, sf_dir):
    return warehouse.star(spark, sf_dir).extras["scored"]


def etl_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: recency, frequency, monetary per customer."""
    return bigint_cols(_scored(spark, sf_dir).select("customer_id", "recency_days", "frequency", "monetary"))


def etl_rfm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quintile scores, RFM total, segment, CLV."""
    return bigint_cols(_scored(spark, sf_dir).select("customer_id", "r_score", "f_score", "m_score", "rfm_score",
                                                     "segment", "clv"))


def etl_surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Natural key → surrogate key for customers, products and countries."""
    st = warehouse.star(spark, sf_dir)
    c = st.dim_customer.select(F.lit("customer").alias("entity"), F.col("customer_id").alias("natural_key"),
                               F.col("customer_key").alias("surrogate_key"))
    p = st.dim_product.select(F.lit("product").alias("entity"), F.col("product_id").alias("natural_key"),
                              F.col("product_key").alias("surrogate_key"))
    loc = st.dim_location.select(F.lit("location").alias("entity"), F.col("country").alias("natural_key"),
                                 F.col("location_key").alias("surrogate_key"))
    return bigint_cols(c.unionByName(p).unionByName(loc))


def _table(name):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(warehouse.star(spark, sf_dir), name)
        return bigint_cols(df.select(*FACT_SALES_COLUMNS) if name == "fact_sales" else df.drop("created_at"))
    run.__name__ = name
    return run


def etl_join_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each cleaned line with its customer's RFM attributes (left join)."""
    st = warehouse.star(spark, sf_dir)
    lines = st.extras["lines"].select("invoice", "stock_code", "customer_id", "revenue")
    return bigint_cols(attach_rfm(lines, st.extras["scored"]))


def q_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_counts(warehouse.star(spark, sf_dir).tables())


def q_sanity_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bigint_cols(sanity_top5(warehouse.star(spark, sf_dir)))


def q_key_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_integrity(warehouse.star(spark, sf_dir))


def q_source_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(warehouse.raw(spark, sf_dir).select(*RAW_COLUMNS))


def q_clean_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_accounting(warehouse.raw(spark, sf_dir), _DEDUP)


def etl_multi_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines written as two parts (the later years first), read back by
    column name and concatenated in the order given."""
    raw = warehouse.raw(spark, sf_dir).select(*RAW_COLUMNS)
    late = F.year("invoice_ts") >= PART_YEAR
    paths = {}
    for name, rows in (("late", late), ("early", ~late)):
        paths[name] = scratch_path(spark, f"part-{name}")
        write_table(raw.where(rows), paths[name])
    return bigint_cols(read_transactions(spark, paths).select("source", "part_no", *_LINE_COLS))


_FILES = 5
_FILE_ORDER = ["invoice_ts", "invoice", "stock_code", "customer_id", "price", "quantity", "description", "country"]


def etl_line_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines written as one part of several files without line numbers, newest first, and read
    back: dense line numbers in file order, and the copy that comes first survives the cleaning."""
    path = scratch_path(spark, "part-files")
    order = [F.col(c).desc() if c == "invoice_ts" else F.col(c).asc_nulls_last() for c in _FILE_ORDER]
    lines = warehouse.raw(spark, sf_dir).select(*_FILE_ORDER)
    # The order is total up to equal lines, so the numbers don't depend on how many files there are.
    write_table(lines.repartitionByRange(max(_FILES, row_tasks(lines)), *order).sortWithinPartitions(*order), path)
    valid = valid_lines(read_transactions(spark, {"files": path}))
    kept = dedup_dealt(valid, None, heavy_keys(valid, {"invoice": ["invoice"]}).get("invoice"), tasks_for(lines))
    return bigint_cols(kept.select("part_no", *_LINE_COLS))


def fact_primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by day with their ids' state: how many, how many distinct, and whether the day's ids all lie
    behind those of the days before (ids grow along the clustering)."""
    f = warehouse.star(spark, sf_dir).fact_sales
    days = f.groupBy("date_key").agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("sale_id").alias("ids"),
                                     F.min("sale_id").alias("low"), F.max("sale_id").alias("high"),
                                     F.count_distinct("created_at").alias("load_times"))
    # One row a day of the calendar
    before = Window.orderBy("date_key").rowsBetween(Window.unboundedPreceding, -1)
    behind = F.coalesce(F.max("high").over(before) < F.col("low"), F.col("low") > 0)
    return bigint_cols(days.select("date_key", "lines", "ids", "load_times", behind.alias("in_order")))


QUERIES = {
    "fact_primary_key": fact_primary_key,
    "etl_multi_part": etl_multi_part,
    "etl_line_order": etl_line_order,
    "etl_clean": etl_clean,
    "etl_enrich_money": etl_enrich_money,
    "etl_date_parts": etl_date_parts,
    "etl_rfm": etl_rfm,
    "etl_rfm_scores": etl_rfm_scores,
    "etl_surrogate_keys": etl_surrogate_keys,
    "dim_customer": _table("dim_customer"),
    "dim_product": _table("dim_product"),
    "dim_date": _table("dim_date"),
    "dim_location": _table("dim_location"),
    "fact_sales": _table("fact_sales"),
    "etl_join_back": etl_join_back,
    "table_counts": q_table_counts,
    "sanity_top5": q_sanity_top5,
    "key_integrity": q_key_integrity,
    "source_profile": q_source_profile,
    "clean_accounting": q_clean_accounting,
}

_IB = lambda c: f"CAST({c} AS BIGINT) AS {c}"
_D = lambda c: f"CAST({c} AS DOUBLE) AS {c}"

_CODES = ", ".join(f"'{c}'" for c in ["POST", "D", "M", "BANK CHARGES", "PADS", "DOT", "CRUK"])

ORACLE = {
    "fact_primary_key": O.with_prelude("""
SELECT CAST(date_key AS BIGINT) AS date_key, count(*) AS lines, count(*) AS ids, CAST(1 AS BIGINT) AS load_times, true AS in_order
FROM fact_sales GROUP BY 1"""),
    "etl_multi_part": O.with_prelude(f"""
SELECT CASE WHEN year(invoice_ts) >= {PART_YEAR} THEN 'late' ELSE 'early' END AS source,
       CAST(CASE WHEN year(invoice_ts) >= {PART_YEAR} THEN 0 ELSE 1 END AS BIGINT) AS part_no,
       invoice, stock_code, description, {_IB('quantity')}, invoice_ts, {_D('price')}, customer_id, country, line_no
FROM raw"""),
    "etl_line_order": O.with_prelude(f"""
SELECT CAST(0 AS BIGINT) AS part_no, invoice, stock_code, description, {_IB('quantity')}, invoice_ts, {_D('price')}, customer_id, country,
       line_no FROM renumbered_kept WHERE first_ = 1""", f"""
numbered AS (SELECT * EXCLUDE (line_no), row_number() OVER (ORDER BY invoice_ts DESC, invoice, stock_code, customer_id, price, quantity,
  description NULLS LAST, country NULLS LAST) - 1 AS line_no FROM raw),
renumbered AS (SELECT invoice, {O.strip('stock_code')} AS stock_code, {O.strip('description')} AS description, quantity, invoice_ts, price,
  customer_id, {O.title(O.strip('country'))} AS country, line_no FROM numbered
  WHERE customer_id IS NOT NULL AND description IS NOT NULL AND NOT coalesce(starts_with(invoice, 'C'), false) AND quantity > 0 AND price > 0
    AND NOT coalesce(stock_code IN ({_CODES}), false) AND NOT coalesce(starts_with(stock_code, 'GIFT'), false)),
renumbered_kept AS (SELECT *, row_number() OVER (PARTITION BY invoice, stock_code, customer_id ORDER BY line_no) AS first_ FROM renumbered)"""),
    "etl_clean": O.with_prelude(f"""
SELECT invoice, stock_code, description, {_IB('quantity')}, invoice_ts, {_D('price')}, customer_id, country, line_no
FROM cleaned"""),
    "etl_enrich_money": O.with_prelude(f"""
SELECT invoice, stock_code, customer_id, {_IB('quantity')}, {_D('price')}, {_D('revenue')}, discount,
       {_D('profit')}, {_D('order_value')} FROM lines"""),
    "etl_date_parts": O.with_prelude(f"""
SELECT invoice, stock_code, customer_id, {_IB('date_key')}, full_date, CAST(day(full_date) AS BIGINT) AS day,
       dayname(full_date) AS day_of_week, CAST(weekofyear(full_date) AS BIGINT) AS week,
       CAST(month(full_date) AS BIGINT) AS month, monthname(full_date) AS month_name,
       CAST(quarter(full_date) AS BIGINT) AS quarter, CAST(year(full_date) AS BIGINT) AS year,
       isodow(full_date) >= 6 AS is_weekend FROM lines"""),
    "etl_rfm": O.with_prelude(f"""
SELECT customer_id, {_IB('recency_days')}, frequency, {_D('monetary')} FROM rfm2"""),
    "etl_rfm_scores": O.with_prelude(f"""
SELECT customer_id, {_IB('r_score')}, {_IB('f_score')}, {_IB('m_score')}, {_IB('rfm_score')}, segment,
       CAST(round(monetary, 2) AS DOUBLE) AS clv FROM segmented"""),
    "etl_surrogate_keys": O.with_prelude("""
SELECT 'customer' AS entity, customer_id AS natural_key, customer_key AS surrogate_key FROM dim_customer
UNION ALL SELECT 'product', product_id, product_key FROM dim_product
UNION ALL SELECT 'location', country, location_key FROM dim_location"""),
    "dim_customer": O.with_prelude(f"""
SELECT customer_key, customer_id, country, segment, {_IB('recency_days')}, frequency, {_D('monetary')}, {_D('clv')},
       {_IB('r_score')}, {_IB('f_score')}, {_IB('m_score')}, {_IB('rfm_score')}, customer_type FROM dim_customer"""),
    "dim_product": O.with_prelude("SELECT * FROM dim_product"),
    "dim_date": O.with_prelude(f"""
SELECT {_IB('date_key')}, full_date, {_IB('day')}, day_of_week, {_IB('week')}, {_IB('month')}, month_name,
       {_IB('quarter')}, {_IB('year')}, is_weekend FROM dim_date"""),
    "dim_location": O.with_prelude("SELECT * FROM dim_location"),
    "fact_sales": O.with_prelude(f"""
SELECT invoice_id, customer_key, product_key, {_IB('date_key')}, location_key, {_IB('quantity')}, {_D('unit_price')},
       {_D('revenue')}, discount, {_D('profit')}, {_D('order_value')} FROM fact_sales"""),
    "etl_join_back": O.with_prelude("""
SELECT l.invoice, l.stock_code, l.customer_id, CAST(l.revenue AS DOUBLE) AS revenue,
       CAST(s.recency_days AS BIGINT) AS recency_days, s.frequency, CAST(s.monetary AS DOUBLE) AS monetary,
       CAST(s.r_score AS BIGINT) AS r_score, CAST(s.f_score AS BIGINT) AS f_score,
       CAST(s.m_score AS BIGINT) AS m_score, CAST(s.rfm_score AS BIGINT) AS rfm_score, s.segment,
       CAST(round(s.monetary, 2) AS DOUBLE) AS clv
FROM lines l LEFT JOIN segmented s ON l.customer_id = s.customer_id"""),
    "table_counts": O.with_prelude("""
SELECT 'DIM_CUSTOMER' AS table_name, count(*) AS row_count FROM dim_customer UNION ALL
SELECT 'DIM_PRODUCT', count(*) FROM dim_product UNION ALL
SELECT 'DIM_DATE', count(*) FROM dim_date UNION ALL
SELECT 'DIM_LOCATION', count(*) FROM dim_location UNION ALL
SELECT 'FACT_SALES', count(*) FROM fact_sales ORDER BY table_name"""),
    "sanity_top5": O.with_prelude("""
SELECT c.customer_id, c.segment, c.country, CAST(sum(f.revenue) AS DOUBLE) AS total_revenue
FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key
GROUP BY 1, 2, 3 ORDER BY sum(f.revenue) DESC, c.customer_id LIMIT 5"""),
    "key_integrity": O.with_prelude("""
SELECT 'dim_customer.customer_key duplicate' AS check_name, count(*) - count(DISTINCT customer_key) AS violations FROM dim_customer
UNION ALL SELECT 'dim_customer.customer_key null', count(*) - count(customer_key) FROM dim_customer
UNION ALL SELECT 'dim_customer.customer_id null', count(*) - count(customer_id) FROM dim_customer
UNION ALL SELECT 'dim_product.product_key duplicate', count(*) - count(DISTINCT product_key) FROM dim_product
UNION ALL SELECT 'dim_product.product_key null', count(*) - count(product_key) FROM dim_product
UNION ALL SELECT 'dim_product.product_id null', count(*) - count(product_id) FROM dim_product
UNION ALL SELECT 'dim_date.date_key duplicate', count(*) - count(DISTINCT date_key) FROM dim_date
UNION ALL SELECT 'dim_date.date_key null', count(*) - count(date_key) FROM dim_date
UNION ALL SELECT 'dim_date.full_date null', count(*) - count(full_date) FROM dim_date
UNION ALL SELECT 'dim_location.location_key duplicate', count(*) - count(DISTINCT location_key) FROM dim_location
UNION ALL SELECT 'dim_location.location_key null', count(*) - count(location_key) FROM dim_location
UNION ALL SELECT 'dim_location.country null', count(*) - count(country) FROM dim_location
UNION ALL SELECT 'fact_sales.invoice_id null', count(*) - count(invoice_id) FROM fact_sales
UNION ALL SELECT 'fact_sales.sale_id duplicate', count(*) - count(DISTINCT sale_id) FROM (SELECT row_number() OVER () AS sale_id FROM fact_sales)
UNION ALL SELECT 'fact_sales.sale_id null', count(*) - count(sale_id) FROM (SELECT row_number() OVER () AS sale_id FROM fact_sales)
UNION ALL SELECT 'fact_sales.customer_key orphan', count(*) FROM fact_sales f
  WHERE f.customer_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_customer d WHERE d.customer_key = f.customer_key)
UNION ALL SELECT 'fact_sales.product_key orphan', count(*) FROM fact_sales f
  WHERE f.product_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_product d WHERE d.product_key = f.product_key)
UNION ALL SELECT 'fact_sales.date_key orphan', count(*) FROM fact_sales f
  WHERE f.date_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_key = f.date_key)
UNION ALL SELECT 'fact_sales.location_key orphan', count(*) FROM fact_sales f
  WHERE f.location_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_location d WHERE d.location_key = f.location_key)"""),
    "source_profile": O.with_prelude("""
SELECT 'row_count' AS metric, '*' AS column_name, CAST(count(*) AS VARCHAR) AS value FROM raw
UNION ALL SELECT 'column_count', '*', '9'
UNION ALL SELECT 'min', 'invoice_ts', CAST(min(invoice_ts) AS VARCHAR) FROM raw
UNION ALL SELECT 'max', 'invoice_ts', CAST(max(invoice_ts) AS VARCHAR) FROM raw
UNION ALL SELECT 'distinct', 'customer_id', CAST(count(DISTINCT customer_id) AS VARCHAR) FROM raw
UNION ALL SELECT 'distinct', 'stock_code', CAST(count(DISTINCT stock_code) AS VARCHAR) FROM raw
UNION ALL SELECT 'nulls', 'invoice', CAST(count(*) - count(invoice) AS VARCHAR) FROM raw
UNION ALL SELECT 'nulls', 'stock_code', CAST(count(*) - count(stock_code) AS VARCHAR) FROM raw
UNION ALL SELECT 'nulls', 'description', CAST(count(*) - count(description) AS VARCHAR) FROM raw
UNION ALL SELECT 'nulls', 'quantity', CAST(count(*) - count(quantity) AS VARCHAR) FROM raw
UNION ALL SELECT 'nulls', 'invoice_ts', CAST(count(*) - count(invoice_ts) AS VARCHAR) FROM raw
UNION ALL SELECT 'nulls', 'price', CAST(count(*) - count(price) AS VARCHAR) FROM raw
UNION ALL SELECT 'nulls', 'customer_id', CAST(count(*) - count(customer_id) AS VARCHAR) FROM raw
UNION ALL SELECT 'nulls', 'country', CAST(count(*) - count(country) AS VARCHAR) FROM raw
UNION ALL SELECT 'nulls', 'line_no', CAST(count(*) - count(line_no) AS VARCHAR) FROM raw"""),
    "clean_accounting": O.with_prelude(f"""
SELECT rule, count(*) AS rows FROM (
  SELECT CASE WHEN customer_id IS NULL THEN 'null_customer'
              WHEN description IS NULL THEN 'null_description'
              WHEN coalesce(starts_with(invoice, 'C'), false) THEN 'cancellation'
              WHEN NOT coalesce(quantity > 0, false) THEN 'non_positive_quantity'
              WHEN NOT coalesce(price > 0, false) THEN 'non_positive_price'
              WHEN coalesce(stock_code IN ({_CODES}), false) THEN 'invalid_code'
              WHEN coalesce(starts_with(stock_code, 'GIFT'), false) THEN 'gift_code'
              ELSE 'kept' END AS rule
  FROM raw) GROUP BY rule
UNION ALL SELECT 'after_dedup', count(*) FROM cleaned"""),
}
