"""DuckDB SQL that rebuilds the star from the driver tables, and SQL helpers matching the
numeric policy of ``functions.numeric`` (same casts, same operation order).

``PRELUDE`` is a list of CTEs ending in ``dim_customer, dim_product, dim_date, dim_location,
fact_sales``; each mart's oracle is ``WITH <PRELUDE>, <its CTEs> SELECT ...``.
"""

from __future__ import annotations

from tillsight.functions.classify import TESTDATA_CATEGORY_RULES
from tillsight.functions.text import PY_WHITESPACE
from tillsight.operators.clean import INVALID_CODES
from tillsight.sources.testdata import SNAPSHOT

WS = " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE)


def title(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), '(\\p{{L}}+|\\P{{L}}+)'), "
            f"lambda t: upper(t[1]) || t[2:]), '')")


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def r(expr: str, n: int) -> str:
    """Half-up rounding of a double, via DECIMAL(38,8), returned as DOUBLE."""
    return f"CAST(round(CAST(CAST({expr} AS DOUBLE) AS DECIMAL(38,8)), {n}) AS DOUBLE)"


def avg(x: str, n: int) -> str:
    return r(f"CAST(sum({x}) AS DOUBLE) / count({x})", n)


def ratio(num: str, den: str, n: int, scale: str = "1.0") -> str:
    return r(f"{scale} * CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0)", n)


def pct(num: str, den: str, n: int = 2) -> str:
    return ratio(num, den, n, "100.0")


def growth(cur: str, prev: str, n: int = 2) -> str:
    return r(f"100.0 * (CAST({cur} AS DOUBLE) - CAST({prev} AS DOUBLE)) / nullif(CAST({prev} AS DOUBLE), 0)", n)


def money(expr: str, n: int = 2) -> str:
    return f"CAST(round({expr}, {n}) AS DOUBLE)"


def day_of(key: str) -> str:
    """Calendar day of a YYYYMMDD key."""
    return f"make_date({key} // 10000, {key} // 100 % 100, {key} % 100)"


def month_name_of(ym: str) -> str:
    """Name of a YYYYMM month."""
    return f"monthname(make_date({ym} // 100, {ym} % 100, 1))"


def tile(rn: str, n: str, k: int) -> str:
    """NTILE(k) from a row number and the row count: the first n mod k tiles have one row more."""
    small, more = f"({n} // {k})", f"({n} % {k})"
    return (f"CASE WHEN {rn} <= {more} * ({small} + 1) THEN ({rn} - 1) // ({small} + 1) + 1"
            f" ELSE {more} + ({rn} - 1 - {more} * ({small} + 1)) // {small} + 1 END")


# The segment and churn rules as SQL text.
SEGMENT = """CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'VIP'
              WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal'
              WHEN r_score >= 4 AND f_score <= 2 THEN 'New'
              WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
              WHEN r_score = 1 THEN 'Lost'
              ELSE 'Potential' END"""
CHURN = """CASE WHEN recency_days > 180 THEN 'Churned' WHEN recency_days > 90 THEN 'High Risk'
              WHEN recency_days > 60 THEN 'Medium Risk' WHEN recency_days > 30 THEN 'Low Risk' ELSE 'Active' END"""


def _category_case(x: str) -> str:
    parts = []
    for label, words in TESTDATA_CATEGORY_RULES:
        cond = " OR ".join(f"contains(upper(coalesce({x}, 'None')), '{w}')" for w in words)
        parts.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(parts) + " ELSE 'General' END"


_codes = ", ".join(f"'{c}'" for c in INVALID_CODES)

PRELUDE = f"""
raw AS (
  SELECT concat(CASE WHEN l.l_returnflag = 'R' THEN 'C' ELSE '' END, CAST(l.l_orderkey AS VARCHAR)) AS invoice,
         CAST(l.l_partkey AS VARCHAR) AS stock_code,
         upper(p.p_name) AS description,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(o.o_orderdate AS TIMESTAMP) AS invoice_ts,
         CAST(round(CAST(l.l_extendedprice / nullif(l.l_quantity, 0) AS DECIMAL(38,8)), 2) AS DECIMAL(18,2)) AS price,
         CAST(o.o_custkey AS VARCHAR) AS customer_id,
         n.n_name AS country,
         CAST(l.l_linenumber AS BIGINT) AS line_no
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
),
filtered AS (
  SELECT * FROM raw
  WHERE customer_id IS NOT NULL AND description IS NOT NULL
    AND NOT coalesce(starts_with(invoice, 'C'), false)
    AND quantity > 0 AND price > 0
    AND NOT coalesce(stock_code IN ({_codes}), false)
    AND NOT coalesce(starts_with(stock_code, 'GIFT'), false)
),
trimmed AS (
  SELECT invoice, {strip('stock_code')} AS stock_code, {strip('description')} AS description, quantity,
         invoice_ts, price, customer_id, {title(strip('country'))} AS country, line_no
  FROM filtered
),
cleaned AS (
  SELECT * EXCLUDE (rn_) FROM (
    SELECT *, row_number() OVER (PARTITION BY invoice, stock_code, customer_id
                                 ORDER BY line_no, quantity, price, description, invoice_ts, country) AS rn_
    FROM trimmed) WHERE rn_ = 1
),
money AS (
  SELECT *, CAST(round(quantity * price, 2) AS DECIMAL(18,2)) AS revenue FROM cleaned
),
lines AS (
  SELECT *,
         0.0::DOUBLE AS discount,
         CAST(round(revenue * 0.40, 2) AS DECIMAL(18,2)) AS profit,
         CASE WHEN invoice IS NULL THEN NULL
              ELSE CAST(sum(revenue) OVER (PARTITION BY invoice) AS DECIMAL(18,2)) END AS order_value,
         CAST(year(invoice_ts) * 10000 + month(invoice_ts) * 100 + day(invoice_ts) AS INTEGER) AS date_key,
         CAST(invoice_ts AS DATE) AS full_date
  FROM money
),
rfm AS (
  SELECT customer_id,
         max(invoice_ts) AS last_purchase,
         CAST(count(DISTINCT invoice) AS BIGINT) AS frequency,
         CAST(sum(revenue) AS DECIMAL(28,2)) AS monetary,
         min({{'ts': invoice_ts, 'inv': invoice, 'ln': line_no, 'country': country}}) AS f_
  FROM lines GROUP BY customer_id
),
rfm2 AS (
  SELECT *, CAST(floor(epoch(TIMESTAMP '{SNAPSHOT} 00:00:00' - last_purchase) / 86400) AS INTEGER) AS recency_days
  FROM rfm
),
ncust AS (SELECT count(*) AS n FROM rfm2),
rec_sorted AS (SELECT recency_days, row_number() OVER (ORDER BY recency_days, customer_id) AS rn FROM rfm2),
qpos AS (
  SELECT k, (k * (n - 1)) // 5 + 1 AS lo, least((k * (n - 1)) // 5 + 2, n) AS hi, (k * (n - 1)) % 5 AS rem
  FROM range(1, 5) t(k), ncust
),
qedge AS (
  SELECT q.k, CASE WHEN q.rem = 0 THEN CAST(a.recency_days AS DOUBLE)
                   ELSE CAST(a.recency_days AS DOUBLE)
                        + (CAST(b.recency_days AS DOUBLE) - CAST(a.recency_days AS DOUBLE)) * q.rem / 5 END AS e
  FROM qpos q JOIN rec_sorted a ON a.rn = q.lo JOIN rec_sorted b ON b.rn = q.hi
),
edges AS (
  SELECT max(CASE WHEN k = 1 THEN e END) AS e1, max(CASE WHEN k = 2 THEN e END) AS e2,
         max(CASE WHEN k = 3 THEN e END) AS e3, max(CASE WHEN k = 4 THEN e END) AS e4 FROM qedge
),
scored AS (
  SELECT s.*,
         CASE WHEN recency_days <= e1 THEN 5 WHEN recency_days <= e2 THEN 4 WHEN recency_days <= e3 THEN 3
              WHEN recency_days <= e4 THEN 2 ELSE 1 END AS r_score,
         CASE WHEN n <= 1 THEN 1 ELSE greatest(1, ((rn_f - 1) * 5 + n - 2) // (n - 1)) END AS f_score,
         CASE WHEN n <= 1 THEN 1 ELSE greatest(1, ((rn_m - 1) * 5 + n - 2) // (n - 1)) END AS m_score
  FROM (SELECT *, row_number() OVER (ORDER BY frequency, customer_id) AS rn_f,
                  row_number() OVER (ORDER BY monetary, customer_id) AS rn_m FROM rfm2) s, edges, ncust
),
segmented AS (
  SELECT *, r_score + f_score + m_score AS rfm_score,
         {SEGMENT} AS segment
  FROM scored
),
dim_customer AS (
  SELECT CAST(row_number() OVER (ORDER BY f_.ts, f_.inv, f_.ln, customer_id) AS BIGINT) AS customer_key,
         customer_id, f_.country AS country, segment, recency_days, frequency, monetary,
         CAST(round(monetary, 2) AS DECIMAL(28,2)) AS clv,
         CAST(r_score AS INTEGER) AS r_score, CAST(f_score AS INTEGER) AS f_score,
         CAST(m_score AS INTEGER) AS m_score, CAST(rfm_score AS INTEGER) AS rfm_score,
         CASE WHEN frequency > 1 THEN 'Returning' ELSE 'New' END AS customer_type
  FROM segmented
),
prod_first AS (
  SELECT stock_code, min({{'ts': invoice_ts, 'inv': invoice, 'ln': line_no, 'd': description}}) AS f_
  FROM lines GROUP BY stock_code
),
dim_product AS (
  SELECT CAST(row_number() OVER (ORDER BY f_.ts, f_.inv, f_.ln, stock_code) AS BIGINT) AS product_key,
         stock_code AS product_id, f_.d AS product_name, {_category_case('f_.d')} AS category
  FROM prod_first
),
region_map AS (
  SELECT {title(strip('n.n_name'))} AS country, {title(strip('r.r_name'))} AS region
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
loc_first AS (
  SELECT country, min({{'ts': invoice_ts, 'inv': invoice, 'ln': line_no}}) AS f_ FROM lines GROUP BY country
),
dim_location AS (
  SELECT CAST(row_number() OVER (ORDER BY lf.f_.ts, lf.f_.inv, lf.f_.ln, lf.country) AS BIGINT) AS location_key,
         lf.country, coalesce(m.region, 'Other') AS region
  FROM loc_first lf LEFT JOIN region_map m ON lf.country IS NOT DISTINCT FROM m.country
),
dim_date AS (
  SELECT DISTINCT date_key, full_date, day(full_date) AS day, dayname(full_date) AS day_of_week,
         weekofyear(full_date) AS week, month(full_date) AS month, monthname(full_date) AS month_name,
         quarter(full_date) AS quarter, year(full_date) AS year, isodow(full_date) >= 6 AS is_weekend
  FROM lines
),
fact_sales AS (
  SELECT l.invoice AS invoice_id, c.customer_key, p.product_key, l.date_key, g.location_key,
         l.quantity, l.price AS unit_price, l.revenue, l.discount, l.profit, l.order_value
  FROM lines l
  LEFT JOIN dim_customer c ON l.customer_id = c.customer_id
  LEFT JOIN dim_product p ON l.stock_code IS NOT DISTINCT FROM p.product_id
  LEFT JOIN dim_location g ON l.country IS NOT DISTINCT FROM g.country
)"""


def with_prelude(select: str, ctes: str = "") -> str:
    """``WITH <prelude>[, ctes] select``; ``ctes`` is written without a leading comma."""
    extra = f",\n{ctes}" if ctes.strip() else ""
    return f"WITH {PRELUDE}{extra}\n{select}"
