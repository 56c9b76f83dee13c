"""Every registered query against its DuckDB oracle on the smallest driver tables, plus the
entry smoke check and invariants of the marts."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF001
from tillsight import warehouse
from tillsight.oracle.compare import compare, duckdb_connection

# The library's own queries; the training-data operators have tests of their own.
OTHERS = {"pipeline", *(E.llm.QUERIES if E.llm else ())}
QUERIES = {k: q for k, q in E.queries().items() if k not in OTHERS}
ORACLE = {k: q for k, q in E.oracle_sql().items() if k not in OTHERS}


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    res = compare(QUERIES[key](spark, SF001), con, ORACLE[key])
    assert res["columns_match"], (res["spark_cols"], res["oracle_cols"])
    assert res["spark_rows"] == res["oracle_rows"]
    assert res["values_match"], res.get("first_diffs")


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["segment", "customer_count", "avg_recency_days", "avg_frequency", "avg_monetary",
                          "total_revenue", "revenue_pct"]


def test_fact_sample_rows(spark):
    assert QUERIES["fact_sample"](spark, SF001).count() == 5


def test_fixture_regression_counts(spark):
    st = warehouse.star(spark, SF001)
    assert st.fact_sales.count() == 4004
    seg = {r.segment: r["count"] for r in st.dim_customer.groupBy("segment").count().collect()}
    assert seg == {"VIP": 28, "Loyal": 41, "New": 13, "At Risk": 21, "Lost": 21, "Potential": 26}


def test_invariants(spark):
    st = warehouse.star(spark, SF001)
    q = QUERIES
    # shares add to 100 (rounding aside)
    for key, col in [("segment_distribution", "revenue_pct"), ("by_region", "revenue_share_pct"),
                     ("weekend_split", "revenue_pct"), ("churn_exposure", "pct_of_total_revenue")]:
        total = q[key](spark, SF001).agg(F.sum(col)).first()[0]
        assert abs(total - 100.0) < 0.05, (key, total)
    # Σ order value over distinct invoices = Σ line revenue
    f = st.fact_sales
    inv = f.groupBy("invoice_id").agg(F.first("order_value").alias("ov")).agg(F.sum("ov")).first()[0]
    assert inv == f.agg(F.sum("revenue")).first()[0]
    # cohort period 0 equals the cohort size
    r = q["cohort_retention"](spark, SF001).where("period = 0")
    assert r.where("active_customers != cohort_size").count() == 0
    # no orphans, no duplicate keys
    assert q["key_integrity"](spark, SF001).where("violations != 0").count() == 0
    # NTILE(4) quartiles differ in size by at most one
    sizes = [row.customer_count for row in q["clv_quartiles"](spark, SF001).collect()]
    assert max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("parts", [1, 3, 64])
def test_shuffle_invariance(spark, parts):
    """Distributed ranks, NTILEs and running sums do not depend on the partition count."""
    from tillsight.plans import customer, products

    st = warehouse.star(spark, SF001)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        base = {}
        spark.conf.set("spark.sql.shuffle.partitions", old)
        base["p"] = sorted(map(tuple, products.pareto(st).collect()))
        base["r"] = sorted(map(tuple, customer.rfm_segments(st, snapshot="2001-08-02").collect()))
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        assert sorted(map(tuple, products.pareto(st).collect())) == base["p"]
        assert sorted(map(tuple, customer.rfm_segments(st, snapshot="2001-08-02").collect())) == base["r"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
