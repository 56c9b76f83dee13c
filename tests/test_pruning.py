"""What a scan of the saved fact reads for a day, for one customer and for one product."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tillsight import warehouse
from tillsight.sources import sinks


@pytest.fixture(scope="module")
def facts(spark):
    """The fact with the filters and without, its keys made so many that no dictionary holds them."""
    tables = warehouse.star(spark, SF001).tables()
    f = tables["fact_sales"]
    n = 400_000 // f.count() + 1
    many = f.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(n)))).withColumn("_h", F.xxhash64(*f.columns, "_i"))
    many = many.withColumns({"customer_key": F.abs("_h") % 1_000_003, "product_key": F.abs(F.xxhash64("_h")) % 500_009}).drop("_i", "_h")
    out = {}
    for name in ("filters", "none"):
        with pytest.MonkeyPatch.context() as m:
            if name == "none":
                m.setattr(sinks, "key_filters", lambda columns: {})
            d = tempfile.mkdtemp(prefix="tillsight-pruning-")
            sinks.save_star({**tables, "fact_sales": many}, d)
            out[name] = sinks.load_star(spark, d)
    return out


def rows_read(spark, df):
    """Rows that the scan hands on: whole row groups that statistics or filters rule out are not among them."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")

    def scans(node):
        if "Scan" in node.nodeName():
            return node.metrics().apply("numOutputRows").value()
        return sum(scans(node.children().apply(i)) for i in range(node.children().size()))

    return scans(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("key", sinks.POINT_KEYS)
def test_one_key_reads_few_row_groups(spark, facts, key):
    total = facts["none"]["fact_sales"].count()
    value = facts["none"]["fact_sales"].agg(F.percentile_approx(key, 0.5)).first()[0]
    read = {}
    for name, tables in facts.items():
        hits = tables["fact_sales"].where(F.col(key) == value)
        read[name] = rows_read(spark, hits)
        assert hits.count() >= 1
    assert read["none"] == total
    assert read["filters"] <= total / 3, read


def test_orders_are_pruned_by_customer_too(spark, facts):
    value = facts["none"]["fact_orders"].agg(F.percentile_approx("customer_key", 0.5)).first()[0]
    read = {n: rows_read(spark, t["fact_orders"].where(F.col("customer_key") == value)) for n, t in facts.items()}
    assert 0 < read["filters"] < read["none"], read


def test_filters_change_no_row(spark, facts):
    day = facts["none"]["fact_sales"].agg(F.min("date_key")).first()[0]
    for where in (F.col("date_key") == day, F.col("customer_key") < 2000, F.col("product_key") == -1):
        a, b = ([tuple(r) for r in t["fact_sales"].where(where).drop("sale_id", "created_at").collect()] for t in facts.values())
        assert sorted(a, key=repr) == sorted(b, key=repr)


def test_a_day_reads_few_row_groups(spark, facts):
    f = facts["filters"]["fact_sales"]
    day = f.agg(F.min("date_key")).first()[0]
    assert rows_read(spark, f.where(F.col("date_key") == day)) <= f.count() / 3
