"""Exact distinct counts from merged bitmaps: against counting, in plans, and where keys are not dense."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF001
from tillsight import plans, warehouse
from tillsight.operators.distinct import dense, merged_counts, order_bitmaps, with_order_no
from tillsight.operators.star import Star, build_star
from tillsight.sources.sinks import load_star, save_star

MARTS = ["kpis", "annual_kpis", "annual_summary", "by_country", "by_region", "top_markets", "monthly_growth", "rolling_3m",
         "run_rate"]
GRAIN = "invoice_id string, customer_key long, date_key int, location_key long, revenue long"


def grain(spark, n=4000, seed=3):
    """Two of three rows in one hot month and place; null keys; an invoice of several customers and days."""
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        hot = r.random() < 0.67
        rows.append((r.choice([None, "A1"]) if r.random() < 0.02 else f"I{r.randrange(n // 2)}",
                     None if r.random() < 0.02 else r.randrange(1, 90_000),
                     None if r.random() < 0.01 else 20100105 if hot else 20090100 + 100 * r.randrange(20) % 1200 + r.randrange(1, 28),
                     None if r.random() < 0.01 else 1 if hot else r.randrange(2, 9), r.randrange(100)))
    return spark.createDataFrame(rows, GRAIN).repartition(7)


@pytest.mark.parametrize("by", [[], ["month_no"], ["location_key"], ["month_no", "location_key"], ["year"]])
def test_merged_counts_equal_counting(spark, by):
    df = with_order_no(grain(spark)).withColumn("month_no", F.floor(F.col("date_key") / 100).cast("int"))
    year = F.floor(F.col("month_no") / 100)
    bits = order_bitmaps(df).withColumn("year", year)
    got = merged_counts(bits, by, orders="order", customers="customer")
    want = df.withColumn("year", year).groupBy(*by).agg(F.count_distinct("invoice_id").alias("orders"),
                                                        F.count_distinct("customer_key").alias("customers"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_order_numbers_name_invoices(spark):
    df = with_order_no(grain(spark))
    per = df.where("invoice_id IS NOT NULL").groupBy("invoice_id").agg(F.count_distinct("order_no").alias("n"), F.min("order_no").alias("k"))
    assert per.where("n != 1 OR k IS NULL OR k < 1").count() == 0
    assert per.select("k").distinct().count() == per.count()
    assert df.where("invoice_id IS NULL AND order_no IS NOT NULL").count() == 0 and df.where("invoice_id IS NULL").count() > 0


def test_empty_orders(spark):
    none = order_bitmaps(with_order_no(spark.createDataFrame([], GRAIN)))
    assert merged_counts(none, ["location_key"], orders="order").count() == 0
    assert tuple(merged_counts(none, [], orders="order", customers="customer").first()) == (0, 0)


def test_dense_keys(spark):
    of = lambda *k: dense(spark.createDataFrame([(x,) for x in k], "k long"), "k")
    assert of() and of(1, 2, 3) and not of(-5, 1) and not of(1, 2 ** 40)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", MARTS)
def test_no_expand(spark, key):
    plan = _plan(E.queries()[key](spark, SF001))
    assert "Expand" not in plan, plan


def test_hash_keys_give_the_same_counts_without_bitmaps(spark, tmp_path):
    cfg = warehouse.testdata_config(spark, SF001, key_mode="hash")
    built = build_star(warehouse.raw(spark, SF001), cfg)
    save_star(built.tables(), str(tmp_path / "s"), snapshot=built.snapshot)
    t = load_star(spark, str(tmp_path / "s"))
    assert "order_bits" not in t
    hashed = Star(*[t[n] for n in ("dim_customer", "dim_product", "dim_date", "dim_location", "fact_sales")],
                  fact_orders=t["fact_orders"], snapshot=built.snapshot)
    dense_star = warehouse.star(spark, SF001)
    assert dense_star.order_bits is not None
    for key in MARTS:
        a, b = (sorted(map(str, plans.registry()[key](s).collect())) for s in (hashed, dense_star))
        assert a == b, key
