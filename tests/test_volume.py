"""What the ETL shuffles and how much one task sorts: exchanges in plans, rows a task, and rows that are split by hand."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF001
from tillsight import warehouse
from tillsight.operators import joins
from tillsight.operators.clean import clean, dedup_dealt, valid_lines
from tillsight.operators.enrich import enrich_money, measures, priced_lines, rfm
from tillsight.operators.joins import heavy_keys, tasks_for
from tillsight.sources import sinks

COLUMNS = ("invoice string, stock_code string, description string, quantity int, invoice_ts timestamp_ntz, price decimal(18,3), "
           "customer_id string, country string, line_no long, part_no int")


@pytest.fixture(scope="module")
def raw(spark):
    """600 lines of 60 invoices; one invoice has a third of them, copies among them, and some have no invoice."""
    df = spark.range(600).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 'H' WHEN id % 50 = 1 THEN NULL WHEN id % 77 = 2 THEN 'C1' ELSE concat('I', id % 60) END").alias("invoice"),
        F.expr("concat(' S', id % 7)").alias("stock_code"), F.expr("concat('d', id % 11)").alias("description"),
        F.expr("cast(id % 9 as int)").alias("quantity"), F.expr("timestamp_ntz'2011-01-01 10:00:00' + make_interval(0, 0, 0, id % 40)").alias("invoice_ts"),
        F.expr("cast(id % 13 / 4 as decimal(18,3))").alias("price"), F.expr("concat('K', id % 5)").alias("customer_id"),
        F.expr("concat('land ', id % 4)").alias("country"), F.col("id").alias("line_no"), F.lit(0).alias("part_no"))
    return spark.createDataFrame(df.collect(), COLUMNS).repartition(5)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("tasks", [None, 23])
def test_one_exchange_gives_the_same_lines_and_order_values(spark, raw, hot, tasks):
    valid = valid_lines(raw)
    found = heavy_keys(valid, {"invoice": ["invoice"]}, tasks=20)["invoice"] if hot else None
    assert not hot or found
    cols = [*raw.columns, "order_value"]
    want = enrich_money(clean(raw)).select(cols)
    assert rows(priced_lines(valid, None, hot_invoices=found, tasks=tasks).select(cols)) == rows(want)
    assert rows(dedup_dealt(valid, None, found, tasks)) == rows(clean(raw))


def test_lines_are_exchanged_once(spark, raw):
    plan = priced_lines(valid_lines(raw.repartition(3)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "Join" not in plan, plan


def test_customer_metrics_exchange_pairs_and_customers_only(spark, raw):
    lines = enrich_money(clean(raw)).localCheckpoint()
    plan = rfm(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 2, plan
    got = {r.customer_id: (r.frequency, r.monetary, r.last_purchase) for r in rfm(lines).collect()}
    want = lines.groupBy("customer_id").agg(F.count_distinct("invoice").alias("n"), F.sum("revenue").alias("m"), F.max("invoice_ts").alias("t"))
    assert got == {r.customer_id: (r.n, r.m, r.t) for r in want.collect()}
    first = lines.groupBy("customer_id").agg(F.min(F.struct("invoice_ts", "invoice", "part_no", "line_no", "country")).alias("f")).collect()
    assert {r.customer_id: (r.first_ts, r.first_invoice, r.first_line, r.country) for r in rfm(lines).collect()} == {
        r.customer_id: (r.f.invoice_ts, r.f.invoice, r.f.line_no, r.f.country) for r in first}


def test_derived_measures_do_not_travel(spark):
    built = warehouse.star(spark, SF001)
    fact = built.fact_sales.drop("sale_id", "created_at")
    late = sinks.cluster_fact(fact, 4, measures(0.4, "unit_price"))
    assert late.dtypes == fact.dtypes and rows(late) == rows(fact)
    before = late._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1].split("Relation [")[0]
    assert "profit" not in before and "revenue" not in before


def test_files_and_tasks_follow_the_rows(spark, monkeypatch):
    raw = warehouse.raw(spark, SF001)
    n = raw.count()
    assert tasks_for(raw) is None and tasks_for(raw, 100) == -(-n // 100)
    want = rows(E.queries()["etl_line_order"](spark, SF001))
    seen = []
    from tillsight.plans import etl

    def noted(df, path):
        seen.append(df.rdd.getNumPartitions())
        sinks.checked_write(df, path)

    monkeypatch.setattr(joins, "ROWS_A_TASK", 200)
    monkeypatch.setattr(etl, "write_table", noted)
    assert rows(E.queries()["etl_line_order"](spark, SF001)) == want
    assert seen[0] >= n // 200 > 5
