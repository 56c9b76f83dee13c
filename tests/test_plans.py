"""Physical-plan guards for scale: no cartesian products, nested-loop joins or Python UDFs in
any registered query; the bounded dimensions are broadcast; scans read only needed columns."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF001

BANNED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
          "FlatMapGroupsInPandas", "MapInPandas"]


OTHERS = {"pipeline", *(E.llm.QUERIES if E.llm else ())}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(E.queries().keys() - OTHERS))
def test_no_banned_operators(spark, key):
    plan = _plan(E.queries()[key](spark, SF001))
    found = [b for b in BANNED if b in plan]
    assert not found, found


def test_date_and_location_dimensions_are_broadcast(spark):
    plan = _plan(E.queries()["region_trend"](spark, SF001))
    assert plan.count("BroadcastHashJoin") >= 2
    assert "SortMergeJoin" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(E.queries()["by_region"](spark, SF001))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", _explain(E.queries()["by_region"](spark, SF001)))
    fact = [s for s in schemas if "order_value" in s]      # the orders: their ids are counted from bitmaps
    assert fact and all("date_key" not in s and "invoice_id" not in s for s in fact), schemas
    assert "Scan" in plan or "FileScan" in plan


def _explain(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_lines_are_never_joined_with_products(spark):
    """Even where no dimension is small enough to broadcast, the fact's category is at hand."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for key in ("category_summary", "category_trend"):
            plan = _plan(E.queries()[key](spark, SF001))
            assert "Expand" not in plan, key
            joins = re.findall(r"Join \[product_key#.*\n(?:.*\n){0,4}", plan)
            # The only join with the products takes distinct (category, product) pairs.
            assert all("HashAggregate(keys=[category" in j for j in joins) and len(joins) <= (key == "category_summary"), joins
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_milestones_and_repeat_rate_do_not_expand(spark):
    for key in ("cohort_milestones", "repeat_rate"):
        assert "Expand" not in _plan(E.queries()[key](spark, SF001)), key


def test_invoice_grain_is_a_hash_aggregate(spark):
    from tillsight import warehouse
    from tillsight.operators.keys import invoice_grain

    lines = warehouse.star(spark, SF001).extras["lines"]
    plan = _plan(invoice_grain(lines, "customer_id", "country"))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
