"""Mart rules the driver tables cannot trigger, on a tiny star built from inline lines
(FIXTURES.md §3: year gap, single-line customer, tie at rank 1)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tillsight.operators.star import StarConfig, build_star
from tillsight.plans import customer, executive, retention, sales
from tillsight.schemas import RAW_TRANSACTIONS


def _line(i, cust, ts, country="France", code="A", qty=1, price="10.000", invoice=None):
    return dict(invoice=invoice or f"{i}", stock_code=code, description=f"ITEM {code}", quantity=qty,
                invoice_ts=ts, price=Decimal(price), customer_id=cust, country=country, line_no=i)


@pytest.fixture(scope="module")
def star(spark):
    rows = [
        # customer 1: 2009 and 2011 only (a year gap), several lines on one day
        _line(1, "1", dt.datetime(2009, 3, 1), invoice="100"),
        _line(2, "1", dt.datetime(2009, 3, 1), code="B", invoice="100"),
        _line(3, "1", dt.datetime(2011, 3, 5), invoice="101"),
        # customer 2: a single line
        _line(4, "2", dt.datetime(2011, 6, 1), country="Japan", price="20.000"),
        # customer 3: same revenue in Japan as France's total, so two regions tie at rank 1
        _line(5, "3", dt.datetime(2011, 7, 1), country="Japan", code="C", price="10.000"),
        _line(6, "4", dt.datetime(2011, 8, 1), country="France", code="C", price="0.000", qty=0),
    ]
    df = spark.createDataFrame([Row(**r) for r in rows], RAW_TRANSACTIONS).withColumn("source", F.lit("t"))
    return build_star(df, StarConfig(snapshot="2012-01-01", on_duplicate_edges="drop", key_mode="dense"))


def test_year_gap_lag_takes_previous_year_present(star):
    rows = {r.year: r for r in sales.annual_summary(star).collect()}
    assert sorted(rows) == [2009, 2011]
    assert rows[2011].prev_year_revenue == rows[2009].total_revenue == 20.0
    assert rows[2009].next_year_revenue == rows[2011].total_revenue


def test_single_line_customer_keeps_null_gap(star):
    gaps = {r.customer_key: r for r in customer.purchase_gaps(star).collect()}
    keys = {r.customer_id: r.customer_key for r in star.dim_customer.collect()}
    assert keys["2"] not in gaps and keys["3"] not in gaps      # one line each: no gap row
    g1 = gaps[keys["1"]]
    assert (g1.min_gap_days, g1.max_gap_days) == (0, 734)
    assert g1.avg_gap_days == pytest.approx(734 / 2)
    bands = customer.churn_bands(star).collect()
    assert sum(r.customer_count for r in bands) == star.dim_customer.count() == 3
    rg = {r.segment: r for r in retention.gap_by_segment(star).collect()}
    assert sum(r.customer_count for r in rg.values()) == 1


def test_tie_at_rank_one_gives_two_rows(star):
    rows = executive.top_of_each(star).collect()
    assert sorted(r.top_region for r in rows) == ["Asia Pacific", "Europe"]
    assert {r.region_revenue for r in rows} == {30.0}
