"""Sources and sinks (X1, X3–X7, U2) and the hash surrogate-key mode."""

import datetime as dt
import tempfile
from decimal import Decimal

from pyspark.sql import Row
from pyspark.sql import functions as F

from tests.conftest import SF001
from tillsight import warehouse
from tillsight.operators.star import build_star
from tillsight.plans import customer, sales
from tillsight.schemas import RAW_TRANSACTIONS
from tillsight.sources.raw import read_transactions, write_table
from tillsight.sources.sinks import load_star, save_star


def test_multi_part_csv_source_tags_origin(spark):
    d = tempfile.mkdtemp(prefix="tillsight-parts-")
    rows = [Row(invoice="1", stock_code="A", description="MUG", quantity=2,
                invoice_ts=dt.datetime(2010, 1, 2, 9, 30), price=Decimal("1.250"), customer_id="7",
                country="France", line_no=1)]
    for part in ["y1", "y2"]:
        write_table(spark.createDataFrame(rows, RAW_TRANSACTIONS), f"{d}/{part}", fmt="csv")
    import os
    os.makedirs(f"{d}/y3")
    with open(f"{d}/y3/part.csv", "w") as fh:     # the reference's text form, space-separated
        fh.write("invoice,stock_code,description,quantity,invoice_ts,price,customer_id,country,line_no\n")
        fh.write("2,B,CUP,1,2010-12-01 08:26:00,3.5,8.0,Spain,1\n")
    raw = read_transactions(spark, {"Year 1": f"{d}/y1", "Year 2": f"{d}/y2"}, fmt="csv")
    third = read_transactions(spark, {"Year 3": f"{d}/y3"}, fmt="csv").first()
    assert third.invoice_ts == dt.datetime(2010, 12, 1, 8, 26) and third.price == Decimal("3.500")
    assert third.customer_id == "8"
    got = raw.orderBy("source").collect()
    assert [r.source for r in got] == ["Year 1", "Year 2"]
    assert got[0].invoice_ts == dt.datetime(2010, 1, 2, 9, 30)
    assert got[0].price == Decimal("1.250") and got[0].customer_id == "7"


def test_save_and_load_star_round_trip(spark):
    st = warehouse.star(spark, SF001)
    d = tempfile.mkdtemp(prefix="tillsight-star-")
    save_star(st.tables(), d, partition_fact_by_month=True)
    back = load_star(spark, d)
    for name, df in st.tables().items():
        assert back[name].count() == df.count(), name
        assert sorted(back[name].columns) == sorted(df.columns), name
    # clustered fact: each file covers a narrow date range
    assert back["fact_sales"].agg(F.sum("revenue")).first()[0] == st.fact_sales.agg(F.sum("revenue")).first()[0]
    # re-runnable: a second save fully replaces
    save_star(st.tables(), d)
    assert load_star(spark, d)["fact_sales"].count() == st.fact_sales.count()


def test_source_layout_and_part_order(spark):
    """The source's own headers, no line numbers; the part given first keeps its row."""
    from tillsight.operators.clean import clean

    d = tempfile.mkdtemp(prefix="tillsight-layout-")
    head = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
    for name, q in (("z_first", 5), ("a_second", 6)):
        with open(f"{d}/{name}.csv", "w") as fh:
            fh.write(head + f"1,S1,MUG,{q},2010-12-01 08:26:00,2.5,8.0,Spain\n1,S1,MUG,9,2010-12-01 08:26:00,2.5,8.0,Spain\n")
    raw = read_transactions(spark, {n: f"{d}/{n}.csv" for n in ("z_first", "a_second")}, fmt="csv")
    kept = clean(raw).collect()
    assert [(r.source, r.quantity, r.customer_id) for r in kept] == [("z_first", 5, "8")]
    with open(f"{d}/bad.csv", "w") as fh:
        fh.write(head + "1,S1,MUG,many,2010-12-01 08:26:00,2.5,8.0,Spain\n")
    import pytest
    with pytest.raises(Exception, match="many"):
        read_transactions(spark, {"bad": f"{d}/bad.csv"}, fmt="csv").collect()
    with pytest.raises(ValueError, match="price"):
        from tillsight.sources.raw import normalise
        normalise(raw.drop("price"))


def test_csv_star_round_trip(spark):
    st = warehouse.star(spark, SF001)
    d = tempfile.mkdtemp(prefix="tillsight-csv-")
    save_star(st.tables(), d, fmt="csv", snapshot="2001-08-02")
    back = load_star(spark, d, fmt="csv")
    for name, df in st.tables().items():
        assert back[name].dtypes == df.dtypes, name
        same = [c for c in df.columns if c not in ("created_at", "sale_id")]
        assert sorted(map(tuple, back[name].select(*same).collect())) == sorted(map(tuple, df.select(*same).collect())), name
    from tillsight.sources.sinks import saved_snapshot
    assert saved_snapshot(spark, d) == "2001-08-02" and back["fact_orders"].count() == st.fact_orders.count()


def test_unit_price_keeps_its_decimals(spark):
    rows = [("1", "A", "MUG", 1, dt.datetime(2010, 1, 2), Decimal(p), "7", "France", i)
            for i, p in enumerate(["0.001", "0.125"])]
    rows = [(r[0], f"S{r[-1]}", *r[2:]) for r in rows]
    from tillsight.operators.star import StarConfig
    st = build_star(spark.createDataFrame(rows, RAW_TRANSACTIONS), StarConfig(on_duplicate_edges="drop"))
    assert sorted(r.unit_price for r in st.fact_sales.collect()) == [Decimal("0.001"), Decimal("0.125")]


def test_default_dates_belong_to_the_star(spark):
    """A star of 2010 with the library's own defaults: no date of the test tables."""
    from tillsight.operators.star import StarConfig
    rows = [(str(c), f"S{c}", "MUG", 1, dt.datetime(2010, 1, 1 + c), Decimal("2.000"), str(c), "France", c) for c in range(20)]
    st = build_star(spark.createDataFrame(rows, RAW_TRANSACTIONS), StarConfig(on_duplicate_edges="drop"))
    assert customer.cust_inactive(st).count() == 20
    assert all(r.avg_recency_days > 700 for r in customer.rfm_segments(st).collect())


def test_command_line_parameters_are_typed():
    import pytest
    from tillsight.__main__ import typed
    from tillsight.plans import products

    assert typed(products.products_top_revenue, {"k": "5"}) == {"k": 5}
    assert typed(customer.cust_inactive, {"as_of": "2011-01-01", "days": "30"}) == {"as_of": "2011-01-01", "days": 30}
    with pytest.raises(SystemExit):
        typed(products.products_top_revenue, {"n": "5"})


def test_hash_keys_give_the_same_marts(spark):
    cfg = warehouse.testdata_config(spark, SF001, key_mode="hash")
    hashed = build_star(warehouse.raw(spark, SF001), cfg)
    dense = warehouse.star(spark, SF001)
    dc = hashed.dim_customer
    assert dc.select("customer_key").distinct().count() == dc.count()
    for fn in [sales.monthly_growth, customer.segment_distribution, customer.cust_top20_limit,
               customer.churn_bands]:
        a = sorted(map(tuple, fn(hashed).collect()))
        b = sorted(map(tuple, fn(dense).collect()))
        assert a == b, fn.__name__


def test_command_line_build_and_mart(spark, capsys):
    from tillsight.__main__ import main

    d = tempfile.mkdtemp(prefix="tillsight-cli-")
    main(["build", "--testdata", SF001, "--out", f"{d}/star"])
    main(["mart", "rfm_segments", "--star", f"{d}/star", "--param", "snapshot=2001-08-02", "--out", f"{d}/rfm"])
    got = sorted(map(tuple, spark.read.parquet(f"{d}/rfm").collect()))
    exp = sorted(map(tuple, customer.rfm_segments(warehouse.star(spark, SF001), snapshot="2001-08-02").collect()))
    assert got == exp


def test_profile_approx_mode(spark):
    from tillsight.operators.quality import profile
    from tillsight.schemas import RAW_COLUMNS

    raw = warehouse.raw(spark, SF001).select(*RAW_COLUMNS)
    exact = {(r.metric, r.column_name): r.value for r in profile(raw).collect()}
    approx = {(r.metric, r.column_name): r.value for r in profile(raw, approx=True).collect()}
    assert exact.keys() == approx.keys()
    for key in [("distinct", "customer_id"), ("distinct", "stock_code")]:
        assert abs(int(approx[key]) - int(exact[key])) <= 0.05 * int(exact[key])
    assert approx[("row_count", "*")] == exact[("row_count", "*")]
