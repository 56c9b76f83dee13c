"""Inline rows for rules the driver tables cannot trigger (FIXTURES.md §3)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tillsight.functions.classify import (REFERENCE_CATEGORY_RULES, REFERENCE_REGION_RULES, classify,
                                          region_of)
from tillsight.functions.dates import date_parts, recency_days
from tillsight.functions.text import strip, title_case
from tillsight.operators.clean import clean
from tillsight.operators.enrich import enrich_money, rfm, rfm_scores, with_date_parts
from tillsight.schemas import RAW_TRANSACTIONS

TS = dt.datetime(2011, 1, 5, 10, 0)


def _raw(spark, rows):
    full = []
    for i, r in enumerate(rows):
        base = dict(invoice="536365", stock_code="85123A", description="WHITE HEART", quantity=1,
                    invoice_ts=TS, price=Decimal("2.550"), customer_id="17850", country="United Kingdom",
                    line_no=i)
        base.update(r)
        full.append(base)
    df = spark.createDataFrame([Row(**x) for x in full], RAW_TRANSACTIONS)
    return df.withColumn("source", F.lit("t"))


def test_null_ids_dropped_null_code_kept(spark):
    df = _raw(spark, [dict(customer_id=None), dict(description=None, invoice="2"),
                      dict(stock_code=None, invoice="3"), dict(invoice="4")])
    got = clean(df).select("invoice").collect()
    assert sorted(r.invoice for r in got) == ["3", "4"]


def test_codes_before_trim_and_prefixes(spark):
    codes = ["POST", "POST ", "post", "BANK CHARGES", "GIFT_0001_20", "gift1"]
    df = _raw(spark, [dict(stock_code=c, invoice=str(i)) for i, c in enumerate(codes)])
    kept = sorted(r.stock_code for r in clean(df).collect())
    assert kept == ["POST", "gift1", "post"]          # "POST " survives the exact filter, then is trimmed


def test_cancellations_case_sensitive_untrimmed(spark):
    df = _raw(spark, [dict(invoice="C536379"), dict(invoice="c536379"), dict(invoice=" C536379")])
    assert sorted(r.invoice for r in clean(df).collect()) == [" C536379", "c536379"]


def test_sign_rules(spark):
    rows = [dict(quantity=-1, invoice="1"), dict(quantity=0, invoice="2"), dict(quantity=1, invoice="3"),
            dict(quantity=1, price=Decimal("0"), invoice="4")]
    assert [r.invoice for r in clean(_raw(spark, rows)).collect()] == ["3"]


def test_dedup_keeps_first_by_ordinal(spark):
    rows = [dict(quantity=2, line_no=1), dict(quantity=3, line_no=2)]
    got = clean(_raw(spark, rows), order=["line_no"]).collect()
    assert len(got) == 1 and got[0].quantity == 2


def test_country_title_case_and_strip(spark):
    vals = ["cote d'ivoire", "USA", "EIRE", " france ", "nation_0"]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    got = [r.t for r in df.select(title_case(strip("c")).alias("t")).collect()]
    assert got == ["Cote D'Ivoire", "Usa", "Eire", "France", "Nation_0"]
    assert got == [v.strip().title() for v in vals]


def test_region_rules(spark):
    vals = ["Usa", "Eire", "United States", "Japan", "France", None]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    got = [r.r for r in df.select(region_of("c", REFERENCE_REGION_RULES).alias("r")).collect()]
    assert got == ["Other", "Other", "North America", "Asia Pacific", "Europe", "Other"]


def test_category_precedence(spark):
    vals = ["HEART CANDLE", "DELIGHT", "PAINTING", "TEA SET", None, "xmas heart"]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    got = [r.k for r in df.select(classify("c", REFERENCE_CATEGORY_RULES).alias("k")).collect()]
    assert got == ["Romance", "Lighting", "Storage", "Food & Drink", "General", "Romance"]
    assert "Décor" in [lab for lab, _ in REFERENCE_CATEGORY_RULES]


def test_recency_floors_whole_days(spark):
    df = spark.createDataFrame([(dt.datetime(2011, 12, 9, 12, 50),)], "t timestamp_ntz")
    assert df.select(recency_days("t", "2012-01-01").alias("r")).first().r == 22
    assert df.select(F.datediff(F.lit(dt.date(2012, 1, 1)), F.to_date("t")).alias("d")).first().d == 23


def test_iso_week_beside_calendar_year(spark):
    df = spark.createDataFrame([(dt.datetime(2011, 1, 1),)], "t timestamp_ntz")
    row = df.select(*[c.alias(k) for k, c in date_parts("t").items()]).first()
    assert (row.week, row.year, row.day_of_week, row.is_weekend, row.date_key) == (52, 2011, "Saturday", True, 20110101)


def test_money_half_up_and_order_value(spark):
    rows = [dict(invoice="9", quantity=1, price=Decimal("1.005"), line_no=1, stock_code="A"),
            dict(invoice="9", quantity=3, price=Decimal("0.125"), line_no=2, stock_code="B")]
    df = enrich_money(clean(_raw(spark, rows)))
    got = {r.stock_code: (r.revenue, r.profit, r.order_value) for r in df.collect()}
    assert got["A"] == (Decimal("1.01"), Decimal("0.40"), Decimal("1.39"))
    assert got["B"] == (Decimal("0.38"), Decimal("0.15"), Decimal("1.39"))


def test_duplicate_recency_edges_raise(spark):
    rows = [dict(customer_id=str(i), invoice=str(i), invoice_ts=dt.datetime(2011, 12, 31 - d))
            for i, d in enumerate([1, 1, 1, 1, 1, 1, 2, 3])]
    lines = with_date_parts(enrich_money(clean(_raw(spark, rows))))
    with pytest.raises(Exception, match="unique"):
        rfm_scores(rfm(lines, "2012-01-01")).collect()


def test_rfm_scores_match_pandas_qcut(spark):
    import pandas as pd

    rows = []
    for c in range(40):
        for k in range(1 + c % 7):
            rows.append(dict(customer_id=f"{1000 + c}", invoice=f"{c}-{k}", stock_code=f"S{k}",
                             invoice_ts=dt.datetime(2011, 1 + (c * 7 + k) % 12, 1 + c % 27),
                             quantity=1 + (c * k) % 5))
    lines = with_date_parts(enrich_money(clean(_raw(spark, rows))))
    got = rfm_scores(rfm(lines, "2012-01-01")).toPandas().set_index("customer_id").sort_index()
    pdf = lines.select("customer_id", "invoice", "revenue", "invoice_ts").toPandas()
    pdf["revenue"] = pdf["revenue"].astype(float)
    r = pdf.groupby("customer_id").agg(last=("invoice_ts", "max"), freq=("invoice", "nunique"),
                                       mon=("revenue", "sum")).reset_index()
    r["rec"] = (pd.Timestamp("2012-01-01") - r["last"]).dt.days
    r["R"] = pd.qcut(r["rec"], q=5, labels=[5, 4, 3, 2, 1]).astype(int)
    r["F"] = pd.qcut(r["freq"].rank(method="first"), q=5, labels=[1, 2, 3, 4, 5]).astype(int)
    r["M"] = pd.qcut(r["mon"].rank(method="first"), q=5, labels=[1, 2, 3, 4, 5]).astype(int)
    r = r.set_index("customer_id").sort_index()
    assert list(got["recency_days"]) == list(r["rec"])
    assert list(got["r_score"]) == list(r["R"])
    assert list(got["f_score"]) == list(r["F"])
    assert list(got["m_score"]) == list(r["M"])


def test_strip_and_title_match_python_on_random_text(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    alphabet = st.sampled_from(list("abcXYZ \u00e9\u00fc\u00e7\u00c9'-_.,&/0123456789") + ["\t", "\u00a0", "\u3000", "\n"])

    @settings(max_examples=4, deadline=None)
    @given(st.lists(st.text(alphabet, max_size=24), min_size=50, max_size=120))
    def check(values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        got = [r.t for r in df.select("i", title_case(strip("v")).alias("t")).orderBy("i").collect()]
        assert got == [v.strip().title() for v in values]

    check()
