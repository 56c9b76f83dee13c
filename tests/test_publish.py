"""Versions of a star, the manifest, the fact's primary key."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tillsight import warehouse
from tillsight.operators.quality import key_integrity, unique_longs
from tillsight.operators.star import Star
from tillsight.sources.sinks import load_star, manifest, save_as_tables, save_star, saved_snapshot


@pytest.fixture(scope="module")
def tables(spark):
    return warehouse.star(spark, SF001).tables()


def broken(tables, name):
    """The same tables, one of which fails when it is written."""
    bad = tables[name].withColumn("date_key", F.raise_error(F.lit("the source went away")).cast("int"))
    return {**tables, name: bad}


def small(tables):
    """Another star: half the customers' lines."""
    return {**tables, "fact_sales": tables["fact_sales"].where("customer_key % 2 = 0")}


def test_a_failed_save_leaves_the_old_star_whole(spark, tables):
    d = tempfile.mkdtemp(prefix="tillsight-publish-")
    save_star(tables, d, snapshot="2001-08-02")
    was = manifest(spark, d)
    for name in ("dim_date", "fact_sales"):                # two, then four tables are written before
        with pytest.raises(Exception, match="went away"):
            save_star(broken(small(tables), name), d, snapshot="2002-01-01")
    assert manifest(spark, d) == was and saved_snapshot(spark, d) == "2001-08-02"
    back = load_star(spark, d)
    assert {n: df.count() for n, df in back.items()} == was["counts"]
    assert back["fact_sales"].count() == tables["fact_sales"].count()


def test_readers_keep_the_version_they_opened(spark, tables):
    d = tempfile.mkdtemp(prefix="tillsight-publish-")
    save_star(tables, d)
    first, opened = manifest(spark, d)["version"], load_star(spark, d)
    save_star(small(tables), d)
    assert opened["fact_sales"].count() == tables["fact_sales"].count() > load_star(spark, d)["fact_sales"].count()
    assert load_star(spark, d, version=first)["fact_orders"].count() == opened["fact_orders"].count()
    save_star(tables, d)                                    # the first goes, the second stays
    kept = manifest(spark, d)["kept"]
    assert len(kept) == 2 and sorted(x for x in os.listdir(d) if x.startswith("v")) == sorted(kept) and first not in kept
    with pytest.raises(ValueError, match="not kept"):
        load_star(spark, d, version=first)
    assert not [x for x in os.listdir(d) if x.endswith(".tmp")]


def test_nothing_published(spark):
    with pytest.raises(FileNotFoundError):
        load_star(spark, tempfile.mkdtemp(prefix="tillsight-publish-"))
    assert saved_snapshot(spark, tempfile.mkdtemp(prefix="tillsight-publish-")) is None


@pytest.mark.parametrize("by_month", [False, True])
def test_sale_ids(spark, tables, by_month):
    d = tempfile.mkdtemp(prefix="tillsight-publish-")
    now = dt.datetime(2012, 1, 2, 3, 4, 5)
    save_star(tables, d, partition_fact_by_month=by_month, created_at=now)
    back = load_star(spark, d)
    f = back["fact_sales"]
    assert f.columns[0] == "sale_id" and f.columns[-1] == "created_at"
    rows = f.select("sale_id", "date_key", "customer_key").collect()
    assert len({r.sale_id for r in rows}) == len(rows) and min(r.sale_id for r in rows) > 0
    in_order = [r[1:] for r in sorted(map(tuple, rows))]
    assert in_order == sorted(in_order)
    assert all(back[n].select("created_at").distinct().collect() == [(now,)] for n in tables)
    checks = {r.check_name: r.violations for r in key_integrity(Star(*[back[n] for n in tables], fact_orders=back["fact_orders"])).collect()}
    assert checks["fact_sales.sale_id duplicate"] == checks["fact_sales.sale_id null"] == 0
    worse = f.unionByName(f.limit(3)).unionByName(f.limit(2).withColumn("sale_id", F.lit(None).cast("long")))
    checks = {r.check_name: r.violations for r in key_integrity(Star(*[{**back, "fact_sales": worse}[n] for n in tables])).collect()}
    assert checks["fact_sales.sale_id duplicate"] == 3 and checks["fact_sales.sale_id null"] == 2


def test_an_order_of_rows_gives_the_same_ids_again(spark, tables):
    ids = []
    for seed in (1, 2):
        d = tempfile.mkdtemp(prefix="tillsight-publish-")
        save_star({**tables, "fact_sales": tables["fact_sales"].orderBy(F.rand(seed)).coalesce(1)}, d)
        ids.append(sorted(map(tuple, load_star(spark, d)["fact_sales"].drop("created_at").collect()), key=repr))
    strip = [[r[1:] for r in sorted(x, key=lambda r: r[0])] for x in ids]
    assert strip[0] == strip[1]


def test_bitmap_count_of_keys(spark):
    df = spark.createDataFrame([(x,) for x in [1, 1, 2, 32768, 32769, 32769, 1 << 40, None, None]], "k long")
    assert tuple(unique_longs(df, "k").first()) == (9, 7, 5)
    assert tuple(unique_longs(df.where("k < 0"), "k").first()) == (0, 0, 0)


def test_managed_tables(spark, tables):
    spark.conf.set("spark.sql.legacy.allowNonEmptyLocationInCTAS", "true")
    spark.sql("CREATE DATABASE IF NOT EXISTS star_test LOCATION '%s'" % tempfile.mkdtemp(prefix="tillsight-db-"))
    for _ in range(2):                                      # re-runnable
        assert save_as_tables(tables, "star_test")[-1] == "star_test.fact_sales"
    assert spark.table("star_test.fact_sales").count() == tables["fact_sales"].count()
    spark.sql("DROP DATABASE star_test CASCADE")
