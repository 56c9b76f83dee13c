"""Hot keys of the line joins, found by the library and cut whatever adaptive execution does."""

import pytest
from pyspark.sql import functions as F

from tests.test_skew import skewed_dir  # noqa: F401
from tillsight.operators.joins import heavy_keys, key_hash, lookup_join


@pytest.fixture
def no_aqe(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def lines(spark, n=9000):
    """A third of the rows have key 'hot', a third no key, the others 50 keys."""
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").when(i % 3 == 1, F.concat(F.lit("k"), (i % 50).cast("string")))
    return spark.range(0, n, 1, 8).select("id", key.alias("k"))


def test_heavy_keys(spark):
    df = lines(spark)
    hot = heavy_keys(df, {"k": ["k"], "id": ["id"]}, tasks=12)
    named = {r["h"]: r["k"] for r in df.select("k", key_hash(["k"]).alias("h")).distinct().collect()}
    assert {named[h]: p for h, p in hot["k"].items()} == {"hot": 4, None: 4} and hot["id"] == {}
    assert heavy_keys(df.limit(0), {"k": ["k"]}) == {"k": {}}
    assert len(heavy_keys(df, {"k": ["k"]}, tasks=3000)["k"]) == 52          # every key is over its share: they are 52


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_rows_are_those_of_the_plain_join(spark, no_aqe, null_safe, how):
    df = lines(spark)
    small = spark.createDataFrame([("hot", 1), ("k7", 2), ("none", 3), (None, 4)], "name string, v int")
    get = lambda hot: sorted(map(tuple, lookup_join(
        df, small, ["k"], ["name"], how, null_safe, hot).collect()), key=repr)
    hot = heavy_keys(df, {"k": ["k"]}, tasks=12)["k"]
    assert get(hot) == get(None) and len(hot) == 2
    assert get({h: 50 for h in hot}) == get(None)                              # more pieces than input partitions
    out = lookup_join(df, small, ["k"], ["name"], how, null_safe, hot)
    assert out.columns == ["id", "k", "v"]


def test_a_hot_key_is_split_without_adaptive_execution(spark, no_aqe):
    df = lines(spark)
    small = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))

    def most(hot):
        out = lookup_join(df, small, ["k"], hot=hot)
        at = out.where("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).agg(
            F.count(F.lit(1)).alias("rows"), F.max("n").alias("n")).collect()
        assert {r["n"] for r in at} == {3000}
        return sorted(r["rows"] for r in at)
    assert most(None) == [3000]
    rows = most(heavy_keys(df, {"k": ["k"]}, tasks=24)["k"])
    assert sum(rows) == 3000 and len(rows) >= 4 and rows[-1] <= 1500


def test_types_must_agree(spark):
    df, small = spark.range(3).select("id"), spark.createDataFrame([(1, 2)], "id int, v int")
    with pytest.raises(TypeError):
        lookup_join(df, small, ["id"], hot={1: 2})


def test_star_with_every_key_cut(spark, skewed_dir, monkeypatch, no_aqe):  # noqa: F811
    """The star of the skewed tables is the same with each join's hot keys cut into pieces and with none."""
    from tillsight import warehouse
    from tillsight.operators import star

    cfg, raw = warehouse.testdata_config(spark, skewed_dir), warehouse.raw(spark, skewed_dir)
    found = {}

    def finer(df, joins):
        found.update(heavy_keys(df.repartition(8), joins, tasks=200))
        return found

    rows = lambda: sorted(map(tuple, star.build_star(raw, cfg).fact_sales.collect()), key=repr)
    monkeypatch.setattr(star, "heavy_keys", finer)
    cut = rows()
    assert found["invoice"] and found["customer"]
    monkeypatch.setattr(star, "heavy_keys", lambda df, joins: {})
    assert rows() == cut
