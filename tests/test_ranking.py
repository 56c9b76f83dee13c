import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillsight.operators.ranking import (ntile_of, placed, qcut_rank_bin, quantile_edges, sequence,
                                         top_rank)


def _frame(spark, n, n_vals, n_groups, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.randint(0, n_groups - 1), rnd.randint(0, n_vals), round(rnd.random() * 100, 2))
            for i in range(n)]
    return spark.createDataFrame(rows, "id long, g int, v int, x double").withColumn(
        "x", F.col("x").cast("decimal(18,2)"))


@pytest.mark.parametrize("n_vals,parts", [(5, 4), (2000, 7), (0, 3)])
def test_global_sequence_matches_window(spark, n_vals, parts):
    df = _frame(spark, 3000, n_vals, 1, 1)
    got = sequence(df, [("v", False), ("id", True)], rank="rk", rank_on=["v"],
                   running={"cum": "x"}, num_partitions=parts, with_total="n")
    w = Window.orderBy(F.col("v").desc(), F.col("id"))
    exp = df.select("id", F.row_number().over(w).alias("rn2"),
                    F.rank().over(Window.orderBy(F.col("v").desc())).alias("rk2"),
                    F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum2"))
    j = got.join(exp, "id")
    bad = j.where((F.col("rn") != F.col("rn2")) | (F.col("rk") != F.col("rk2")) | (F.col("cum") != F.col("cum2")))
    assert j.count() == 3000
    assert bad.count() == 0
    assert got.select("n").first()[0] == 3000


def test_grouped_sequence_with_hot_group(spark):
    df = _frame(spark, 4000, 50, 3, 2)
    # make group 0 hold most rows
    df = df.withColumn("g", F.when(F.col("id") % 5 != 0, F.lit(0)).otherwise(F.col("g")))
    got = sequence(df, [("v", True), ("id", True)], by=["g"], rank="rk", rank_on=["v"],
                   running={"cum": "x"}, num_partitions=6)
    w = Window.partitionBy("g").orderBy("v", "id")
    exp = df.select("id", F.row_number().over(w).alias("rn2"),
                    F.rank().over(Window.partitionBy("g").orderBy("v")).alias("rk2"),
                    F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum2"))
    j = got.join(exp, "id")
    assert j.where((F.col("rn") != F.col("rn2")) | (F.col("rk") != F.col("rk2"))
                   | (F.col("cum") != F.col("cum2"))).count() == 0


@pytest.mark.parametrize("n", [1, 3, 5, 7, 13, 100])
def test_ntile_and_qcut(spark, n):
    import pandas as pd

    df = spark.range(1, n + 1).withColumnRenamed("id", "rn").withColumn("n", F.lit(n))
    rows = df.select("rn", ntile_of("rn", "n", 5).alias("t"), qcut_rank_bin("rn", "n", 5).alias("b"),
                     F.ntile(5).over(Window.orderBy("rn")).alias("t2")).orderBy("rn").collect()
    assert [r.t for r in rows] == [r.t2 for r in rows]
    if n >= 5:
        exp = pd.qcut(pd.Series(range(1, n + 1)), 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
        assert [r.b for r in rows] == exp


def test_qcut_known_sizes(spark):
    df = spark.range(1, 8).withColumnRenamed("id", "rn")
    got = [r.b for r in df.select(qcut_rank_bin("rn", F.lit(7), 5).alias("b")).orderBy("rn").collect()]
    assert got == [1, 1, 2, 3, 4, 5, 5]


def test_exact_quantiles(spark):
    import numpy as np

    rnd = random.Random(3)
    vals = [rnd.randint(0, 400) for _ in range(997)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v long")
    got = quantile_edges(df, "v", [(1, 5), (2, 5), (3, 5), (4, 5), (3, 4)], num_partitions=5).first()["edges"]
    exp = np.quantile(np.array(vals, dtype=float), [0.2, 0.4, 0.6, 0.8, 0.75])
    assert np.allclose(got, exp)


def test_top_rank_includes_ties(spark):
    rows = [(i, 100 if i < 30 else i) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, v long")
    got = top_rank(df, "v", 20, "rk")
    exp = df.withColumn("rk", F.rank().over(Window.orderBy(F.col("v").desc()))).where("rk <= 20")
    assert sorted(map(tuple, got.select("id", "rk").collect())) == sorted(map(tuple, exp.select("id", "rk").collect()))


def test_quantiles_of_no_value_and_one_value(spark):
    df = spark.createDataFrame([(1, None)], "id long, v long")
    assert quantile_edges(df, "v", [(1, 2)]).first()["edges"] is None
    one = spark.createDataFrame([(1, 7)], "id long, v long")
    assert quantile_edges(one, "v", [(0, 5), (2, 5), (5, 5)]).first()["edges"] == [7.0, 7.0, 7.0]


def test_dropped_edges_equal_pandas(spark):
    import pandas as pd

    from tillsight.operators.ranking import quantile_bins

    for vals in ([0, 0, 0, 0, 1, 2, 3, 4, 5, 6], [1, 1, 1, 1, 1, 1, 2, 3], [5, 5, 5, 5, 9], [1, 2, 2, 2, 2, 2, 2, 3, 3, 3]):
        df = spark.createDataFrame(list(enumerate(vals)), "id long, v long")
        got = quantile_bins(df, "v", 5, "b", "id", on_duplicate_edges="drop").orderBy("id").toPandas()["b"].tolist()
        assert got == (pd.qcut(pd.Series(vals), 5, labels=False, duplicates="drop") + 1).tolist(), vals


def test_row_numbers_need_one_exchange(spark):
    df = _frame(spark, 100, 10, 1, 1)
    plan = placed(df, [("v", True), ("id", True)], 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan


def test_many_partitions_and_heavy_ties(spark):
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("v"), (F.col("id") % 2).alias("g"))
    for by in ([], ["g"]):
        got = sequence(df, [("v", False), ("id", True)], by=by, rank="rk", rank_on=["v"], num_partitions=2000)
        w = Window.partitionBy(*by).orderBy(F.col("v").desc())
        exp = df.select("id", F.rank().over(w).alias("rk2"), F.row_number().over(w.orderBy(F.col("v").desc(), "id")).alias("rn2"))
        j = got.join(exp, "id")
        assert j.count() == 3000 and j.where("rk <> rk2 or rn <> rn2").count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_global_fast_path_matches_window(spark, parts):
    df = _frame(spark, 2500, 30, 1, 9)
    got = sequence(df, [("v", True), ("id", True)], running={"cum": "x"}, num_partitions=parts, with_total="n")
    w = Window.orderBy("v", "id")
    exp = df.select("id", F.row_number().over(w).alias("rn2"),
                    F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum2"))
    j = got.join(exp, "id")
    assert j.where((F.col("rn") != F.col("rn2")) | (F.col("cum") != F.col("cum2"))).count() == 0
    assert got.select("n").distinct().collect()[0][0] == 2500


def test_grouped_sequence_with_null_groups(spark):
    df = _frame(spark, 3000, 40, 4, 11)
    df = df.withColumn("g", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("g")))
    got = sequence(df, [("v", False), ("id", True)], by=["g"], rank="rk", rank_on=["v"],
                   running={"cum": "x"}, num_partitions=7)
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), "id")
    exp = df.select("id", F.row_number().over(w).alias("rn2"),
                    F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc())).alias("rk2"),
                    F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum2"))
    j = got.join(exp, "id")
    assert j.count() == 3000
    assert j.where((F.col("rn") != F.col("rn2")) | (F.col("rk") != F.col("rk2"))
                   | (F.col("cum") != F.col("cum2"))).count() == 0


@pytest.mark.parametrize("method", ["value", "first"])
def test_quantile_bins_match_pandas_qcut(spark, method):
    import pandas as pd

    from tillsight.operators.ranking import quantile_bins

    rnd = random.Random(5)
    vals = [rnd.randint(0, 50) + rnd.random() for _ in range(333)] if method == "value" else \
        [float(rnd.randint(0, 9)) for _ in range(333)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    got = quantile_bins(df, "v", 4, "b", "id", method=method).orderBy("id").toPandas()["b"].tolist()
    s = pd.Series(vals)
    exp = pd.qcut(s if method == "value" else s.rank(method="first"), 4, labels=[1, 2, 3, 4]).astype(int).tolist()
    assert got == exp
