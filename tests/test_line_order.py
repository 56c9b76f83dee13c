"""Line numbers of parts of several files."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tillsight.operators.clean import clean
from tillsight.sources import line_order
from tillsight.sources.raw import read_transactions

COLUMNS = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"]
SCHEMA = ("Invoice string, StockCode string, Description string, Quantity int, InvoiceDate string, Price string, "
          "`Customer ID` string, Country string")


def lines(n=1500, seed=3):
    """Many copies of (invoice, code, customer), told apart by their quantity."""
    rnd = random.Random(seed)
    return [(str(rnd.randint(1, 40)), f"S{rnd.randint(1, 5)}", "MUG", i + 1, "2010-12-01 08:26:00", "2.5", str(rnd.randint(1, 3)), "Spain")
            for i in range(n)]


def first_of(rows):
    out = {}
    for i, r in enumerate(rows):
        out.setdefault((r[0], r[1], r[6]), (i, r[3]))
    return out


def write(spark, rows, fmt, cuts):
    """Files whose names must be read as numbers: part-2 before part-10 before part-100000."""
    d = tempfile.mkdtemp(prefix="tillsight-files-")
    names = [1, 2, 10, 99999, 100000][:len(cuts) + 1]
    for name, a, b in zip(names, [0, *cuts], [*cuts, len(rows)], strict=True):
        if fmt == "csv":
            with open(f"{d}/part-{name}.csv", "w") as f:
                f.write(",".join(COLUMNS) + "\n" + "".join(",".join(map(str, r)) + "\n" for r in rows[a:b]))
        else:
            import pyarrow as pa
            import pyarrow.parquet as pq
            data = {c: [r[i] for r in rows[a:b]] for i, c in enumerate(COLUMNS)}
            pq.write_table(pa.table(data), f"{d}/part-{name}.parquet", row_group_size=40)
    return d


@pytest.fixture
def conf(spark):
    old = {}

    def put(**values):
        for k, v in values.items():
            k = k.replace("__", ".")
            old.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)
    yield put
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
@pytest.mark.parametrize("split", ["2k", "128m"])
@pytest.mark.parametrize("partitions", ["1", "3", "64"])
def test_five_files_keep_the_rows_that_one_file_keeps(spark, conf, fmt, split, partitions):
    rows = lines()
    conf(spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="1k", spark__sql__shuffle__partitions=partitions)
    several = write(spark, rows, fmt, [100, 101, 700, 1200])
    raw = read_transactions(spark, {"p": several}, fmt=fmt)
    got = {r.line_no: r.quantity for r in raw.select("line_no", "quantity").collect()}
    assert got == {i: i + 1 for i in range(len(rows))}           # dense, in file order
    kept = {(r.invoice, r.stock_code, r.customer_id): (r.line_no, r.quantity) for r in clean(raw).collect()}
    assert kept == first_of(rows)
    one = clean(read_transactions(spark, {"p": write(spark, rows, fmt, [])}, fmt=fmt))
    assert {(r.invoice, r.stock_code, r.customer_id): (r.line_no, r.quantity) for r in one.collect()} == kept


def test_a_filter_does_not_renumber(spark):
    rows = lines()
    raw = read_transactions(spark, {"p": write(spark, rows, "parquet", [500])})
    got = raw.where("quantity > 1400").select("line_no", "quantity").collect()
    assert sorted(tuple(r) for r in got) == [(i, i + 1) for i in range(1400, 1500)]


def test_many_files_are_joined_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(line_order, "BROADCAST_FILES", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = read_transactions(spark, {"p": write(spark, lines(), "parquet", [500, 600])})
        assert "BroadcastHashJoin" not in raw._jdf.queryExecution().executedPlan().toString()
        assert raw.where("line_no <> quantity - 1").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_files_and_own_numbers(spark):
    rows = lines(20)
    d = write(spark, rows, "csv", [0, 7, 7])
    raw = read_transactions(spark, {"p": d}, fmt="csv")
    assert sorted(r.line_no for r in raw.collect()) == list(range(20))
    own = spark.createDataFrame([(*r, 100 - i) for i, r in enumerate(rows)], SCHEMA + ", line_no long")
    path = tempfile.mkdtemp(prefix="tillsight-own-") + "/t"
    own.write.parquet(path)
    assert sorted(r.line_no for r in read_transactions(spark, {"p": path}).collect()) == list(range(81, 101))


def test_natural_order_of_paths(spark):
    paths = ["f/part-10", "f/part-9", "f/part-100000", "f/part-99999", "e/part-1", "f/part-2-c010", "f/part-2-c9", "f/part-002-c1"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r.p for r in df.orderBy(line_order.natural(F.col("p"))).collect()]
    assert got == ["e/part-1", "f/part-002-c1", "f/part-2-c9", "f/part-2-c010", "f/part-9", "f/part-10", "f/part-99999", "f/part-100000"]
