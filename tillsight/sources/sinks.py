"""Star sinks (X5, X6, X7) and the star reader.

A save writes a whole new version of the star into a folder of its own, dimensions before the fact, and then
swaps one small manifest file that names it. Readers resolve the manifest once and read that version's
folders, so a reader sees one version's tables whatever a later save does, and a save that fails leaves the
version before it published. A save keeps the version before and removes older ones.

The fact's primary key ``sale_id`` is given in the clustered write from the row's range partition and its place
in it, so it costs no shuffle. It is unique, grows in clustering order and is not dense (an auto-increment
does not promise that either). Rows are sorted by all their columns, so a task that is run again numbers its
rows as before. ``created_at`` is one time for all rows of a save.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.schemas import STAR_TABLES

# Dimensions before the fact, as the reference loads them (foreign keys point at dimensions). The order
# grain comes last and is replaced with the fact, so the two never disagree.
# The bitmaps of its keys follow where they can be stored: numbered customers, and a format with binary columns.
ORDER_BITS = "order_bits"
LOAD_ORDER = [*STAR_TABLES, "fact_orders", ORDER_BITS]


AUDIT = "created_at"
SALE_ID = "sale_id"
POINT_KEYS = ["customer_key", "product_key"]     # equality on these is answered by Bloom filters
MANIFEST = "manifest.json"      # readable by Spark: no underscore in front


def cluster_fact(fact: DataFrame, num_partitions: int | None = None, late: Mapping[str, Column] | None = None) -> DataFrame:
    """Range-partition by (date_key, customer_key) and sort within each file, so Parquet min/max
    statistics prune date predicates (the warehouse's CLUSTER BY); ``key_filters`` prune by customer and product. Invoice and product follow as range
    keys, so one customer's busy day can be split as well; the other columns only settle the order of ties. ``late`` are
    columns that follow from the row's others: they are derived behind the exchange instead of travelling with it."""
    n = num_partitions or int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["date_key", "customer_key", "invoice_id", "product_key"]
    late = {c: e for c, e in (late or {}).items() if c in fact.columns}
    own = [c for c in fact.columns if c not in late]
    placed = fact.select(*own).repartitionByRange(n, *keys).sortWithinPartitions(*keys, *[c for c in own if c not in keys])
    return placed.withColumns(late).select(*fact.columns) if late else placed


def with_sale_id(fact: DataFrame) -> DataFrame:
    """The fact's primary key in front: unique, growing along the rows of a task and from task to task."""
    rest = [c for c in fact.columns if c != SALE_ID]
    return fact.select((F.monotonically_increasing_id() + 1).alias(SALE_ID), *rest)


def key_filters(columns: Sequence[str]) -> dict[str, str]:
    """X7's second key: Parquet write options for a Bloom filter of each column in every row group, sized by the
    values it holds (up to the format's limit of 1 MB). Min/max statistics of these columns span nearly all
    keys within a date range, so an equality on one of them is answered by its filter, or by its
    dictionary where the column has one throughout."""
    return {"parquet.bloom.filter.adaptive.enabled": "true",
            **{f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}}


def checked_write(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                  max_records_per_file: int | None = None, options: Mapping[str, str] | None = None) -> int:
    """Write (full replace), read back and compare the row counts; returns the count."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").format(fmt).options(**(options or {}))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(path)
    reader = df.sparkSession.read.schema(df.schema)
    written, found = seen.get["n"], (reader.option("header", "true") if fmt == "csv" else reader).format(fmt).load(path).count()
    if written != found:
        raise RuntimeError(f"{path}: {written} rows written, {found} read back")
    return written


def save_star(tables: Mapping[str, DataFrame], path: str, fmt: str = "parquet", partition_fact_by_month: bool = False,
              cluster: bool = True, max_records_per_file: int | None = None, snapshot: str | None = None,
              created_at: dt.datetime | None = None, keep: int = 2,
              fact_partitions: int | None = None, late: Mapping[str, Column] | None = None) -> dict[str, str]:
    """X5 + X6: write a new version of the star, dimensions first, with its counts checked after the write, and publish
    it by swapping the manifest; returns the tables' folders. Re-runnable: every save is a full replace. The order
    grain is aggregated from the fact as written; ``snapshot`` goes into the manifest. CSV files have a header, and
    the manifest holds every table's schema for reading them back. ``keep`` versions stay, this one included.
    ``fact_partitions`` and ``late`` go to ``cluster_fact``."""
    from tillsight.operators.distinct import dense, order_bitmaps, with_order_no
    from tillsight.operators.star import order_grain

    path = path.rstrip("/")
    spark = next(iter(tables.values())).sparkSession
    now = created_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    version = f"v{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    out, schemas, counts = {}, {}, {}
    for name in LOAD_ORDER:
        target, part = f"{path}/{version}/{name}", None
        if name == "fact_orders":
            df = with_order_no(order_grain(_read(spark, out["fact_sales"], schemas["fact_sales"], fmt)))
        elif name == ORDER_BITS:
            if fmt == "csv" or not dense(_read(spark, out["dim_customer"], schemas["dim_customer"], fmt), "customer_key"):
                continue
            df = order_bitmaps(_read(spark, out["fact_orders"], schemas["fact_orders"], fmt))
        else:
            df = tables[name].drop(AUDIT)
        if name == "fact_sales":
            df = df.drop(SALE_ID)
            df = with_sale_id(cluster_fact(df, fact_partitions, late) if cluster else df)
            if partition_fact_by_month:
                df = df.withColumn("year_month", F.floor(F.col("date_key") / 100).cast("int"))
                part = ["year_month"]
        if name in STAR_TABLES:
            df = df.withColumn(AUDIT, F.lit(now).cast("timestamp_ntz"))
        points = [c for c in POINT_KEYS if c in df.columns] if name in ("fact_sales", "fact_orders") and fmt == "parquet" else []
        options = {**(key_filters(points) if points else {}), **({"compression": "zstd"} if fmt == "parquet" else {})}
        counts[name] = checked_write(df, target, fmt, part, max_records_per_file, options)
        out[name], schemas[name] = target, json.loads(df.drop("year_month").schema.json())
    before = manifest(spark, path)
    _put(spark, f"{path}/{MANIFEST}", json.dumps({
        "version": version, "format": fmt, "tables": list(out), "schemas": schemas, "counts": counts, "snapshot": snapshot,
        "created_at": now.isoformat(), "kept": [version, *(before["kept"] if before else [])][:keep]}))
    for old in (before["kept"] if before else [])[keep - 1:]:
        _delete(spark, f"{path}/{old}")
    return out


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The published version's manifest, or None where nothing has been published."""
    target = f"{path.rstrip('/')}/{MANIFEST}"
    return json.loads("".join(r.value for r in spark.read.text(target, wholetext=True).collect())) if exists(spark, target) else None


def _read(spark: SparkSession, target: str, schema: dict, fmt: str) -> DataFrame:
    reader = spark.read
    if fmt == "csv":
        reader = reader.schema(T.StructType.fromJson(schema)).option("header", "true").option("mode", "FAILFAST")
    df = reader.format(fmt).load(target)
    return df.drop("year_month") if "year_month" in df.columns else df


def load_star(spark: SparkSession, path: str, fmt: str | None = None, version: str | None = None) -> dict[str, DataFrame]:
    """The tables of the published version (the marts' input), ``fact_orders`` among them. The manifest is read once,
    so all tables are of one version, also if another is published meanwhile. ``version`` names one that is
    still kept instead."""
    path = path.rstrip("/")
    m = manifest(spark, path)
    if m is None:
        raise FileNotFoundError(f"{path}: no star is published here")
    if fmt and fmt != m["format"]:
        raise ValueError(f"{path}: the star is saved as {m['format']}, not {fmt}")
    if version and version not in m["kept"]:
        raise ValueError(f"{path}: version {version} is not kept; there are {', '.join(m['kept'])}")
    return {name: _read(spark, f"{path}/{version or m['version']}/{name}", m["schemas"][name], m["format"]) for name in m["tables"]}


def saved_snapshot(spark: SparkSession, path: str) -> str | None:
    """The snapshot date that the published star was built with, if it was stored."""
    m = manifest(spark, path)
    return m["snapshot"] if m else None


def save_as_tables(tables: Mapping[str, DataFrame], database: str = "default", fmt: str = "parquet") -> list[str]:
    """X6 into the session's catalogue: a saved or built star as managed tables, dimensions first, counts checked."""
    out = []
    for name in [n for n in LOAD_ORDER if n in tables]:
        df, seen = tables[name], Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").format(fmt).saveAsTable(f"{database}.{name}")
        found = df.sparkSession.table(f"{database}.{name}").count()
        if found != seen.get["n"]:
            raise RuntimeError(f"{database}.{name}: {seen.get['n']} rows written, {found} read back")
        out.append(f"{database}.{name}")
    return out


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see the old or the new one whole: written aside, then renamed over it."""
    fs, target = _fs(spark, path)
    _, aside = _fs(spark, f"{path}.{uuid.uuid4().hex[:8]}.tmp")
    stream = fs.create(aside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(aside), fs.makeQualified(target), options)


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system the session reads."""
    fs, target = _fs(spark, path)
    return bool(fs.exists(target))
