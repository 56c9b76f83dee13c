"""Raw invoice-line sources (X1, X2 lives in operators.quality, X3, X4, U2).

Columns are found by header name, as the source spells them or as the library does. A line's place in its
part (``line_no``) is taken from the source where it has such a column. Otherwise the lines of its files, in the
natural order of their paths, are numbered 0..n-1 from the file source's metadata (``line_order``): the
same numbers for any split size, task count or retry.
``part_no`` numbers the parts in the order given, so "first" means first in (part_no, line_no).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.schemas import RAW_COLUMNS, RAW_TRANSACTIONS, SOURCE_HEADERS
from tillsight.sources.line_order import with_line_number
from tillsight.sources.sinks import checked_write


def read_part(spark: SparkSession, path: str, fmt: str = "parquet", options: Mapping | None = None) -> DataFrame:
    """Read one part and give it the fixed raw schema (X4: ids as strings, timestamp parsed). A value
    that does not fit its column's type is an error, not a silent null."""
    reader = spark.read
    if fmt == "csv":       # every field as text; the casts below are strict
        reader = reader.option("header", "true").option("mode", "FAILFAST")
    df = reader.options(**(options or {})).format(fmt).load(path)
    if not any(c.strip().lower() == "line_no" for c in df.columns):
        df = with_line_number(df, fmt)
    return normalise(df)


def normalise(df: DataFrame) -> DataFrame:
    """Columns by name (the source's headers or the library's own), cast to the raw schema. A frame that was not
    read from files and has no ``line_no`` gets the rows' positions as Spark hands them out."""
    own = {SOURCE_HEADERS.get(c.strip().lower(), c.strip().lower()): c for c in df.columns}
    missing = [c for c in RAW_COLUMNS if c not in own and c != "line_no"]
    if missing:
        raise ValueError(f"columns not found: {', '.join(missing)}; there are {', '.join(df.columns)}")
    out = []
    for f in RAW_TRANSACTIONS.fields:
        if f.name == "line_no" and "line_no" not in own:
            col = F.monotonically_increasing_id()
        else:
            col = F.col(f"`{own[f.name]}`").cast(f.dataType)       # ANSI: a bad value fails the query
        out.append(col.alias(f.name))
    return df.select(*out).withColumn("customer_id", canonical_id("customer_id"))


def canonical_id(c: str):
    """A customer id exported through a float column reads ``13085.0``; the canonical id is
    the integer text."""
    return F.regexp_replace(F.col(c), r"^(\d+)\.0+$", "$1")


def union_parts(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Concatenate parts in the order given, each tagged with its origin in ``source`` (the
    reference's sheet) and its number in ``part_no``."""
    out = None
    for i, (name, df) in enumerate(parts.items()):
        tagged = df.select(*RAW_COLUMNS).withColumns({"source": F.lit(name), "part_no": F.lit(i)})
        out = tagged if out is None else out.unionByName(tagged)
    if out is None:
        raise ValueError("no parts given")
    return out


def read_transactions(spark: SparkSession, parts: Mapping[str, str], fmt: str = "parquet",
                      options: Mapping | None = None) -> DataFrame:
    """Read N parts (e.g. yearly files), tag each with its name and number, concatenate."""
    return union_parts({name: read_part(spark, path, fmt, options) for name, path in parts.items()})


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Persist a table (full replace)."""
    checked_write(df, path, fmt, partition_by)
