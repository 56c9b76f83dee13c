"""Line numbers of a part that consists of several files.

Spark promises no order across the files of a scan, so a line's place comes from the file source's own
metadata: files in the natural order of their paths (digits by value, so ``part-100000`` follows
``part-99999``), and inside a file

* Parquet: ``_metadata.row_index``, which neither splits nor filters change;
* other formats (CSV): the split's start, ``_metadata.file_block_start``, and the row's place in the split,
  which is how far ``monotonically_increasing_id`` has come since the split's first row. A split is read from
  its start to its end by one task, whatever shares the task with it.

A small aggregate of the same scan gives the rows of every file (of every split), their running sum is the
offset, and offset + place is a dense number 0..n-1 that does not depend on split sizes, task counts or
the order in which tasks run. The offsets have one row a file or split, entries that the driver lists
anyway to plan the scan: they are broadcast up to ``BROADCAST_FILES`` of them and joined beyond that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_FILES = 100_000
_DIGITS = 20


def natural(path: Column) -> Column:
    """Sort key of a path: every run of digits padded to one width, the path itself for equal keys."""
    padded = F.regexp_replace(path, r"(\d+)", "0" * _DIGITS + "$1")
    return F.struct(F.regexp_replace(padded, rf"\d*(\d{{{_DIGITS}}})", "$1").alias("padded"), path.alias("path"))


def with_line_number(scan: DataFrame, fmt: str, name: str = "line_no") -> DataFrame:
    """``scan`` (as a file source reads it, unfiltered) with the dense number of every line."""
    place = F.col("_metadata.row_index") if fmt == "parquet" else None
    where = [F.col("_metadata.file_path").alias("_file"),
             (F.lit(0).cast("long") if place is not None else F.col("_metadata.file_block_start")).alias("_block")]
    own = F.monotonically_increasing_id() if place is None else place
    placed = scan.select("*", *where, own.alias("_place"))
    first = F.min("_place") if place is None else F.lit(0).cast("long")
    parts = scan.select(*where, own.alias("_place")).groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_rows"), first.alias("_first"))
    before = Window.orderBy(natural(F.col("_file")), "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(F.col("_file").alias("_of"), F.col("_block").alias("_ob"),
                           (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_offset"))
    if len(scan.inputFiles()) <= BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    met = placed.join(offsets, (F.col("_file") == F.col("_of")) & (F.col("_block") == F.col("_ob")))
    return met.select(*[F.col(f"`{c}`") for c in scan.columns], (F.col("_place") + F.col("_offset")).cast("long").alias(name))
