"""Helpers shared by the operators of this subpackage.

Python stages work on Arrow record batches: the text column arrives as UTF-8 bytes (`cast
binary`), is cut into chunks of a bounded number of bytes, and words are found with numpy on the
whole chunk. A chunk never splits a text, so every text is processed whole.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tillsight.session import scratch_path

CHUNK_BYTES = 4 << 20

#: Fixed: white space of the word pattern `[^\x20\x09-\x0D]+`.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns that an operator is about to make: its results replace them."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


BROADCAST_ROWS = 10_000


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` marked so that a join with it shuffles both sides, whatever Spark takes their sizes for: rows that
    an explode makes are not in its estimate, nor is what a Parquet file holds unpacked, and a broadcast of them
    is gathered in the driver."""
    return df.hint("merge")


def if_small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it has at most BROADCAST_ROWS rows, else to be shuffled, as is what joins with
    it. ``df`` should be cheap to count."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else shuffled(df)


HOT_SHARE = 1024


def meet(rows: DataFrame, side: DataFrame, keys: list[str], count: str) -> DataFrame:
    """``rows`` left-joined with ``side``, which has one row a key and how many rows have it (``count``, dropped).

    A key of more than a `HOT_SHARE`-th of all rows is hot: there are fewer than `HOT_SHARE` of them, so
    their side is broadcast, and their rows take part in the shuffled join under keys of their own, spread
    over all tasks. ``rows`` and ``side`` are read several times and should be stored tables. Null keys meet
    nothing."""
    values = [c for c in side.columns if c not in (*keys, count)]
    bar = rows.count() // HOT_SHARE
    renamed = side.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                          *[F.col(c).alias(f"_v{i}") for i, c in enumerate(values)], F.col(count).alias("_n"))
    hot = renamed.where(F.col("_n") > bar).withColumnRenamed("_n", "_hot")
    hot = hot.select(*[F.col(f"_k{i}").alias(f"_h{i}") for i in range(len(keys))],
                     *[F.col(f"_v{i}").alias(f"_w{i}") for i in range(len(values))], "_hot")
    cold = renamed.where(F.col("_n") <= bar).withColumn("_own", F.lit(0).cast("long")).drop("_n")
    on_hot = [F.col(k) == F.col(f"_h{i}") for i, k in enumerate(keys)]
    out = rows.join(F.broadcast(hot), on_hot, "left")
    lost = F.col("_hot").isNotNull()
    for k in keys:
        lost = lost | F.col(k).isNull()
    out = out.withColumn("_row", F.when(lost, F.monotonically_increasing_id() + 1).otherwise(F.lit(0).cast("long")))
    on_cold = [*[F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.col("_row") == F.col("_own")]
    out = out.join(cold, on_cold, "left")
    return out.select(*[F.col(f"`{c}`") for c in rows.columns],
                      *[F.coalesce(F.col(f"_w{i}"), F.col(f"_v{i}")).alias(c) for i, c in enumerate(values)])


def ship(spark: SparkSession) -> None:
    """Send this package's code to the Python workers once a session (SparkContext.addPyFile), so that
    executors need not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_tillsight_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    path = os.path.join(tempfile.mkdtemp(prefix="tillsight-code-"), "tillsight_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), root))
    sc.addPyFile(path)
    sc._tillsight_shipped = True


def in_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """mapInArrow with this package's code at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def stored(df: DataFrame, name: str = "llm") -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: work is cut here once, and a
    lost executor re-reads the table instead of doing it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Give disk back between two steps: delete ``tables`` (of `stored`, read by nothing any more), and let Spark
    delete the shuffle files of queries that are over, which otherwise lie until the driver happens to collect
    its garbage. The listeners hold the last query until another one has run."""
    spark.range(1).count()
    jvm, conf = spark.sparkContext._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(t._stored_at)
        path.getFileSystem(conf).delete(path, True)
    jvm.System.gc()


def chunks(batches: Iterator[pa.RecordBatch], column: int,
           limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice hold about ``limit`` bytes (one text at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, ends = buffers(batch.column(column))
        cut, part = [0], 0
        while cut[-1] < batch.num_rows:
            part = int(np.searchsorted(ends, ends[cut[-1]] + limit, "right")) - 1
            cut.append(min(batch.num_rows, max(part, cut[-1] + 1)))
        for a, b in zip(cut, cut[1:], strict=False):
            yield batch.slice(a, b - a)


def as_bytes(col: pa.Array) -> pa.Array:
    """A string column as the binary column of its bytes: the same buffers, unchecked. Other columns as they are."""
    if pa.types.is_string(col.type):
        return col.view(pa.binary())
    return col.view(pa.large_binary()) if pa.types.is_large_string(col.type) else col


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary or string column; nulls are empty."""
    col = as_bytes(col)
    if col.null_count:
        col = col.fill_null(b"")
    kind = np.int64 if pa.types.is_large_binary(col.type) else np.int32
    _, at, data = col.buffers()
    offs = np.frombuffer(at, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word; words end at text boundaries."""
    n = len(buf)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    word = ~IS_SPACE[buf]
    fresh = np.zeros(n + 1, bool)          # a text begins here (or all ends)
    fresh[offs] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    start = np.flatnonzero(word & (~before | fresh[:-1]))
    end = np.flatnonzero(word & (~after | fresh[1:])) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


def append_columns(df: DataFrame, text: str, new: list[tuple[str, str]],
                   work: Callable[[pa.Array], list[pa.Array]], limit: int = CHUNK_BYTES) -> DataFrame:
    """``df`` with columns ``new`` (name, SQL type) made by ``work`` from the text's bytes, chunk by
    chunk in the tasks that read the rows (no shuffle). ``df``'s other columns pass through; one that
    has the name of a new column is replaced by it. Texts are sent to the workers once: strings as they
    are, their bytes being read in place; only a column of another type gets a binary copy beside it."""
    df = without(df, [n for n, _ in new])
    width, fed = len(df.columns), df
    at = df.columns.index(text) if text in df.columns else [c.lower() for c in df.columns].index(text.lower())
    if not isinstance(df.schema.fields[at].dataType, (StringType, BinaryType)):
        at, fed = width, df.withColumn(free_name(df, "text_bytes"), F.col(f"`{text}`").cast("binary"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + "".join(
        f", `{n}` {t}" for n, t in new)
    names = [*df.columns, *(n for n, _ in new)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, at, limit):
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *work(as_bytes(batch.column(at)))], names=names)

    return in_arrow(fed, run, schema)


def per_text(sums: np.ndarray, texts: np.ndarray, n: int) -> np.ndarray:
    """Sum ``sums`` (one a word) by text number."""
    return np.bincount(texts, weights=sums, minlength=n)
