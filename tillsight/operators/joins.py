"""Joins of the line table with per-key tables, hot keys split.

One plan: an equi-join on shuffled keys, small enough sides broadcast by their measured size. The small side has at
most one row per key, so a hot key can be cut into pieces that each meet a copy of the same single row.

``heavy_keys`` finds the hot keys itself, with a heavy-hitter sketch (``approx_top_k``, merged map-side, of bounded size) in
one pass for any number of joins. A key is hot if it holds more than one task's even share of the rows, so
there are fewer hot keys than tasks, and their pieces add up to at most twice the tasks. ``lookup_join`` deals a hot
key's rows to its pieces by the input partition they come from (the same for a task that is run again) and
repeats only the hot keys' rows of the small side, once a piece. Which keys are called hot changes
how rows are spread, never the result. Adaptive execution, where it is on, may cut further.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRACKED = 10_000            # keys a sketch follows at least
MOST_TRACKED = 1_000_000    # and at most: the function's own bound

ROWS_A_TASK = 2_000_000     # lines that one task sorts at most, as a mean

Hot = Mapping[int, int]     # hash of a key -> pieces it is cut into


def row_tasks(df: DataFrame, rows: int | None = None) -> int:
    """How many tasks give each at most ``rows`` rows of ``df``, as a mean. Counts ``df``: of a written table, that reads the
    files' footers."""
    return -(-df.count() // (rows or ROWS_A_TASK))


def tasks_for(df: DataFrame, rows: int | None = None) -> int | None:
    """Partitions for a shuffle of ``df`` that sorts its rows, where the session's number is fewer than ``row_tasks``; else None."""
    need = row_tasks(df, rows)
    return need if need > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def key_hash(keys: Sequence[str | Column]) -> Column:
    return F.xxhash64(*keys)


def heavy_keys(df: DataFrame, joins: Mapping[str, Sequence[str | Column]], tasks: int | None = None) -> dict[str, Hot]:
    """The hot keys of every named key of ``df``, with their pieces: one pass that reads only the key columns.
    What comes back is at most ``tasks`` hashes a name. ``tasks`` defaults to the shuffle partitions."""
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = min(MOST_TRACKED, max(TRACKED, 16 * tasks))
    names = list(joins)
    hashed = df.select(*[key_hash(joins[n]).alias(f"_h{i}") for i, n in enumerate(names)])
    row = hashed.agg(F.count(F.lit(1)).alias("_n"), *[
        F.expr(f"approx_top_k(_h{i}, {min(tasks, tracked)}, {tracked})").alias(f"_t{i}") for i in range(len(names))]).first()
    share = max(1, row["_n"] // tasks)
    return {n: {t["item"]: min(tasks, -(-t["count"] // share)) for t in row[f"_t{i}"] if t["count"] > share}
            for i, n in enumerate(names)}


def lookup_join(big: DataFrame, small: DataFrame, keys: Sequence[str], small_keys: Sequence[str] | None = None,
                how: str = "left", null_safe: bool = False, hot: Hot | None = None) -> DataFrame:
    """``big`` joined to ``small`` (at most one row per key) on ``keys`` = ``small_keys``, which name
    the key columns on the small side (default: the same names) and are dropped from the result. ``how`` is left or
    inner; ``hot`` are the keys to cut, as ``heavy_keys`` returns them."""
    small_keys = list(small_keys or keys)
    renamed = [f"_sk_{i}" for i in range(len(keys))]
    sm = small.select(*[F.col(k).alias(r) for k, r in zip(small_keys, renamed)],
                      *[c for c in small.columns if c not in small_keys])
    if hot:
        kinds = [(big.schema[a].dataType, sm.schema[b].dataType) for a, b in zip(keys, renamed)]
        if any(a != b or isinstance(a, T.FractionalType) and not isinstance(a, T.DecimalType) for a, b in kinds):
            raise TypeError("hot keys are known by their hash: both sides need one type, and not a floating one")
        big, sm = with_pieces(big, sm, keys, renamed, hot)
    cond = reduce(lambda x, y: x & y, [big[a].eqNullSafe(sm[b]) if null_safe else big[a] == sm[b]
                                       for a, b in zip(keys, renamed)])
    if hot:
        cond = cond & (big["_piece"] == sm["_sk_piece"])
    return big.join(sm, cond, how).drop(*renamed, "_piece", "_sk_piece")


def with_pieces(big: DataFrame, sm: DataFrame, keys: Sequence[str], small_keys: Sequence[str],
                hot: Hot) -> tuple[DataFrame, DataFrame]:
    """``big`` with each row's ``_piece`` of its key, and ``sm`` with a row for every ``_sk_piece``; 0 where not hot."""
    table = big.sparkSession.createDataFrame(list(hot.items()), "_hot bigint, _pieces int")
    pieces = F.broadcast(table)       # fewer rows than tasks
    dealt = big.withColumn("_hash", key_hash(keys)).join(pieces, F.col("_hash") == F.col("_hot"), "left")
    dealt = dealt.withColumn("_piece", F.when(F.col("_pieces").isNull(), 0).otherwise(
        F.pmod(F.spark_partition_id(), F.col("_pieces")))).drop("_hash", "_hot", "_pieces")
    repeated = sm.withColumn("_hash", key_hash(small_keys)).join(pieces, F.col("_hash") == F.col("_hot"), "left")
    repeated = repeated.withColumn("_sk_piece", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)))
    return dealt, repeated.drop("_hash", "_hot", "_pieces")
