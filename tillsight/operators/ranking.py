"""Ranking without a single partition.

Spark runs ``row_number().over(Window.orderBy(...))`` with no PARTITION BY in one task. That is
fine over a few hundred aggregated rows (months, regions) and wrong at customer or product
grain, and a window PARTITION BY customer puts a hot customer in one task. ``sequence`` computes
the same numbers in parallel:

1. ``repartitionByRange`` on (group keys, order keys): range bounds come from a sample, and the
   order keys include a unique tie-break, so even a group holding a third of all rows is split
   across partitions. The result is checkpointed: bounds come from sampling and must not be drawn
   twice.
2. A global row number (also behind NTILE, quantile bins and surrogate keys) needs no window: rows
   are sorted inside their range partition in the same stage, and ``monotonically_increasing_id``
   gives the partition (upper 31 bits) and the row's place in it (lower 33 bits). The rows of the
   earlier partitions, from a summary of one row per partition, are added.
3. Ranks, running sums and groups use the ordinary window functions within each range partition.
   Only a group that starts in an earlier partition needs a correction, and each partition has at
   most one such group (its first). The summary carries the offsets: what a partition's first
   group (or its first tie) has before it are the running sums, over the summary in partition
   order, of the partitions that end in that same group (or tie). Its size is bounded by the number of
   partitions, not by the data; it is never joined to itself.

Sums stay in DECIMAL, so a running sum does not depend on how the rows were split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.session import checkpoint_dir

Order = Sequence[tuple[str, bool]]   # (column, ascending); nulls always sort last


def _sort_exprs(order: Order) -> list[Column]:
    return [F.col(c).asc_nulls_last() if asc else F.col(c).desc_nulls_last() for c, asc in order]


def _struct(cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols]) if cols else F.struct(F.lit(0).alias("_"))


def sequence(df: DataFrame, order: Order, by: Sequence[str] = (), *, row_number: str | None = "rn",
             rank: str | None = None, rank_on: Sequence[str] | None = None,
             running: Mapping[str, str] | None = None, num_partitions: int | None = None,
             with_total: str | None = None) -> DataFrame:
    """Add, per group ``by`` (or globally), in the order ``order``:

    * ``row_number``: ROW_NUMBER(), 1-based;
    * ``rank``: RANK() where ties are equal values of ``rank_on`` (a prefix of ``order``);
    * ``running``: {out: col} → SUM(col) ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW;
    * ``with_total``: the number of rows (global form only), for NTILE and quantiles.

    ``order`` should end in a unique key so row numbers and running sums are deterministic.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    running = dict(running or {})
    by = list(by)
    if with_total and by:
        raise ValueError("with_total is only defined for the global form")
    if rank and not rank_on:
        raise ValueError("rank needs rank_on")
    rank_on = list(rank_on or [])
    order = list(order)
    if [c for c, _ in order[:len(rank_on)]] != rank_on:
        raise ValueError("rank_on must be a prefix of order")
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    sort = _sort_exprs(order)
    if not by and not rank_on and not running:
        return _numbered(placed(df, order, n).checkpoint(eager=True), row_number, with_total)
    ranged = df.repartitionByRange(n, *[F.col(c).asc_nulls_last() for c in by], *sort)
    ranged = ranged.withColumn("_pid", F.spark_partition_id())
    part = Window.partitionBy("_pid", *by)
    w = part.orderBy(*sort)
    # Same partitioning for every window here, so one exchange and one sort serve them all.
    local = (ranged.withColumn("_lrn", F.row_number().over(w))
                   .withColumn("_lcnt", F.count(F.lit(1)).over(part)))
    if rank_on:
        local = local.withColumn("_lrk", F.rank().over(part.orderBy(*_sort_exprs(order[:len(rank_on)]))))
    frame = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for out, src in running.items():
        local = local.withColumn(f"_lrs_{out}", F.sum(src).over(frame))
    local = local.checkpoint(eager=True)

    # Group key in range order (nulls last): a struct of (is null, value) per column.
    g = F.struct(*[F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")) for c in by]) if by else F.lit(0)
    ties = _struct(rank_on) if rank_on else None
    starts = local.where(F.col("_lrn") == 1)             # first row of each (partition, group)
    ends = local.where(F.col("_lrn") == F.col("_lcnt"))  # last row of each (partition, group)
    # One row per partition: its first group and tie, its row count, and its last group with that
    # group's local count, last tie and running sums.
    ends_fields = [F.col("_lcnt").alias("cnt_last"), *[F.col(f"_lrs_{o}").alias(f"sum_last_{o}") for o in running]]
    first_fields = [g.alias("g")]
    if rank_on:
        ends_fields += [(F.col("_lrn") - F.col("_lrk") + 1).alias("tie_cnt_last"), ties.alias("tie_last")]
        first_fields.append(ties.alias("tie"))
    bounds = starts.groupBy("_pid").agg(F.min(F.struct(*first_fields)).alias("_f"), F.sum("_lcnt").alias("_cnt"))
    last = ends.groupBy("_pid").agg(F.max(F.struct(g.alias("_lg"), *ends_fields)).alias("_l"))
    summary = bounds.join(last, "_pid").select("_pid", "_cnt", F.col("_f.g").alias("_fg"),
                                               *([F.col("_f.tie").alias("_tie_first")] if rank_on else []), "_l.*")
    line = Window.orderBy("_pid")
    so_far = Window.partitionBy("_lg").orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cums = [F.sum("cnt_last").over(so_far).alias("_c_off"),
            *[F.sum(f"sum_last_{o}").over(so_far).alias(f"_c_{o}") for o in running]]
    if rank_on:
        cums.append(F.sum("tie_cnt_last").over(Window.partitionBy("_lg", "tie_last").orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)).alias("_c_eq"))
    summary = summary.select("*", *cums)
    # The partition before ends in this one's first group, or that group begins here.
    goes_on = F.lag("_lg").over(line).eqNullSafe(F.col("_fg"))
    corr = [F.col("_pid"), F.col("_fg"), F.col("_cnt"), F.when(goes_on, F.lag("_c_off").over(line)).alias("_off"),
            *[F.when(goes_on, F.lag(f"_c_{o}").over(line)).alias(f"_soff_{o}") for o in running]]
    if rank_on:
        same_tie = goes_on & F.lag("tie_last").over(line).eqNullSafe(F.col("_tie_first"))
        corr += [F.col("_tie_first"), F.when(same_tie, F.lag("_c_eq").over(line)).alias("_eq")]
    corr = summary.select(*corr)
    if with_total:
        # The row count rides along in the summary: a sum over its one row per partition.
        corr = corr.withColumn(with_total, F.sum("_cnt").over(Window.partitionBy()).cast("long"))
    out = local.join(F.broadcast(corr), ["_pid"], "left")
    is_first = g.eqNullSafe(F.col("_fg"))
    off = F.when(is_first, F.coalesce(F.col("_off"), F.lit(0))).otherwise(F.lit(0))
    if row_number:
        out = out.withColumn(row_number, (F.col("_lrn") + off).cast("long"))
    if rank:
        eq = F.when(is_first & ties.eqNullSafe(F.col("_tie_first")), F.coalesce(F.col("_eq"), F.lit(0)))
        out = out.withColumn(rank, (F.col("_lrk") + off - F.coalesce(eq, F.lit(0))).cast("long"))
    for o in running:
        local_t = dict(local.dtypes)[f"_lrs_{o}"]
        soff = F.when(is_first, F.col(f"_soff_{o}"))
        out = out.withColumn(o, (F.col(f"_lrs_{o}") + F.coalesce(soff, F.lit(0))).cast(local_t))
    drop = ["_pid", "_lrn", "_lcnt", "_lrk", "_fg", "_cnt", "_off", "_eq", "_tie_first"] + \
           [f"_lrs_{o}" for o in running] + [f"_soff_{o}" for o in running]
    return out.drop(*[c for c in drop if c in out.columns])


_PLACE_BITS = 33       # documented layout of monotonically_increasing_id


def placed(df: DataFrame, order: Order, num_partitions: int) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, with ``_mid`` = partition and place: one
    exchange, one sort, no window."""
    sort = _sort_exprs(order)
    return (df.repartitionByRange(num_partitions, *sort).sortWithinPartitions(*sort)
              .withColumn("_mid", F.monotonically_increasing_id()))


def _numbered(local: DataFrame, row_number: str | None, with_total: str | None) -> DataFrame:
    """Global row numbers of ``placed`` rows."""
    pid = F.shiftright("_mid", _PLACE_BITS)
    summary = local.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.col("_pid"), F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off")]
    if with_total:
        cols.append(F.sum("_cnt").over(Window.partitionBy()).cast("long").alias(with_total))
    out = local.withColumn("_pid", pid).join(F.broadcast(summary.select(*cols)), ["_pid"])
    if row_number:
        place = F.col("_mid").bitwiseAND((1 << _PLACE_BITS) - 1)
        out = out.withColumn(row_number, (place + 1 + F.col("_off")).cast("long"))
    return out.drop("_pid", "_mid", "_off")


def ntile_of(rn: Column | str, total: Column | str, k: int) -> Column:
    """NTILE(k) from a 1-based row number and the row count: the first ``N mod k`` tiles hold one
    row more. Integer arithmetic only; the second branch is never reached when N < k."""
    rn = F.col(rn) if isinstance(rn, str) else rn
    n = F.col(total) if isinstance(total, str) else total
    q = F.floor(n / k).cast("long")
    r = (n - q * k).cast("long")
    big = r * (q + 1)
    first = F.floor((rn + q) / (q + 1))
    second = r + F.floor((rn - big + q - 1) / F.when(q > 0, q))
    return F.when(rn <= big, first).otherwise(second).cast("int")


def ntile(df: DataFrame, order: Order, k: int, out: str) -> DataFrame:
    """NTILE(k) OVER (ORDER BY order) without a single partition."""
    s = sequence(df, order, row_number="_nt_rn", with_total="_nt_n")
    return s.withColumn(out, ntile_of("_nt_rn", "_nt_n", k)).drop("_nt_rn", "_nt_n")


def qcut_rank_bin(rn: Column | str, total: Column | str, k: int) -> Column:
    """pandas ``qcut(rank(method='first'), k)`` label 1..k: equal-frequency bins on ranks 1..N
    with right-closed, linearly interpolated edges: ``max(1, ceil((rn-1)*k/(N-1)))``."""
    rn = F.col(rn) if isinstance(rn, str) else rn
    n = F.col(total) if isinstance(total, str) else total
    num = (rn - 1) * k
    den = n - 1
    b = F.floor((num + den - 1) / F.when(den > 0, den))
    return F.when(den <= 0, F.lit(1)).otherwise(F.greatest(F.lit(1), b)).cast("int")


def quantile_edges(df: DataFrame, col: str, fractions: Sequence[tuple[int, int]],
                   num_partitions: int | None = None) -> DataFrame:
    """Exact PERCENTILE_CONT at fractions given as (numerator, denominator): one row with ``edges``
    (array of doubles in the order of ``fractions``; null if there is no value).

    Values are counted first (a hash aggregate with map-side combining), the counts are summed in
    value order over range partitions, and one aggregate picks the two neighbours of each position.
    Positions are computed in integer arithmetic, so there is no float error in where an edge falls.
    Nothing reaches the driver; use it as a one-row subquery."""
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    cum = sequence(counts, [("_v", True)], row_number=None, running={"_upto": "_c"}, num_partitions=num_partitions)
    cum = cum.withColumn("_n", cum.agg(F.max("_upto")).scalar())
    picks = []
    for i, (num, den) in enumerate(fractions):
        low = F.expr(f"({num} * (_n - 1)) div {den}")       # 0-based position
        for name, rank in (("lo", low + 1), ("hi", F.least(low + 2, F.col("_n")))):
            here = (F.col("_upto") >= rank) & (F.col("_upto") - F.col("_c") < rank)
            picks.append(F.max(F.when(here, F.col("_v").cast("double"))).alias(f"{name}{i}"))
    one = cum.agg(F.max("_n").alias("_n"), *picks)
    edges = [F.col(f"lo{i}") + F.coalesce((F.col(f"hi{i}") - F.col(f"lo{i}")) * F.expr(f"({num} * (_n - 1)) % {den}") / den,
                                          F.lit(0.0)) for i, (num, den) in enumerate(fractions)]
    return one.select(F.when(F.col("_n").isNotNull(), F.array(*edges)).alias("edges"))


def quantile_bins(df: DataFrame, col: str, k: int, out: str, tiebreak: str, method: str = "value",
                  labels: Sequence | None = None, on_duplicate_edges: str = "raise") -> DataFrame:
    """W10, pandas ``qcut(x, k)``: equal-frequency bins with linearly interpolated, right-closed
    edges (the lowest value included). ``method="value"`` bins the values themselves;
    ``method="first"`` bins their first-come rank (``rank(method="first")``, ties broken by
    ``tiebreak``). ``labels`` default to 1..k. Duplicate edges fail the query when it runs, as pandas
    raises, unless ``on_duplicate_edges="drop"``: equal edges, the outer ones too, count once, and
    the bins left take the first labels."""
    labels = list(labels) if labels is not None else list(range(1, k + 1))
    if len(labels) != k:
        raise ValueError("need one label per bin")
    named = F.array(*[F.lit(x) for x in labels])
    if method == "first":
        ranked = sequence(df, [(col, True), (tiebreak, True)], row_number="_qb_rn", with_total="_qb_n")
        return ranked.withColumn(out, F.get(named, qcut_rank_bin("_qb_rn", "_qb_n", k) - 1)).drop("_qb_rn", "_qb_n")
    if method != "value":
        raise ValueError(f"unknown method {method!r}")
    if on_duplicate_edges not in ("raise", "drop"):
        raise ValueError(f"unknown on_duplicate_edges={on_duplicate_edges!r}")
    edges = quantile_edges(df, col, [(i, k) for i in range(k + 1)])
    if on_duplicate_edges == "raise":
        unique = F.size(F.array_distinct("edges")) == F.size("edges")
        edges = edges.select(F.when(F.col("edges").isNull() | unique, F.col("edges")).otherwise(F.raise_error(F.concat(
            F.lit("Bin edges must be unique: "), F.col("edges").cast("string")))).alias("edges"))
    # The number of distinct edges below the value is its bin; the lowest value is in the first.
    joined = df.withColumn("_qb_e", edges.select(F.array_distinct("edges")).scalar())
    below = F.size(F.filter("_qb_e", lambda e: e < F.col(col).cast("double")))
    label = F.get(named, F.greatest(below, F.lit(1)) - 1)
    return joined.withColumn(out, F.when(F.col(col).isNotNull(), label)).drop("_qb_e")


def top_k(df: DataFrame, order: Order, k: int) -> DataFrame:
    """ORDER BY ... LIMIT k as a distributed top-k (each partition keeps k, then one merge)."""
    return df.orderBy(*_sort_exprs(order)).limit(k)


def top_rank(df: DataFrame, value: str, k: int, rank_col: str = "rank", ascending: bool = False,
             order_tail: Order = ()) -> DataFrame:
    """Rows whose RANK() over ``value`` is at most ``k``, ties included, with the rank.

    The k-th value is found by a distributed top-k; every row at or beyond it is a candidate.
    Ranks are computed over the distinct candidate values (at most k of them), then broadcast
    back, so a tie group of any size at the boundary never lands in one task.
    """
    kth = top_k(df.select(value).where(F.col(value).isNotNull()), [(value, ascending)], k) \
        .agg((F.max if ascending else F.min)(value).alias("_kth")).scalar()    # one-row subquery
    cand = df.where((F.col(value) <= kth) if ascending else (F.col(value) >= kth))
    counts = cand.groupBy(value).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.orderBy(F.col(value).asc() if ascending else F.col(value).desc())
    ranks = counts.withColumn(rank_col, (F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1))))
    ranks = ranks.select(value, (F.coalesce(F.col(rank_col), F.lit(0)) + 1).cast("long").alias(rank_col))
    out = cand.join(F.broadcast(ranks), [value])
    if order_tail:
        out = out.orderBy(F.col(rank_col), *_sort_exprs(order_tail))
    return out


def ranked_top(df: DataFrame, order: Order, k: int, value: str, rank_col: str,
               ascending: bool = False) -> DataFrame:
    """``RANK() OVER (ORDER BY value) ... ORDER BY rank LIMIT k`` with a deterministic tie-break:
    the first k rows in ``order`` (distributed top-k), ranked among themselves. Every row ranked
    before one of them is also among them, so the rank is the global one."""
    top = top_k(df, order, k)
    w = Window.orderBy(F.col(value).asc() if ascending else F.col(value).desc())
    return top.withColumn(rank_col, F.rank().over(w).cast("long"))
