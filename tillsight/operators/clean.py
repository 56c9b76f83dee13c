"""T1 — clean raw invoice lines: F1 → F2 → F3 → F4 → F5 → F6 → F7 → A9, in that order.

Filters are plain predicates, so Catalyst pushes the null and sign checks into the scan. The
code filters run *before* trimming (so ``"POST "`` survives), as in the reference. The dedup is
one aggregation keyed by (invoice, stock code, customer): Spark combines duplicates map-side
before the shuffle, so a group of copies holding a third of all rows never reaches one task whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.operators.joins import Hot, key_hash
from tillsight.functions.text import in_set, starts_with, strip, title_case

# Fixed values (must equal the reference): non-product stock codes, matched exactly before trim.
INVALID_CODES = ["POST", "D", "M", "BANK CHARGES", "PADS", "DOT", "CRUK"]
CANCEL_PREFIX = "C"
GIFT_PREFIX = "GIFT"
DEDUP_KEYS = ["invoice", "stock_code", "customer_id"]
DEFAULT_ORDER = ["part_no", "line_no"]


def drop_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """F1."""
    return df.dropna(subset=list(cols))


def drop_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Drop rows whose value starts with ``prefix``; null values are kept."""
    return df.where(~starts_with(col, prefix))


def positive(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """strictly positive; null drops."""
    cond: Column | None = None
    for c in cols:
        cond = (F.col(c) > 0) if cond is None else cond & (F.col(c) > 0)
    return df.where(cond)


def drop_codes(df: DataFrame, col: str, codes: Sequence[str]) -> DataFrame:
    """exact, case-sensitive; a null code is kept."""
    return df.where(~in_set(col, codes))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, per key, the row that comes first in ``order`` (then by the remaining columns,
    so the choice is total and does not depend on partitioning).

    Written as MIN over a struct that leads with the order columns: an aggregate, so partial
    aggregation collapses duplicates inside each input partition before anything is shuffled.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_first")
    return df.groupBy(*keys).agg(packed).select(*keys, "_first.*").select(*df.columns)


def valid_lines(raw: DataFrame, invalid_codes: Sequence[str] = INVALID_CODES) -> DataFrame:
    """Everything but the dedup, line by line."""
    df = drop_nulls(raw, ["customer_id"])
    df = drop_nulls(df, ["description"])
    df = drop_prefix(df, "invoice", CANCEL_PREFIX)
    df = positive(df, ["quantity", "price"])
    df = drop_codes(df, "stock_code", invalid_codes)
    df = drop_prefix(df, "stock_code", GIFT_PREFIX)
    df = df.withColumns({c: strip(c) for c in ["stock_code", "description", "country"]})
    return df.withColumn("country", title_case("country"))


def dedup(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """A9 on valid lines: the first of every (invoice, stock code, customer)."""
    return first_per_key(df, DEDUP_KEYS, order or [c for c in DEFAULT_ORDER if c in df.columns])


def by_invoice(valid: DataFrame, hot_invoices: Hot | None = None, tasks: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Valid lines dealt by invoice, so that a task has all copies of its lines and all lines of its invoices, and apart
    from them the lines of ``hot_invoices`` (as ``joins.heavy_keys`` finds them in the valid lines), which are not dealt: the
    aggregates that follow combine them map-side, so that no task gets one whole."""
    hot = key_hash(["invoice"]).isin([*hot_invoices]) if hot_invoices else F.lit(False)
    rest = valid.where(~hot)
    return rest.repartition(*([tasks] if tasks else []), "invoice"), valid.where(hot) if hot_invoices else None


def dedup_dealt(valid: DataFrame, order: Sequence[str] | None = None, hot_invoices: Hot | None = None,
                tasks: int | None = None) -> DataFrame:
    """``dedup`` over ``tasks`` tasks whatever the session's number of shuffle partitions."""
    rest, cut = by_invoice(valid, hot_invoices, tasks)
    out = dedup(rest, order)
    return out.unionByName(dedup(cut, order)) if cut is not None else out


def clean(raw: DataFrame, order: Sequence[str] | None = None, invalid_codes: Sequence[str] = INVALID_CODES) -> DataFrame:
    return dedup(valid_lines(raw, invalid_codes), order)


def clean_accounting(raw: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Rows removed by each rule, in rule order (the reference logs these counts). One pass:
    each row is attributed to the first rule that removes it."""
    s = F.col
    reason = (F.when(s("customer_id").isNull(), "null_customer")
               .when(s("description").isNull(), "null_description")
               .when(starts_with("invoice", CANCEL_PREFIX), "cancellation")
               .when(~(s("quantity") > 0) | s("quantity").isNull(), "non_positive_quantity")
               .when(~(s("price") > 0) | s("price").isNull(), "non_positive_price")
               .when(in_set("stock_code", INVALID_CODES), "invalid_code")
               .when(starts_with("stock_code", GIFT_PREFIX), "gift_code")
               .otherwise("kept"))
    counts = raw.groupBy(reason.alias("rule")).agg(F.count(F.lit(1)).alias("rows"))
    kept = clean(raw, order).agg(F.count(F.lit(1)).alias("rows")).withColumn("rule", F.lit("after_dedup"))
    return counts.unionByName(kept.select("rule", "rows"))
