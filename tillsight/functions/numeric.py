"""Money and ratio helpers (§7.4 numeric policy).

Money is carried as DECIMAL(18,2) so sums do not depend on row order or partitioning. Means and
ratios are computed in double, then rounded half-up through DECIMAL(38,8) and returned as double;
the same text works in DuckDB, so both engines agree to the last digit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """Round half-up to cents and store as DECIMAL(18,2)."""
    return F.round(_c(c), 2).cast(MONEY)


def round_to(x: Column | str, n: int) -> Column:
    """Half-up rounding of a double to ``n`` places, returned as double."""
    return F.round(_c(x).cast("double").cast("decimal(38,8)"), n).cast("double")


def round_money(x: Column | str, n: int = 2) -> Column:
    """Round an exact decimal (a money sum) and return double."""
    return F.round(_c(x), n).cast("double")


def ratio(num: Column | str, den: Column | str, n: int | None = None, scale: float = 1.0) -> Column:
    """``scale * num / den`` in double; null when ``den`` is 0 or null (NULLIF guard)."""
    val = F.try_divide(F.lit(scale) * _c(num).cast("double"), _c(den).cast("double"))
    return round_to(val, n) if n is not None else val


def pct(num: Column | str, den: Column | str, n: int = 2) -> Column:
    """Percentage ``num * 100 / den`` rounded to ``n`` places."""
    return ratio(num, den, n, 100.0)


def mean(total: Column | str, count: Column | str, n: int | None = None) -> Column:
    """Mean as sum / count (never ``avg`` on money: its type differs between engines)."""
    return ratio(total, count, n)


def growth_pct(cur: Column | str, prev: Column | str, n: int = 2) -> Column:
    """``(cur - prev) * 100 / NULLIF(prev, 0)``."""
    return ratio(_c(cur).cast("double") - _c(prev).cast("double"), prev, n, 100.0)
