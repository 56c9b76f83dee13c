"""Date Column builders (T3, recency, cohort months)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal from a date, datetime or ISO string, independent of session zone."""
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    if isinstance(value, _dt.date) and not isinstance(value, _dt.datetime):
        value = _dt.datetime(value.year, value.month, value.day)
    return F.make_timestamp_ntz(F.lit(value.year), F.lit(value.month), F.lit(value.day),
                                F.lit(value.hour), F.lit(value.minute),
                                F.lit(value.second + value.microsecond / 1e6))


def date_literal(value) -> Column:
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value[:10])
    return F.make_date(F.lit(value.year), F.lit(value.month), F.lit(value.day))


def date_key(ts: Column | str) -> Column:
    """YYYYMMDD as an integer, by arithmetic rather than formatting."""
    t = _c(ts)
    return (F.year(t) * 10000 + F.month(t) * 100 + F.dayofmonth(t)).cast("int")


def date_parts(ts: Column | str) -> dict[str, Column]:
    """The ten calendar columns of the date dimension. Week is the ISO week, beside the calendar
    year (2011-01-01 is week 52 of 2011 here); weekend is Saturday or Sunday."""
    t = _c(ts)
    d = F.to_date(t)
    return {
        "date_key": date_key(t),
        "full_date": d,
        "day": F.dayofmonth(d),
        "day_of_week": F.date_format(d, "EEEE"),
        "week": F.weekofyear(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "quarter": F.quarter(d),
        "year": F.year(d),
        "is_weekend": F.dayofweek(d).isin(1, 7),
    }


def recency_days(last_ts: Column | str, snapshot) -> Column:
    """Whole days from the last purchase to the snapshot, floored as a pandas Timedelta's
    ``.days`` is (a purchase at 12:50 the day before counts as 0 days, not 1)."""
    return F.timestamp_diff("DAY", _c(last_ts), ts_literal(snapshot)).cast("int")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar-day difference of two dates (SQL DATEDIFF(day, start, end))."""
    return F.datediff(_c(end), _c(start))


def month_start(d: Column | str) -> Column:
    """First day of the month, kept as DATE."""
    return F.trunc(_c(d), "month")


def months_between_starts(start_month: Column | str, end_month: Column | str) -> Column:
    """Month boundaries crossed between two month starts (exact since both are truncated)."""
    s, e = _c(start_month), _c(end_month)
    return ((F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)).cast("bigint")
