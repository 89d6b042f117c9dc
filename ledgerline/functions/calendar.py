"""Date features and as-of date arithmetic."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_date(value) -> Column:
    """Typed date literal from a date or ISO string (time part dropped);
    None means today's date on the cluster."""
    if value is None:
        return F.current_date()
    if isinstance(value, _dt.datetime):
        value = value.date()
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value.split("T")[0])
    return F.lit(value)


def iso_date(text) -> Column:
    """The date of an ISO date or timestamp text (what stands before "T")."""
    return F.to_date(F.split(_c(text), "T").getItem(0), "yyyy-MM-dd")


def day_of_week(d="order_date") -> Column:
    """1 = Sunday .. 7 = Saturday, as BIGINT."""
    return F.dayofweek(_c(d)).cast("bigint")


def month_of(d="order_date") -> Column:
    return F.month(_c(d)).cast("bigint")


def quarter_of(d="order_date") -> Column:
    return F.quarter(_c(d)).cast("bigint")


def month_start(as_of) -> Column:
    return F.trunc(as_date(as_of), "month")


def days_before(as_of, n: int) -> Column:
    return F.date_sub(as_date(as_of), n)


def to_date_value(value) -> _dt.date:
    """Python date from a date / datetime / ISO string."""
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value).split("T")[0])
