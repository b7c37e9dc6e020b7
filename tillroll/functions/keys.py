"""Integer date and time keys, receipt keys, unknown-member keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_key(col: Column | str) -> Column:
    """``yyyymmdd`` as an integer, by arithmetic (no string formatting per row)."""
    c = _c(col)
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def key_date(col: Column | str) -> Column:
    """Date of a ``yyyymmdd`` key."""
    c = _c(col)
    return F.make_date((c / 10000).cast("int"), ((c % 10000) / 100).cast("int"), c % 100)


def key_of(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def month_key(col: Column | str) -> Column:
    c = _c(col)
    return F.year(c) * 100 + F.month(c)


def time_key(col: Column | str) -> Column:
    """``hhmm`` as an integer."""
    c = _c(col)
    return F.hour(c) * 100 + F.minute(c)


def receipt_row_key(receipt: Column | str, line: Column | str) -> Column:
    return _c(receipt) * 1000 + _c(line)


def receipt_head(row_key: Column | str) -> Column:
    return F.floor(_c(row_key) / 1000)


def receipt_line(row_key: Column | str) -> Column:
    return _c(row_key) % 1000


def known(key: Column | str, value: Column | str) -> Column:
    """``value`` unless the surrogate key marks an unknown member (negative or missing)."""
    return F.when(F.coalesce(_c(key), F.lit(-1)) >= 0, _c(value))


def moment(day_key: Column | str, hhmm: Column | str) -> Column:
    """Sortable number for a split date and time key, minute resolution."""
    return _c(day_key).cast("bigint") * 10000 + _c(hhmm)
