"""Week arithmetic.  Weeks start on Monday."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def weekday_no(col: Column | str) -> Column:
    """Monday = 1 … Sunday = 7."""
    return F.weekday(_c(col)) + 1


def week_start(col: Column | str) -> Column:
    return F.date_sub(_c(col), F.weekday(_c(col)))


def week_end(col: Column | str) -> Column:
    """Sunday of the week."""
    return F.date_add(_c(col), F.lit(6) - F.weekday(_c(col)))


def iso_week(col: Column | str) -> Column:
    return F.weekofyear(_c(col))


def calendar_week(col: Column | str) -> Column:
    """Week number counted from the week that holds 1 January (not the ISO week)."""
    c = _c(col)
    jan1 = F.trunc(c, "year")
    return F.floor((F.dayofyear(c) - 1 + F.weekday(jan1)) / 7).cast("int") + 1


def week_stamp(col: Column | str) -> Column:
    """Sunday of the week as ``yyyymmdd`` followed by its two-digit ISO week."""
    sunday = week_end(_c(col))
    return F.concat(
        F.date_format(sunday, "yyyyMMdd"), F.lpad(F.weekofyear(sunday).cast("string"), 2, "0")
    )
