"""String helpers: list parameters, numeric tests, locale formats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_list(value: str | list | tuple | None) -> list[str] | None:
    """Comma-list parameter to a Python list; blank means "not set"."""
    if value is None:
        return None
    parts = value if isinstance(value, (list, tuple)) else value.split(",")
    cleaned = [str(p).strip() for p in parts]
    cleaned = [p for p in cleaned if p]
    return cleaned or None


def blank_to_null(col: Column | str) -> Column:
    c = _c(col)
    return F.when(F.trim(c) != "", c)


def as_bigint(col: Column | str, default: int | None = None) -> Column:
    """Number in a string, or ``default`` where the text is not numeric."""
    parsed = _c(col).try_cast("bigint")
    return parsed if default is None else F.coalesce(parsed, F.lit(default).cast("bigint"))


def is_numeric(col: Column | str) -> Column:
    return _c(col).try_cast("double").isNotNull()


def sql_len(col: Column | str) -> Column:
    """Length that ignores trailing blanks."""
    return F.length(F.rtrim(_c(col)))


def same_text(a: Column | str, b: Column | str) -> Column:
    """Comparison that ignores case and trailing blanks."""
    return F.lower(F.rtrim(_c(a))) == F.lower(F.rtrim(_c(b)))


def label(code: Column | str, name: Column | str, sep: str = "-") -> Column:
    """``code-name``; NULL if either part is NULL."""
    return F.concat(_c(code).cast("string"), F.lit(sep), _c(name))


def pad2(col: Column | str) -> Column:
    return F.lpad(_c(col).cast("string"), 2, "0")


def format_decimal(col: Column | str, scale: int = 2) -> Column:
    """Decimal comma, no thousands separator."""
    return F.translate(_c(col).cast(f"decimal(38,{scale})").cast("string"), ".", ",")


def format_date(col: Column | str) -> Column:
    """``dd.mm.yyyy``."""
    return F.date_format(_c(col), "dd.MM.yyyy")


def hhmmss(seconds: Column | str) -> Column:
    """Duration as ``HH:mm:ss``; the hour part keeps growing past 24."""
    s = _c(seconds).cast("bigint")
    hours = F.floor(s / 3600).cast("string")
    return F.concat_ws(
        ":",
        F.when(F.length(hours) < 2, F.lpad(hours, 2, "0")).otherwise(hours),
        pad2(F.floor((s % 3600) / 60)),
        pad2(s % 60),
    )


def person_name(first: Column | str, last: Column | str) -> Column:
    """First and last name; a missing last name leaves the trailing blank out of the way."""
    return F.concat(_c(first), F.lit(" "), F.coalesce(_c(last), F.lit("")))
