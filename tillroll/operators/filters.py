"""Predicates.  Each returns the frame with declarative filters that Catalyst can push down."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillroll.functions.keys import moment
from tillroll.functions.text import as_bigint, label, split_list
from tillroll.functions.weeks import weekday_no
from tillroll.plans.calendar import Period, within
from tillroll.sources.inline import inline_table

# Above this many values a list is joined, not inlined into the plan; the values compare alike.
INLINE_LIST_LIMIT = 1000


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def when_set(df: DataFrame, col: str, value) -> DataFrame:
    """Optional equality: no filter at all when the parameter is missing or blank."""
    if value is None or (isinstance(value, str) and not value.strip()):
        return df
    return df.filter(F.col(col) == value)


def in_list(df: DataFrame, col: str, values) -> DataFrame:
    """Membership in a comma list or Python list; blank means no filter.  Long lists become a
    left-semi join so that the plan stays small.

    On a whole-number column the values are read as whole numbers, so '007' is 7, and a value that
    isn't one matches nothing; on any other column they are texts.
    """
    wanted = split_list(values)
    if wanted is None:
        return df
    whole = isinstance(df.schema[col].dataType, T.IntegralType)
    if whole:
        numbers = [int(v) for v in wanted if re.fullmatch(r"[+-]?[0-9]+", v)]
        wanted = [n for n in numbers if -(1 << 63) <= n < 1 << 63]
    key = F.col(col).cast("bigint" if whole else "string")
    if not wanted:
        return df.limit(0)
    if len(wanted) <= INLINE_LIST_LIMIT:
        return df.filter(key.isin(wanted))
    listed = inline_table(df.sparkSession, {"wanted": sorted(set(wanted))})
    return df.join(listed, key == F.col("wanted"), "left_semi")


def store_group(stores: DataFrame, values, columns: Sequence[str]) -> DataFrame:
    """Stores for which any hierarchy column or the store id matches one of the values.

    The columns are tested in place on the store dimension, so a store that matches on several
    levels still appears once and the fact is never multiplied.
    """
    wanted = split_list(values)
    if wanted is None:
        return stores.limit(0)
    return stores.filter(F.arrays_overlap(F.array(*columns), F.array(*[F.lit(v) for v in wanted])))


def in_stores(fact: DataFrame, stores: DataFrame, key: str = "store_idx") -> DataFrame:
    return fact.join(stores.select(key), key, "left_semi")


def in_period(df: DataFrame, col: str, period: Period, as_of: dt.date) -> DataFrame:
    return df.filter(within(col, period.bounds(as_of)))


def on_weekdays(df: DataFrame, col: str, flags: Sequence[bool]) -> DataFrame:
    """Seven flags, Monday first; all set means no filter."""
    days = [i + 1 for i, on in enumerate(flags) if on]
    return df if len(days) == 7 else df.filter(weekday_no(col).isin(days))


# Report type parameter.
DIRECTION_ALL, DIRECTION_DEPARTURE, DIRECTION_ARRIVAL, DIRECTION_EXTRA = 0, 1, 2, 3


def in_direction(df: DataFrame, report_type: int, col: str = "origin_code") -> DataFrame:
    """Departures, arrivals, or receipts without a flight direction (blank or missing)."""
    c = F.trim(F.col(col))
    if report_type == DIRECTION_ALL:
        return df
    if report_type == DIRECTION_DEPARTURE:
        return df.filter(c == "D")
    if report_type == DIRECTION_ARRIVAL:
        return df.filter(c == "A")
    if report_type == DIRECTION_EXTRA:
        return df.filter(F.coalesce(c, F.lit("")) == "")
    raise ValueError(f"unknown direction: {report_type}")


def id_between(df: DataFrame, col: str, low=None, high=None) -> DataFrame:
    """Numeric range over text ids; ids that are not numbers count as -1."""
    number = as_bigint(col, -1)
    if low is not None:
        df = df.filter(number >= int(low))
    if high is not None:
        df = df.filter(number <= int(high))
    return df


def value_between(df: DataFrame, col: str, low=None, high=None, keep_null: bool = True) -> DataFrame:
    """Range where each bound is optional; rows without a value pass, as the reports want."""
    for bound, cmp in ((low, "ge"), (high, "le")):
        if bound is not None:
            test = F.col(col) >= bound if cmp == "ge" else F.col(col) <= bound
            df = df.filter(test | F.col(col).isNull() if keep_null else test)
    return df


def current_version(df: DataFrame, flag: str = "is_current") -> DataFrame:
    return df.filter(F.col(flag))


def current_only(df: DataFrame, only_current: bool, flag: str = "is_current") -> DataFrame:
    """The "current stores only" switch."""
    return df.filter(F.col(flag)) if only_current else df


def known_members(df: DataFrame, key: str) -> DataFrame:
    """Rows whose member is known; keys of unknown members are negative."""
    return df.filter(F.col(key) >= 0)


def exclude(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Drop listed groups; rows without a group stay (unlike a bare NOT IN)."""
    return df.filter(F.col(col).isNull() | ~F.col(col).isin(list(values)))


def between_moments(
    df: DataFrame, day_col: str, time_col: str, first: tuple[int, int], last: tuple[int, int], at_col: str | None = None
) -> DataFrame:
    """Interval over split date and time keys, by whole minutes.

    ``at_col`` names the timestamp that the keys are made of: its bounds reach the scan and prune it,
    where computed keys can't.
    """
    at = moment(day_col, time_col)
    if at_col is not None:
        kind = df.schema[at_col].dataType
        begin, end = (dt.datetime.strptime(f"{day:08d}{time:04d}", "%Y%m%d%H%M") for day, time in (first, last))
        df = df.filter(
            (F.col(at_col) >= F.lit(str(begin)).cast(kind)) & (F.col(at_col) < F.lit(str(end + dt.timedelta(minutes=1))).cast(kind))
        )
    return df.filter(F.col(day_col).between(first[0], last[0])).filter(
        at.between(first[0] * 10000 + first[1], last[0] * 10000 + last[1])
    )


def in_campaigns(df: DataFrame, values, columns: Sequence[str]) -> DataFrame:
    """Rows where any of the campaign columns is listed."""
    wanted = split_list(values)
    if wanted is None:
        return df
    return df.filter(any_of(F.coalesce(F.col(c).cast("string").isin(wanted), F.lit(False)) for c in columns))


def matches_label(pairs: Sequence[tuple[str, str]], text: str) -> Column:
    """Whether ``code-name`` of any level equals the text."""
    return any_of(F.coalesce(label(c, n) == text, F.lit(False)) for c, n in pairs)


def leaf_level(depth: str, columns: Sequence[str], default: str | None = None) -> Column:
    """Value of the deepest level an article has."""
    case = F.when(F.col(depth) == 1, F.col(columns[0]))
    for level, name in enumerate(columns[1:], start=2):
        case = case.when(F.col(depth) == level, F.col(name))
    return case if default is None else F.coalesce(case, F.lit(default))


def upper_level(depth: str, first: str, second: str, default: str) -> Column:
    """Second level where the article has one, else the first, else the default."""
    return (
        F.when(F.col(depth) >= 2, F.col(second)).when(F.col(depth) == 1, F.col(first)).otherwise(F.lit(default))
    )


def branch_members(nodes: DataFrame, text: str) -> DataFrame:
    """Children of the nodes whose name contains the text (case-insensitive)."""
    parents = nodes.filter(F.lower("node_name").contains(text.lower())).select(F.col("node_id").alias("parent_id"))
    return nodes.join(parents, "parent_id", "left_semi")


def active_on(day: dt.date, start: str = "valid_from", end: str = "valid_to") -> Column:
    return F.lit(day).between(F.col(start), F.col(end))


# Receipt states that count as payments (normal, voided afterwards).
COUNTED_STATUSES = (1, 5)


def counted_receipts(df: DataFrame, col: str = "receipt_status") -> DataFrame:
    return df.filter(F.col(col).isin(*COUNTED_STATUSES))
