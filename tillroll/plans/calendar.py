"""Calendar and period parameters.

A period parameter is resolved to plain date bounds before the plan is built.  Relative periods are
contiguous, so the bounds are exact, and a ``between`` on the fact's date reaches the scan; joining
the fact to a calendar to find its days would not prune anything at planning time.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillroll.functions.keys import date_key
from tillroll.functions.weeks import calendar_week, iso_week, weekday_no

Bounds = tuple[dt.date, dt.date]


def add_months(day: dt.date, months: int) -> dt.date:
    """Same day of another month, clipped to that month's end."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    first = dt.date(year, month + 1, 1)
    last = month_end(first)
    return dt.date(year, month + 1, min(day.day, last.day))


def month_end(day: dt.date) -> dt.date:
    following = dt.date(day.year + day.month // 12, day.month % 12 + 1, 1)
    return following - dt.timedelta(days=1)


def unit_start(unit: str, day: dt.date, offset: int) -> dt.date:
    """First day of the day/week/month/quarter/year that lies ``offset`` units from ``day``."""
    if unit == "D":
        return day + dt.timedelta(days=offset)
    if unit == "W":
        return day - dt.timedelta(days=day.weekday()) + dt.timedelta(weeks=offset)
    if unit == "M":
        return add_months(day.replace(day=1), offset)
    if unit == "Q":
        return add_months(dt.date(day.year, (day.month - 1) // 3 * 3 + 1, 1), 3 * offset)
    if unit == "Y":
        return dt.date(day.year + offset, 1, 1)
    raise ValueError(f"unknown period unit: {unit}")


@dataclass(frozen=True)
class Period:
    """``D``: a date range; ``Y``: a year to date; ``R``: relative units with start and duration."""

    kind: str = "D"
    date_from: dt.date | None = None
    date_to: dt.date | None = None
    ytd: int = 0
    unit: str = "D"
    start: int = 0
    duration: int = 1

    def bounds(self, as_of: dt.date) -> Bounds:
        if self.kind == "D":
            if self.date_from is None or self.date_to is None:
                raise ValueError("a date range needs both dates")
            return self.date_from, self.date_to
        if self.kind == "Y":
            return dt.date(as_of.year + self.ytd, 1, 1), add_months(as_of, 12 * self.ytd)
        if self.kind == "R":
            first = unit_start(self.unit, as_of, self.start)
            after = unit_start(self.unit, as_of, self.start + self.duration)
            return first, after - dt.timedelta(days=1)
        raise ValueError(f"unknown period kind: {self.kind}")


def same_length(start: dt.date, date_from: dt.date, date_to: dt.date) -> Bounds:
    """Second period: as long as the first, from another start."""
    return start, start + (date_to - date_from)


@dataclass(frozen=True)
class YearWindows:
    """A period, the year up to its end, and both one year earlier."""

    period: Bounds
    ytd: Bounds
    last_year: Bounds
    last_ytd: Bounds

    @classmethod
    def of(cls, date_from: dt.date, date_to: dt.date) -> "YearWindows":
        ly_from, ly_to = add_months(date_from, -12), add_months(date_to, -12)
        return cls(
            (date_from, date_to),
            (dt.date(date_from.year, 1, 1), date_to),
            (ly_from, ly_to),
            (dt.date(date_from.year - 1, 1, 1), ly_to),
        )

    def named(self) -> dict[str, Bounds]:
        return {
            "period": self.period, "ytd": self.ytd, "last_year": self.last_year, "last_ytd": self.last_ytd,
        }

    def any_of(self, col: str) -> Column:
        """Rows that fall in at least one window, as two ranges at most."""
        now = (min(self.period[0], self.ytd[0]), self.ytd[1])
        before = (min(self.last_year[0], self.last_ytd[0]), self.last_ytd[1])
        return within(col, now) | within(col, before)


def within(col: Column | str, bounds: Bounds) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.between(F.lit(bounds[0]), F.lit(bounds[1]))


def months_covered(date_from: dt.date, date_to: dt.date) -> bool:
    """Whether a period consists of whole months."""
    return date_from.day == 1 and date_to == month_end(date_to)


def calendar(spark: SparkSession, first: dt.date, last: dt.date, as_of: dt.date) -> DataFrame:
    """One row per day with keys, names and offsets relative to ``as_of``."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))).alias("full_date")
    )
    return with_offsets(days, "full_date", as_of)


def with_offsets(days: DataFrame, col: str, as_of: dt.date) -> DataFrame:
    """Add calendar columns to a frame that has a date column."""
    day, today = F.col(col), F.lit(as_of)
    monday = F.date_trunc("week", day).cast("date")
    this_monday = F.date_trunc("week", today).cast("date")
    months = (F.year(day) - F.year(today)) * 12 + F.month(day) - F.month(today)
    quarters = (F.year(day) - F.year(today)) * 4 + F.quarter(day) - F.quarter(today)
    in_ytd = F.month(day) * 100 + F.dayofmonth(day) <= as_of.month * 100 + as_of.day
    return days.select(
        "*",
        date_key(col).alias("date_key"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        iso_week(day).alias("iso_week"),
        calendar_week(day).alias("calendar_week"),
        weekday_no(day).alias("weekday_no"),
        F.datediff(day, today).alias("relative_day"),
        F.floor(F.datediff(monday, this_monday) / 7).cast("int").alias("relative_week"),
        months.alias("relative_month"),
        quarters.alias("relative_quarter"),
        (F.year(day) - F.year(today)).alias("relative_year"),
        F.when(in_ytd, F.year(day) - F.year(today)).alias("relative_ytd"),
    )


def bounds_from_calendar(days: DataFrame, condition: Column) -> DataFrame:
    """First and last day that satisfy a calendar condition, as one row."""
    return days.filter(condition).agg(F.min("full_date").alias("date_from"), F.max("full_date").alias("date_to"))
