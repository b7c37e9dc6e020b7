"""Exact money arithmetic and the ratio rules of the reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def cents(col: Column | str) -> Column:
    """Hundredths of a raw number as a whole number."""
    c = F.col(col) if isinstance(col, str) else col
    return F.rint(c * 100).cast("bigint")


def from_cents(whole: Column) -> Column:
    """Hundredths to a row amount, ``decimal(12,2)``: up to 9 999 999 999.99.

    Sums over fixed-point columns do not depend on the order in which partitions are merged, which
    sums over doubles do.
    """
    return (whole.cast("decimal(12,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(12,2)")


#: Prefix of the whole hundredths that a frame carries beside its row amounts.
WHOLE = "cents_of_"


def whole_amounts(fact: DataFrame) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """The frame with its row amounts as whole hundredths, and what turns sums of them back into amounts.

    Sums of whole numbers stay in a long per group, checked for overflow; sums of decimals of more than eight digits
    don't.  A frame that doesn't carry hundredths is left as it is, and so are its sums.
    """
    carried = [c for c in fact.columns if c.startswith(WHOLE)]
    if not carried:
        return fact, lambda df, *names: df
    names = {c.removeprefix(WHOLE) for c in carried}
    whole = fact.select(*[c for c in fact.columns if c not in names and c not in carried], *[F.col(c).alias(c.removeprefix(WHOLE)) for c in carried])
    return whole, lambda df, *sums: df.withColumns({n: from_cent_sum(F.col(n)) for n in sums})


def from_cent_sum(total: Column) -> Column:
    """A sum of hundredths as ``decimal(22,2)``."""
    return (total.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(22,2)")


def percent_of(whole: Column, percent: Column | int) -> Column:
    """Percent of a non-negative whole amount, rounded half up."""
    part = whole * percent + 50
    return F.call_function("div", part, F.lit(100))


def dec(col: Column | str) -> Column:
    """Raw number to a row amount."""
    return from_cents(cents(col))


def sum_if(cond: Column, value: Column | str, default: int | None = 0) -> Column:
    """Conditional sum; ``default=None`` keeps NULL for groups in which nothing matched.

    The rows that do not match are NULL, not 0: a literal 0 would widen the amount's type.
    """
    v = F.col(value) if isinstance(value, str) else value
    total = F.sum(F.when(cond, v))
    return total if default is None else F.coalesce(total, F.lit(default))


def sum_each_if(cond: Column, *values: Column | str) -> Column:
    """Conditional sum of several columns, each added up on its own (see ``net_amount_sum``)."""
    first, *rest = [sum_if(cond, v) for v in values]
    for part in rest:
        first = first + part
    return first


def safe_div(num: Column, den: Column, mode: str = "zero") -> Column:
    """Ratio with one of the three zero-denominator rules found in the reports.

    ``zero``: ratio is 0; ``one``: divide by 1 instead; ``null``: ratio is NULL.
    The quotient is always floating point, never an integer division.
    """
    n, d = num.cast("double"), den.cast("double")
    if mode == "zero":
        return F.coalesce(n / F.nullif(d, F.lit(0.0)), F.lit(0.0))
    if mode == "one":
        return n / F.coalesce(F.nullif(d, F.lit(0.0)), F.lit(1.0))
    if mode == "null":
        return n / F.nullif(d, F.lit(0.0))
    raise ValueError(f"unknown ratio mode: {mode}")


def unit_value(amount: Column, qty: Column) -> Column:
    """Amount per unit in cents, rounded half up from the exact quotient; 0 without a quantity."""
    exact = amount / F.nullif(qty, F.lit(0).cast("decimal(12,2)"))
    return F.coalesce(exact.cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))


def in_home_currency(amount: Column | str, rate: Column | str) -> Column:
    """Amount times exchange rate; a missing or zero rate counts as 1."""
    a = F.col(amount) if isinstance(amount, str) else amount
    r = F.col(rate) if isinstance(rate, str) else rate
    return a * F.coalesce(F.nullif(r, F.lit(0).cast("decimal(6,2)")), F.lit(1).cast("decimal(6,2)"))


def net_qty(sold: str = "qty_sold", returned: str = "qty_return", mode: str = "net") -> Column:
    """Sold minus returned.  Returned quantities are stored positive; ``mode='moved'`` adds them,
    as the movement reports do."""
    if mode == "net":
        return F.col(sold) - F.col(returned)
    if mode == "moved":
        return F.col(sold) + F.col(returned)
    raise ValueError(f"unknown quantity mode: {mode}")


def net_amount(sales: str = "sales_amount", returned: str = "return_amount") -> Column:
    """Sales plus returns; return amounts are stored negative."""
    return F.col(sales) + F.col(returned)


def net_qty_sum(sold: str = "qty_sold", returned: str = "qty_return", mode: str = "net") -> Column:
    """Sum of ``net_qty``, as a difference (or total) of two sums."""
    a, b = F.sum(sold), F.sum(returned)
    return a - b if mode == "net" else a + b


def net_amount_sum(sales: str = "sales_amount", returned: str = "return_amount") -> Column:
    """Sum of ``net_amount``.  Two sums over eight-digit columns stay whole-number sums; one sum over
    their nine-digit total would not."""
    return F.sum(sales) + F.sum(returned)


def signed(amount: Column | str, sign: Column | str) -> Column:
    """Amount with the sign of another column."""
    a = F.col(amount) if isinstance(amount, str) else amount
    s = F.col(sign) if isinstance(sign, str) else sign
    return F.when(s < 0, -a).otherwise(a)
