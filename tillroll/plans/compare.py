"""Comparison of periods: any two periods of the same length, and the year report.

All periods are computed in one scan with conditional sums.  Joining one aggregate per period would
read the fact as often as there are periods.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.functions.money import safe_div, sum_each_if, whole_amounts
from tillroll.functions.text import split_list
from tillroll.operators import filters as flt
from tillroll.operators.aggregates import with_grand_total
from tillroll.operators.reshape import measures_as_rows
from tillroll.plans.calendar import Bounds, YearWindows, same_length, within

CAMPAIGN_COLUMNS = ("campaign_id", "combination_id", "reduction_id")


def compared_revenue(
    rows: DataFrame, stores: DataFrame, articles: DataFrame, *, bounds: Bounds, second_start: dt.date | None,
    by_article: bool, article_ids=None, campaigns=None, direction: int = 0,
) -> DataFrame:
    """Revenue and moved quantity in one or two periods per store, and per article where asked for.
    Groups without revenue in every period are left out."""
    second = None if second_start is None else same_length(second_start, *bounds)
    in_first = within("sale_date", bounds)
    whole, amounts = whole_amounts(rows)
    kept = flt.in_direction(whole, direction)
    kept = kept.filter(in_first if second is None else in_first | within("sale_date", second))
    dim = flt.in_list(articles, "article_id", article_ids).select("article_idx", "article_id", "article_name")

    def pair(cond: Column, suffix: str) -> list[Column]:
        return [
            sum_each_if(cond, "sales_excl_vat", "return_excl_vat").alias(f"revenue_{suffix}"),
            sum_each_if(cond, "qty_sold", "qty_return").alias(f"moved_{suffix}"),
        ]

    aggs = pair(in_first, "1")
    if second is not None:
        aggs += pair(within("sale_date", second), "2")
    if campaigns:
        per_key = _on_campaign_days(kept, aggs, campaigns)
    else:
        per_key = kept.groupBy("store_idx", *(["article_idx"] if by_article or article_ids else [])).agg(*aggs)
    per_key = amounts(per_key, *[f"{n}_{k}" for k in ("1", "2")[: 1 if second is None else 2] for n in ("revenue", "moved")])
    named = per_key.join(stores.select("store_idx", "store_name"), "store_idx")
    if "article_idx" in per_key.columns:
        named = named.join(dim, "article_idx")
    names = [c for c in per_key.columns if c not in ("store_idx", "article_idx")]
    keys: list = ["store_name"]
    none = F.lit(None).cast("string")
    if by_article:
        keys += ["article_id", "article_name"]
    else:
        keys += [none.alias("article_id"), none.alias("article_name")]
    out = named.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])
    if second is None:
        empty = F.lit(None).cast("double")
        return out.filter(F.col("revenue_1") != 0).withColumns({"revenue_2": empty, "moved_2": empty})
    return out.filter((F.col("revenue_1") != 0) | (F.col("revenue_2") != 0))


def _on_campaign_days(rows: DataFrame, aggs: list[Column], campaigns) -> DataFrame:
    """Sums per store and article over the days on which a listed campaign sold.  The day carries
    the test as one more aggregate, so the sales are not joined with themselves."""
    listed = split_list(campaigns)
    hit = flt.any_of(F.coalesce(F.col(c).cast("string").isin(listed), F.lit(False)) for c in CAMPAIGN_COLUMNS)
    days = rows.groupBy("store_idx", "article_idx", "sale_date").agg(*aggs, F.max(hit).alias("_hit")).filter("_hit")
    names = [c for c in days.columns if c not in ("store_idx", "article_idx", "sale_date", "_hit")]
    return days.groupBy("store_idx", "article_idx").agg(*[F.sum(n).alias(n) for n in names])


# -- year report ------------------------------------------------------------------------------


def _window_sums(windows: YearWindows, base: dict[str, list[Column]]) -> list[Column]:
    out = []
    for window, bounds in windows.named().items():
        inside = within("sale_date", bounds)
        out += [sum_each_if(inside, *parts).alias(f"{n}_{window}") for n, parts in base.items()]
    return out


def year_sums(rows: DataFrame, articles: DataFrame, windows: YearWindows, *, article_ids=None) -> DataFrame:
    """Revenue, quantity and customers per first-level group in the four windows of the year."""
    base = {
        "revenue": [F.col("sales_excl_vat"), F.col("return_excl_vat")],
        "items": [F.col("qty_sold"), -F.col("qty_return")],
        "customers": [F.when(F.col("line_no") == 1, 1)],
    }
    whole, amounts = whole_amounts(rows)
    per_article = whole.filter(windows.any_of("sale_date")).groupBy("article_idx").agg(
        *_window_sums(windows, base), F.max(within("sale_date", windows.period)).alias("in_period")
    )
    per_article = amounts(per_article, *[f"{n}_{w}" for n in ("revenue", "items") for w in windows.named()])
    return _by_level1(per_article, articles, article_ids)


def _by_level1(per_article: DataFrame, articles: DataFrame, article_ids) -> DataFrame:
    dim = flt.in_list(articles, "article_id", article_ids).select("article_idx", "lev1_name")
    names = [c for c in per_article.columns if c not in ("article_idx", "in_period")]
    grouped = per_article.join(dim, "article_idx").groupBy("lev1_name").agg(
        *[F.sum(n).alias(n) for n in names], F.max("in_period").alias("in_period")
    )
    return grouped.filter("in_period").drop("in_period")


def collected_year_sums(lines: DataFrame, articles: DataFrame, windows: YearWindows, *, article_ids=None) -> DataFrame:
    """The same sums over the delivered lines of collected orders."""
    base = {
        "revenue": [F.col("delivered_amount")],
        "items": [F.col("received_qty")],
        "customers": [F.when(F.col("line_no") == 1, 1)],
    }
    dated = lines.withColumnRenamed("collect_date", "sale_date")
    per_article = dated.filter(windows.any_of("sale_date")).groupBy("article_idx").agg(
        *_window_sums(windows, base), F.max(within("sale_date", windows.period)).alias("in_period")
    )
    return _by_level1(per_article, articles, article_ids)


def year_report(sums: DataFrame) -> DataFrame:
    """Measures by group and in total, four windows side by side.

    Customers are counted over all groups, so the per-customer figures of a group divide by the
    total's customers.  A zero is shown as empty.
    """
    windows = ("period", "ytd", "last_year", "last_ytd")
    sum_names = [c for c in sums.columns if c != "lev1_name"]
    rows = with_grand_total(sums, ["lev1_name"], [F.sum(n).alias(n) for n in sum_names])
    # One row per group by now: the total's customers reach the groups through a window over these
    # few rows, where a scalar subquery would read the sales a second time.
    everything = Window.partitionBy(F.lit(0))
    is_total = F.col("is_total")
    joined = rows.withColumns(
        {f"all_customers_{w}": F.max(F.when(is_total, F.col(f"customers_{w}"))).over(everything) for w in windows}
    )

    def row(make) -> dict[str, Column]:
        return {w: F.nullif(make(w), F.lit(0.0)) for w in windows}

    def customers(w: str) -> Column:
        return F.col(f"all_customers_{w}")

    def amount(w: str) -> Column:
        return F.col(f"revenue_{w}").cast("double")

    def items(w: str) -> Column:
        return F.col(f"items_{w}").cast("double")

    table = {
        "1 Revenue": row(amount),
        "2 NoOfArticles": row(items),
        "3 NoOfCustomers": row(lambda w: customers(w).cast("double")),
        "4 RevenuePerCustomer": row(lambda w: safe_div(amount(w), customers(w), "null")),
        "5 ItemsPerCustomer": row(lambda w: safe_div(items(w), customers(w), "null")),
        "6 PricePerItem": row(lambda w: safe_div(amount(w), items(w), "null")),
    }
    shown = joined.filter((F.col("revenue_period") != 0) | is_total)
    lines = measures_as_rows(shown, ["lev1_name", "is_total"], table)
    return lines.filter((F.col("measure") != "3 NoOfCustomers") | is_total).drop("is_total")


def year_difference(everything: DataFrame, collected: DataFrame) -> DataFrame:
    """All sales minus collected sales, per group and window."""
    from tillroll.operators.joins import difference

    names = [c for c in everything.columns if c != "lev1_name"]
    return difference(everything, collected, ["lev1_name"], names)
