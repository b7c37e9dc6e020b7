"""Top-n, bottom-n and re-sorted extracts.  Every order ends in a unique key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# Measure and direction by the name the caller gives.
TOP_MEASURES = {
    "TopQuantity": ("sold_qty", True),
    "TopNetSales": ("net_sales", True),
    "TopGrossProfit": ("gross_profit", True),
    "LowGrossProfit": ("gross_profit", False),
    "LowNetSales": ("net_sales", False),
}


def top_n(df: DataFrame, measure: str, n: int, tie_break: Sequence[str], descending: bool = True) -> DataFrame:
    """``n`` rows by one measure.  Planned as a per-partition top-n followed by a merge of n rows
    per partition."""
    col = F.col(measure)
    order = col.desc_nulls_last() if descending else col.asc_nulls_last()
    return df.orderBy(order, *tie_break).limit(n)


def top_by_name(df: DataFrame, name: str, n: int, tie_break: Sequence[str]) -> DataFrame:
    if name not in TOP_MEASURES:
        raise ValueError(f"unknown order: {name}")
    measure, descending = TOP_MEASURES[name]
    return top_n(df, measure, n, tie_break, descending)


def top_then_sort(df: DataFrame, measure: str, n: int, tie_break: Sequence[str], show: Sequence[str]) -> DataFrame:
    return top_n(df, measure, n, tie_break).orderBy(*show)
