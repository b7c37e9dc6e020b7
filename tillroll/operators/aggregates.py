"""Aggregation shapes.  All reduce on the map side before their shuffle."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.functions.money import sum_if


#: Groups that one task aggregates, and up to how many such pieces rows aren't dealt to pieces at all.
PIECE_GROUPS, FEW_PIECES = 200_000, 4


def pieces_of(rows: DataFrame, *keys: str) -> int:
    """How many pieces the groups of these keys make up, by a sketch of the keys; 0 for few."""
    pieces = math.ceil(rows.agg(F.approx_count_distinct(F.xxhash64(*keys))).first()[0] / PIECE_GROUPS)
    return max(pieces, rows.sparkSession.sparkContext.defaultParallelism) if pieces > FEW_PIECES else 0


def dealt(rows: DataFrame, pieces: int, *keys: str) -> DataFrame:
    """The rows exchanged by these keys into so many pieces, to be aggregated by keys that contain them.

    For groups that are about as many as the rows: tasks then hold the groups of a piece, while the partitions of a
    grouping's own exchange don't become more as the data grow.  Without pieces map tasks aggregate first.
    """
    return rows.repartition(pieces, *keys) if pieces else rows


def conditional_sums(cases: Mapping[str, Column], value: Column | str, default: int | None = 0) -> list[Column]:
    """One sum per named condition, to be used in a single aggregation."""
    return [sum_if(cond, value, default).alias(name) for name, cond in cases.items()]


def attributes_wide(rows: DataFrame, entity: Sequence[str], key: str, value: str, names: Sequence[str]) -> DataFrame:
    """Key/value rows to one row per entity.  The keys are given, so no pass is spent on finding
    them; the largest value wins where a key repeats."""
    return rows.groupBy(*entity).agg(*[F.max(F.when(F.col(key) == n, F.col(value))).alias(n) for n in names])


def pivot_sums(df: DataFrame, keys: Sequence[str], column: str, values: Sequence, measure: str) -> DataFrame:
    """Pivot with listed values, in one grouping by the keys; absent combinations are 0."""
    cases = {str(v): F.col(column) == v for v in values}
    return df.groupBy(*keys).agg(*conditional_sums(cases, measure, None)).fillna(0)


def subtotals(df: DataFrame, outer: str, inner: str, aggs: Sequence[Column], label: str = "Total") -> DataFrame:
    """Rows per (outer, inner) and one subtotal per outer.  The grouping id tells a subtotal from a
    real NULL; the grand total is left out."""
    return (
        df.rollup(outer, inner)
        .agg(*aggs, F.grouping_id().alias("_level"))
        .filter(F.col("_level") < 3)
        .withColumn(inner, F.when(F.col("_level") == 1, F.lit(label)).otherwise(F.col(inner).cast("string")))
        .drop("_level")
    )


def with_grand_total(
    df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], label: str = "Total", flag: str = "is_total"
) -> DataFrame:
    """Grouped rows and one total row, from a single pass.  The flag comes from the grouping id, so a
    group that happens to bear the label is not taken for the total."""
    first, *rest = keys
    grouped = df.groupingSets([[F.col(k) for k in keys], []], *[F.col(k) for k in keys]).agg(
        *aggs, F.grouping_id().alias("_level")
    )
    is_total = F.col("_level") > 0
    return grouped.withColumns(
        {first: F.when(is_total, F.lit(label)).otherwise(F.col(first).cast("string")), flag: is_total}
    ).drop("_level")


def distinct_text(col: str, sep: str = ", ") -> Column:
    """Distinct values as one sorted string.  Use for attributes with few values per group."""
    return F.array_join(F.array_sort(F.collect_set(col)), sep)


def count_distinct(*cols: str | Column) -> Column:
    return F.countDistinct(*cols)


def at_extreme(value: str, order: Sequence[str], last: bool = True) -> Column:
    """Value at the first or last position of an order, NULL-safe and mergeable."""
    picked = (F.max if last else F.min)(F.struct(*order, F.col(value).alias("_value")))
    return picked["_value"]


def running_total(df: DataFrame, partition: Sequence[str], order: Sequence[str], measure: str, out: str) -> DataFrame:
    """Cumulative sum over an already aggregated frame."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(measure).over(w))


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The row with the highest order per key.

    An aggregate, not a ranking window: each map task forwards one candidate per key, so a key with a
    third of all rows does not end up in one sort.  With one order column (unique within the key) and
    columns of fixed width the aggregate is a hash aggregate; several order columns are compared as
    one struct.
    """
    if len(order) == 1:
        return df.groupBy(*keys).agg(*[F.max_by(c, order[0]).alias(c) for c in columns])
    best = F.max(F.struct(*order, *[c for c in columns if c not in order]))
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in columns])
