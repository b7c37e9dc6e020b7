"""Unions, unpivots and gap filling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def union_rows(*frames: DataFrame) -> DataFrame:
    """Keep every row."""
    out = frames[0]
    for nxt in frames[1:]:
        out = out.unionByName(nxt)
    return out


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Collapse identical rows, within and across the inputs."""
    return union_rows(*frames).distinct()


def minus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of the left that the right does not have."""
    return left.subtract(right.select(*left.columns))


def padded_union_sum(frames: Sequence[DataFrame], keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Union of sources that each fill some measures, then one sum per key; a measure no source
    filled is 0."""
    padded = [
        f.select(*keys, *[(F.col(m) if m in f.columns else F.lit(0)).cast("decimal(28,4)").alias(m) for m in measures])
        for f in frames
    ]
    return union_rows(*padded).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def measures_as_rows(
    df: DataFrame, keep: Sequence[str], rows: Mapping[str, Mapping[str, Column]], name: str = "measure"
) -> DataFrame:
    """One output row per named measure: ``rows[measure][column]`` gives each value."""
    items = [
        F.struct(F.lit(label).alias(name), *[c.cast("double").alias(n) for n, c in values.items()])
        for label, values in rows.items()
    ]
    return df.select(*keep, F.explode(F.array(*items)).alias("_row")).select(*keep, "_row.*")


def ledger_lines(
    df: DataFrame, keep: Sequence[str], credit: Mapping[str, str], debit: Mapping[str, str], amount_type: str = "decimal(28,4)"
) -> DataFrame:
    """Wide daily totals to debit and credit lines in one pass over the totals."""
    zero = F.lit(0).cast(amount_type)

    def line(text: str, col: str, is_debit: bool) -> Column:
        amount = F.coalesce(F.col(col), F.lit(0)).cast(amount_type)
        return F.struct(
            (amount if is_debit else zero).alias("debit_amount"),
            F.lit(text if is_debit else "").alias("debit_text"),
            (zero if is_debit else amount).alias("credit_amount"),
            F.lit("" if is_debit else text).alias("credit_text"),
        )

    items = [line(t, c, False) for t, c in credit.items()] + [line(t, c, True) for t, c in debit.items()]
    return df.select(*keep, F.explode(F.array(*items)).alias("_line")).select(*keep, "_line.*")


def missing_categories(
    df: DataFrame, keys: Sequence[str], category: str, values: Sequence[str], like: DataFrame
) -> DataFrame:
    """Rows for the categories a key does not have, shaped like another frame with NULL measures.

    Each key is reduced to one flag per category (combined before the shuffle), so neither rows nor
    sets are gathered and the existing rows are not joined.
    """
    has = [F.max(F.col(category) == v).alias(f"_has_{i}") for i, v in enumerate(values)]
    flags = df.groupBy(*keys).agg(*has)
    absent = [F.when(~F.col(f"_has_{i}"), F.lit(v)) for i, v in enumerate(values)]
    added = flags.select(*keys, F.explode(F.array_compact(F.array(*absent))).alias(category))
    types = dict(like.dtypes)
    return added.select(*[F.col(c) if c in added.columns else F.lit(None).cast(types[c]).alias(c) for c in like.columns])


def fill_categories(df: DataFrame, keys: Sequence[str], category: str, values: Sequence[str]) -> DataFrame:
    """Make sure every key has every category; added rows carry NULL measures."""
    return df.unionByName(missing_categories(df, keys, category, values, df))
