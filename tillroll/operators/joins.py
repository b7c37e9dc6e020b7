"""Join shapes.

Nothing is broadcast by hint.  Equi joins are left to the optimizer, which broadcasts a side only
below the session's size threshold; conditions that would end in a nested loop are split into equi
joins first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.sources.scratch import scratch_path


def full_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join with merged keys."""
    return left.join(right, list(keys), "full")


def full_chain(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of several sources; each step joins on the merged key."""
    out = frames[0]
    for nxt in frames[1:]:
        out = full_on(out, nxt, keys)
    return out


def with_totals(df: DataFrame, totals: DataFrame, name: str = "totals") -> DataFrame:
    """Attach a one-row frame to every row as a struct, through a scalar subquery (no join)."""
    return df.withColumn(name, totals.select(F.struct(*totals.columns)).scalar())


def single_row(frames: dict[str, DataFrame], df: DataFrame) -> DataFrame:
    """One row that carries each one-row frame as a struct, whether or not they hold values."""
    one = df.sparkSession.range(1).select()
    return one.select(*[f.select(F.struct(*f.columns)).scalar().alias(n) for n, f in frames.items()])


def either_key(left: DataFrame, right: DataFrame, first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """Inner join where either of two key pairs may match; a pair that matches on both counts once.

    The OR is split into two equi joins.  The second one drops pairs the first has found by testing
    the first condition, so no de-duplication shuffle is needed.
    """
    a, b = left.alias("a"), right.alias("b")
    on_first = F.col(f"a.{first[0]}") == F.col(f"b.{first[1]}")
    on_second = F.col(f"a.{second[0]}") == F.col(f"b.{second[1]}")
    columns = [F.col(f"a.{c}") for c in left.columns] + [
        F.col(f"b.{c}") for c in right.columns if c not in left.columns
    ]
    hit_first = a.join(b, on_first).select(*columns)
    hit_second = a.join(b, on_second & ~F.coalesce(on_first, F.lit(False))).select(*columns)
    return hit_first.unionByName(hit_second)


def first_match(
    df: DataFrame, primary: tuple[DataFrame, str, str], fallback: tuple[DataFrame, str, str], value: str, out: str
) -> DataFrame:
    """Look a value up by one key, and by a second key where the first finds nothing."""
    frame1, left1, right1 = primary
    frame2, left2, right2 = fallback
    one = frame1.select(F.col(right1).alias(left1), F.col(value).alias("_v1"))
    two = frame2.select(F.col(right2).alias(left2), F.col(value).alias("_v2"))
    return (
        df.join(one, left1, "left").join(two, left2, "left")
        .withColumn(out, F.coalesce("_v1", "_v2")).drop("_v1", "_v2")
    )


def next_event(
    events: DataFrame,
    key: str,
    order: str,
    is_start: Column,
    stops: Mapping[str, Column],
    value: str,
    passenger: Sequence[str] = (),
    piece_size: int = 1_000_000,
) -> DataFrame:
    """For every start row, the value at the first later stop row of the same key, for each named
    kind of stop in one pass.

    ``order`` is a unique log number.  One key may hold a large part of the log, so the log is cut
    into pieces of ``piece_size`` numbers: no window partition is larger than that, whatever the
    keys.  Inside a piece a window finds the next stop.  The stop after the piece is the first stop
    of a later piece: pieces are reduced to one row each before that second window, and the two
    answers are joined back on the piece.
    """
    wanted = is_start
    for is_stop in stops.values():
        wanted = wanted | is_stop
    found = {n: F.when(c, F.struct(F.col(order).alias("o"), F.col(value).alias("v"))) for n, c in stops.items()}
    base = events.filter(wanted).select(
        key, order, value, *passenger, F.floor(F.col(order) / piece_size).alias("_piece"), is_start.alias("_start"),
        *[c.alias(f"_stop_{n}") for n, c in found.items()],
    )
    # Read backwards, the next stop is the last one seen: a frame that only grows is linear.
    inside = Window.partitionBy(key, "_piece").orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    starts = base.select(
        "*", *[F.last(f"_stop_{n}", ignorenulls=True).over(inside).alias(f"_here_{n}") for n in stops]
    ).filter("_start")
    later = Window.partitionBy(key).orderBy(F.desc("_piece")).rowsBetween(Window.unboundedPreceding, -1)
    pieces = base.groupBy(key, "_piece").agg(*[F.min(f"_stop_{n}").alias(f"_first_{n}") for n in stops]).select(
        key, "_piece", *[F.last(f"_first_{n}", ignorenulls=True).over(later).alias(f"_after_{n}") for n in stops]
    )
    return starts.join(pieces, [key, "_piece"], "left").select(
        key, order, value, *passenger, *[F.coalesce(F.col(f"_here_{n}.v"), F.col(f"_after_{n}.v")).alias(n) for n in stops]
    )


def ancestors(links: DataFrame) -> DataFrame:
    """Every node with itself and each node above it, and the number of steps between: node, ancestor, steps.

    links: node and parent, any depth, several parents allowed.  Each round joins the pairs so far with themselves,
    which doubles the steps they span: a tree of depth d takes about log2(d) rounds, each written to the shared folder.
    A node is listed once per ancestor, with the fewest steps; links that run in a circle end there too.
    """
    spark = links.sparkSession
    given = links.filter(F.col("node").isNotNull() & F.col("parent").isNotNull()).select("node", "parent").distinct()
    own = given.select("node").union(given.select("parent")).distinct().select("node", F.col("node").alias("ancestor"), F.lit(0).alias("steps"))
    pairs, known = own.union(given.select("node", "parent", F.lit(1))), -1
    while True:
        path = f"{scratch_path(spark)}-ancestors"
        pairs.groupBy("node", "ancestor").agg(F.min("steps").alias("steps")).write.parquet(path)
        done = spark.read.parquet(path)
        found = done.count()
        if found == known:
            return done
        known = found
        upper = done.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("_top"), F.col("steps").alias("_more"))
        pairs = done.join(upper, "ancestor").select("node", F.col("_top").alias("ancestor"), (F.col("steps") + F.col("_more")).alias("steps"))


def in_periods(facts: DataFrame, periods: DataFrame, keys: Sequence[str], at: str, start: str, end: str) -> DataFrame:
    """Each fact with every period of its keys that it lies in: ``start`` <= ``at`` < ``end``.

    A period is entered under each day it touches and a fact under its own day, so the two meet by an equi
    join on keys and day; the exact moments decide.  Abutting periods share no fact, one that ends within a day takes only that
    part of the day, and an empty or reversed one takes none.
    """
    days = F.sequence(F.col(start).cast("date"), F.col(end).cast("date"))
    binned = periods.filter(F.col(start) < F.col(end)).withColumn("_day", F.explode(days))
    met = facts.withColumn("_day", F.col(at).cast("date")).join(binned, [*keys, "_day"])
    return met.filter((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("_day")


def latest_before(
    rows: DataFrame, key: Sequence[str], order: Sequence[str], values: Sequence[str], names: Sequence[str] | None = None
) -> DataFrame:
    """Values of the latest row per key, as an aggregate: partial results are combined before the
    shuffle, so a hot key costs one row per map task."""
    names = names or values
    picked = F.max(F.struct(*order, *[v for v in values if v not in order]))
    grouped = rows.groupBy(*key).agg(picked.alias("_last"))
    return grouped.select(*key, *[F.col(f"_last.{v}").alias(n) for v, n in zip(values, names)])


def difference(
    left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Left minus right per key; a key missing on the right subtracts nothing."""
    renamed = right.select(*keys, *[F.col(m).alias(f"_{m}") for m in measures])
    rest = [c for c in left.columns if c not in keys and c not in measures]
    return left.join(renamed, list(keys), "left").select(
        *keys, *rest, *[(F.col(m) - F.coalesce(F.col(f"_{m}"), F.lit(0))).alias(m) for m in measures]
    )
