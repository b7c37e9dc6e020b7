"""Mixing sources to target weights by entropy balancing.

Wanted are rates r for the documents, as near as can be in relative entropy to taking each once,
such that the taken words of each source meet its target and no rate is above `most`.  The convex
dual has one variable per source; its solution tilts the rates exponentially by size:
r = min(most, exp(tilt * size / mean size of the source)).  Newton steps on the dual find the tilts.
Documents of one source and size have one rate, so the steps run on the table of (source, size)
with counts, which is made by one partial aggregation over the documents.

Rates become copies by systematic rounding: along the sizes of a source, from the largest down, what
the rates ask for is rounded to whole documents, and the remainder is carried to the next size.  Rank numbers in a cell are counted in sub-cells, so a cell of very many equal sizes is split.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.llm.shared import numbered, packed, staged, text_key, word_count

MOST = 3.0
WEIGHTS = (1.0, 2.0, 3.0)
#: Pieces of a cell of equal source and size whose documents are ranked apart.
SUBCELLS = 1024
#: Newton steps at most; each halves its bracket at least, so this also bounds the error.
STEPS = 60


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """sources (source, source_size) with target.

    The weights repeat over the sources in order of code points, NULL last.  All sizes are shared
    by weight; a source takes at most `most` times its size, and what is left is shared anew.  The
    share per unit of weight rises until all is given out: a few rounds of sums, one row each.
    """
    ordered = numbered(sources, [F.col("source").asc_nulls_last()], "sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    ordered = staged(ordered.withColumn("weight", weight), "weights")
    total = ordered.agg(F.sum("source_size")).first()[0] or 0
    share, before = 0.0, -1.0
    while share > before:
        full = F.lit(before >= 0) & (most * F.col("source_size") <= share * F.col("weight"))
        capped, free = ordered.agg(
            F.sum(F.when(full, most * F.col("source_size")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        before, share = share, (total - capped) / free if free else share
        if before == 0.0 and share == 0.0:
            break
    return ordered.select("source", "source_size", F.least(most * F.col("source_size"), share * F.col("weight")).alias("target"))


def tilts(cells: DataFrame, goals: DataFrame, most: float = MOST, tolerance: float = 1e-9, steps: int = STEPS) -> DataFrame:
    """goals (source, source_size, target) with mean and tilt of each source.

    cells: source, size, n.  A source whose target is `most` times its size, or nothing, has no
    finite tilt: all its rates are `most` or 0.  The Newton step is kept in a bracket that shrinks,
    so every source ends within the tolerance of its target.
    """
    key = F.col("source").eqNullSafe(F.col("_source"))
    counts = cells.where("size > 0").groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    counts = counts.withColumnRenamed("source", "_source")
    state = goals.join(counts, key, "left").drop("_source").select(
        "*", F.lit(-64.0).alias("low"), F.lit(64.0).alias("high"), F.lit(0.0).alias("tilt"),
        ((F.col("target") <= 0) | (F.col("target") >= most * F.col("source_size"))).alias("done"),
    )
    state = staged(state, "tilts")
    for _ in range(steps):
        open_ = state.where("not done").select(F.col("source").alias("_source"), "mean", "tilt")
        if open_.isEmpty():
            break
        z = F.col("size") / F.col("mean")
        rate = F.exp(F.least(F.col("tilt") * z, F.lit(50.0)))
        size = F.col("size") * F.col("n")
        sums = cells.where("size > 0").join(open_, key).groupBy("_source").agg(
            F.sum(size * F.least(rate, F.lit(most))).alias("taken"),
            F.sum(F.when(rate < most, size * rate * z).otherwise(0.0)).alias("slope"),
        )
        gap = F.col("taken") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap < 0, F.col("high")).otherwise(F.col("tilt"))
        newton = F.col("tilt") - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > low) & (newton < high)
        done = F.col("done") | (F.abs(gap) <= tolerance * F.col("target"))
        state = staged(
            state.join(sums, key, "left").select(
                "source", "source_size", "target", "mean",
                F.when(F.col("done"), F.col("low")).otherwise(low).alias("low"), F.when(F.col("done"), F.col("high")).otherwise(high).alias("high"),
                F.when(done, F.col("tilt")).when(inside, newton).otherwise((low + high) / 2).alias("tilt"), done.alias("done"),
            ),
            "tilts",
        )
    return state.select("source", "source_size", "target", "mean", "tilt")


def rate_of(size: Column, mean: Column, tilt: Column, target: Column, source_size: Column, most: float = MOST) -> Column:
    tilted = F.least(F.lit(float(most)), F.exp(F.least(tilt * size / mean, F.lit(50.0))))
    return F.when((size <= 0) | (target <= 0), 0.0).when(target >= most * source_size, float(most)).otherwise(tilted)


def _with_extra(cells: pd.DataFrame) -> pd.DataFrame:
    """How many documents of each cell of a source get one copy more than the whole part of their rate.

    From the largest size down, what the rates ask for so far less what was taken so far is rounded
    to documents of the cell; what remains goes on to smaller ones.  A source has as many cells as
    its texts have different lengths.
    """
    cells = cells.sort_values("size", ascending=False)
    owed, extra = 0.0, []
    for size, n, rate in zip(cells["size"], cells["n"], cells["rate"], strict=True):
        part = rate - math.floor(rate)
        owed += part * n * size
        more = min(n, max(0, math.floor(round(owed / size, 6) + 0.5))) if size and part else 0
        owed -= more * size
        extra.append(more)
    return cells.assign(extra=extra)[["source", "size", "source_size", "target", "rate", "extra"]]


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """doc_id, text_key, size, source_size, target, rate and copies of every document row.

    Documents without words, NULL or empty, take nothing and have no copies.  NULL is a source of
    its own.  Which of equal documents get a further copy depends on a hash of id and text, so
    reruns agree; repeated rows share what falls to them.  Other columns are ignored.
    """
    sized = staged(
        docs.select(F.col("doc_id"), F.col("source"), text_key(F.col("text")).alias("text_key"), word_count(F.col("text")).alias("size")), "sizes"
    )
    cells = staged(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    goals = targets(cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most)
    solved = tilts(cells, goals, most)
    named = solved.withColumnRenamed("source", "_source")
    rated = cells.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rated = rated.withColumn("rate", rate_of(F.col("size"), F.col("mean"), F.col("tilt"), F.col("target"), F.col("source_size"), most))
    rated = rated.select("source", "size", "n", "source_size", "target", F.round("rate", 9).alias("rate")).groupBy("source").applyInPandas(
        _with_extra, "source string, size bigint, source_size bigint, target double, rate double, extra bigint"
    )
    rated = staged(rated.select(F.col("source").alias("_source"), F.col("size").alias("_size"), "source_size", "target", "rate", "extra"), "rates")

    part = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(SUBCELLS)).alias("sub")
    sized = sized.select("*", part)
    subs = sized.groupBy("source", "size", "sub").agg(F.count("*").alias("n"))
    in_cell = Window.partitionBy("source", "size").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    subs = subs.select(F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("sub").alias("_b"), F.coalesce(F.sum("n").over(in_cell), F.lit(0)).alias("before"))
    ranked = sized.join(subs, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")) & (F.col("sub") == F.col("_b"))).drop("_s", "_z", "_b")
    within = F.row_number().over(Window.partitionBy("source", "size", "sub").orderBy(F.xxhash64("text_key", "doc_id"), "doc_id", "text_key"))
    ranked = ranked.withColumn("rank", F.col("before") + within - 1)
    joined = ranked.join(rated, F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size")))
    copies = F.floor("rate") + F.when(F.col("rank") < F.col("extra"), 1).otherwise(0)
    return joined.select("doc_id", "text_key", "source", "size", "source_size", "target", "rate", copies.cast("bigint").alias("copies"))


def repeated(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """The documents, each as often as the mix takes it, all columns kept."""
    wanted = mixed(docs, weights, most).groupBy("doc_id", "text_key", "source").agg(F.sum("copies").alias("copies"), F.count("*").alias("alike"))
    wanted = staged(wanted.where("copies > 0").withColumnsRenamed({"doc_id": "_id", "text_key": "_key", "source": "_source"}), "copies")
    rows = packed(docs).withColumn("source", F.col("doc.source"))
    same = rows["id"].eqNullSafe(wanted["_id"]) & (rows["key"] == wanted["_key"]) & rows["source"].eqNullSafe(wanted["_source"])
    met = rows.join(wanted, same)
    taken = met.where("alike = 1").select("doc", F.col("copies").alias("n"))
    if not wanted.where("alike > 1").isEmpty():
        # Rows that repeat each other share their copies, so that together they give the sum.
        nth = F.row_number().over(Window.partitionBy("_id", "_key", "_source").orderBy("_id"))
        more = met.where("alike > 1").withColumn("nth", nth)
        share = F.floor(F.col("copies") / F.col("alike")) + F.when(F.col("nth") <= F.col("copies") % F.col("alike"), 1).otherwise(0)
        taken = taken.union(more.select("doc", share.alias("n")).where("n > 0"))
    return taken.withColumn("each", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("doc.*")
