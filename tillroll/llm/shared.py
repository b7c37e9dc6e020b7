"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillroll.sources.scratch import scratch_path

#: Space, tab, line feed, vertical tab, form feed, carriage return: what separates words.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again.

    It cuts the lineage: a lost executor costs the tasks it was running, not the work behind them.
    """
    path = f"{scratch_path(df.sparkSession)}-{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; empty for NULL."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def text_key(text: Column) -> Column:
    """With doc_id, the identity of a document row: rows that share both are repetitions."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def packed(docs: DataFrame) -> DataFrame:
    """All columns of a row as `doc`, so that no name of theirs clashes, beside its identity `id` and `key`."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("doc_id").alias("id"), text_key(F.col("text")).alias("key")
    )


def text_chunks(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces of a binary Arrow column: first row, bytes, and the offsets of the rows in them.

    A piece holds whole rows and about `most` bytes, more only where a single row is longer.
    """
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def _child_of_child(links: DataFrame) -> DataFrame:
    """Rows that show that the links aren't stars yet."""
    twice = links.groupBy("a").count().where("count > 1").select("a")
    return twice.union(links.select("a").join(links.select(F.col("b").alias("a")), "a", "left_semi"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the edges (a, b), whole numbers: one row (node, root) per node that has an edge.

    The root is the smallest node.  Each round links every node's larger neighbours to its smallest
    one, then its smaller neighbours to their smallest; a few rounds flatten any component to a
    star.  A round is made of partial minima and joins, so a node with very many edges is split
    like any skewed join, and each round is written to the shared folder.
    """
    links = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while not _child_of_child(links).isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = staged(moved.union(low.select("a", F.col("m").alias("b"))).distinct(), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """The frame with `position`, 0 upwards in the given order over all rows, written to the shared folder.

    Rows are dealt to ranges and numbered in each range; the ranges' row counts, one small row for
    each partition, give the first number of each.
    """
    from pyspark.sql import Window

    spark = df.sparkSession
    dealt = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    ranged = staged(dealt.withColumn("_inside", inside.cast("bigint")), name)
    sizes = sorted((r[0], r[1]) for r in ranged.groupBy("_part").count().collect())
    first, seen = [], 0
    for part, n in sizes:
        first.append((part, seen))
        seen += n
    starts = spark.createDataFrame(first, "_part int, _first bigint")
    return ranged.join(F.broadcast(starts), "_part").withColumn("position", F.col("_first") + F.col("_inside")).drop(
        "_part", "_first", "_inside"
    )
