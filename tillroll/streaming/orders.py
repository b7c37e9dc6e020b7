"""Continuous append of orders that are not loaded yet."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll.sources.published import Published
from tillroll.streaming import state

SHAPE = "order_no string, tracking_no bigint, created_at timestamp_ntz, status int, picker string"


#: Lines that are gathered before the first ones are picked.
GATHERED = 100_000


def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of each order of a partition; that of a loaded order comes before all others."""
    best, waiting, rows = None, [], 0

    def picked() -> pa.Table:
        lines = pa.Table.from_batches(waiting) if best is None else pa.concat_tables([best, pa.Table.from_batches(waiting)])
        lines = lines.sort_by([("order_no", "ascending"), ("loaded", "descending"), ("tracking_no", "ascending")]).combine_chunks()
        order = lines["order_no"]
        return lines.filter(pc.fill_null(pa.chunked_array([pa.array([True]), *pc.not_equal(order[1:], order[:-1]).chunks]), True))

    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            rows += batch.num_rows
        if rows > max(GATHERED, best.num_rows if best is not None else 0):
            best, waiting, rows = picked(), [], 0
    if waiting:
        best = picked()
    yield from best.to_batches() if best is not None else ()


def append_new_orders(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append each order once, with its first log line.

    The lines of a batch are reduced to one for each order, and Spark's deduplication keeps which orders are loaded as state by order.
    A batch reads no target: it costs what its own lines cost, however much is loaded.  Only before the first batch
    of a new checkpoint the order numbers of the target are read; they are kept beside the checkpoint and stream in with that
    batch, as orders that earlier queries loaded.  A batch that is repeated after a failure meets the state it met before and
    replaces its own folder.
    """
    spark = stream.sparkSession
    lines = stream.select("order_no", "tracking_no", F.col("created_at").cast("timestamp_ntz").alias("created_at"), "status", "picker", F.lit(False).alias("loaded"))
    seen = _loaded_before(spark, target, checkpoint)
    if seen is not None:
        lines = lines.unionByName(seen)
    first = lines.repartition("order_no").mapInArrow(first_lines, f"{SHAPE}, loaded boolean")
    with state.keyed_state(spark):
        fresh = first.dropDuplicates(["order_no"]).filter(~F.col("loaded")).drop("loaded")
        return state.write_batches(fresh, target, checkpoint)


def _loaded_before(spark, target: str, checkpoint: str) -> DataFrame | None:
    """The orders loaded when the checkpoint began, as a stream; None if there were none then.  A checkpoint keeps the sources it began with."""
    seed, begun = Published(spark, f"{checkpoint}-loaded"), bool(Published(spark, checkpoint).children("offsets"))
    if not begun and not (batches := loaded_orders(spark, target)).isEmpty():
        row = batches.select("order_no").distinct().select("order_no", *[F.lit(None).cast(t).alias(c) for c, t in batches.dtypes[1:]], F.lit(True).alias("loaded"))
        row.write.mode("overwrite").parquet(seed.folder)
    if not seed.children():
        return None
    return spark.readStream.schema(f"{SHAPE}, loaded boolean").parquet(seed.folder)


def loaded_orders(spark, target: str) -> DataFrame:
    return state.written_rows(spark, target, SHAPE)


def compact_orders(spark, target: str, pieces: int = 1) -> int:
    """Puts the folders of finished batches together; returns how many."""
    return state.compact(spark, target, SHAPE, pieces)
