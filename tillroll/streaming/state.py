"""What the stateful streams share: their state store and the folders of their batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillroll.sources.published import Published

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries that start in here keep their state in a store that a batch reads and writes by key."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before) if before is not None else spark.conf.unset(_STORE)


def write_batches(found: DataFrame, target: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Each batch into a folder named by the query and its number: a batch that is run again replaces its own rows.

    The query's id lives in its checkpoint: it stays over restarts, and a new checkpoint has another.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        run_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        prepare(batch).write.mode("overwrite").parquet(f"{target}/data/run_id={run_id}/batch_id={batch_id}")

    return found.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def batch_folders(published: Published) -> list[str]:
    """Folders of all batches below the target, without those whose rows a compaction has taken over."""
    replaced = set(published.read().get("replaced", []))
    found = [f"data/{run}/{batch}" for run in published.children("data") for batch in published.children(f"data/{run}") if "=" in batch]
    return [f for f in found if f not in replaced]


def written_rows(spark: SparkSession, target: str, shape: str) -> DataFrame:
    """All rows written so far."""
    published = Published(spark, target)
    folders = [*published.read().get("compacted", []), *batch_folders(published)]
    if not folders:
        return spark.createDataFrame([], shape)
    return spark.read.schema(shape).parquet(*[f"{target}/{f}" for f in folders])


def compact(spark: SparkSession, target: str, shape: str, pieces: int = 1) -> int:
    """Puts the batches' small folders together; returns how many.

    The newest batch of each run stays as it is, since a restart may write it again.  Readers see the
    old folders until the new one is published; the old ones are left for those who still read them.
    """
    published = Published(spark, target)
    base = published.version()
    state = published.read(base)
    old = []
    for run in published.children("data"):
        batches = sorted((b for b in published.children(f"data/{run}") if "=" in b), key=lambda b: int(b.split("=")[1]))
        old += [f"data/{run}/{b}" for b in batches[:-1]]
    replaced = set(state.get("replaced", []))
    old = [f for f in old if f not in replaced]
    if len(old) < 2:
        return 0
    name = f"compacted/v{base + 1:010d}-{spark.sparkContext._jvm.java.util.UUID.randomUUID()}"
    spark.read.schema(shape).parquet(*[f"{target}/{f}" for f in old]).repartition(pieces).write.parquet(f"{target}/{name}")
    published.publish(base, {"replaced": sorted(replaced | set(old)), "compacted": [*state.get("compacted", []), name]})
    return len(old)
