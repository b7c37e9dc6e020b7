"""Picking times from the live status log."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tillroll.plans.picking import PICK_START, PICK_STOP
from tillroll.streaming import state

PAIR = "order_no string, tracking_no bigint, created_at timestamp_ntz, stopped_at timestamp_ntz"


class OpenStarts(StatefulProcessor):
    """Pairs each start of an order with its next stop; the state of an order is its open starts.

    A start is passed on without stop when it is seen, and again with its stop.  With ``patience``, an
    order whose starts have waited that long by the log's own clock is given up: its state goes.
    """

    def __init__(self, patience_ms: int | None = None) -> None:
        self._patience = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getListState("open", "tracking_no bigint, created_at timestamp_ntz")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        lines = sorted((r.tracking_no, r.created_at, r.status == PICK_START) for r in rows)
        if all(starts for _, _, starts in lines):  # nothing is closed: they join those that wait, whichever these are
            waiting = [(number, at) for number, at, _ in lines]
            for number, at in waiting:
                yield Row(order_no=key[0], tracking_no=number, created_at=at, stopped_at=None)
            self._open.appendList(waiting)
        else:
            waiting = [tuple(r) for r in self._open.get()]
            before = list(waiting)
            for number, at, starts in lines:
                if starts:
                    waiting.append((number, at))
                    yield Row(order_no=key[0], tracking_no=number, created_at=at, stopped_at=None)
                    continue
                for start, begun in waiting:
                    if start < number:
                        yield Row(order_no=key[0], tracking_no=start, created_at=begun, stopped_at=at)
                waiting = [w for w in waiting if w[0] > number]
            if waiting != before:
                self._open.put(waiting) if waiting else self._open.clear()
        if self._patience is not None and waiting:
            for timer in list(self._handle.listTimers()):
                self._handle.deleteTimer(timer[0] if isinstance(timer, tuple | Row) else timer)
            self._handle.registerTimer(timerValues.getCurrentWatermarkInMs() + self._patience)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._open.clear()
        return iter(())

    def close(self) -> None:
        pass


def write_pairs(stream: DataFrame, target: str, checkpoint: str, patience: str | None = None) -> StreamingQuery:
    """Start and stop per picking, as soon as the stop is seen.

    Open starts are kept as state by order: a batch costs what its own lines cost, however many starts
    wait.  A start waits for its stop as long as it takes, or at least for ``patience`` (an interval such as
    ``30 days``) of the log's time, after which its state is dropped and it stays without stop.  The log of one order
    arrives in log order; how many lines of it come in one batch does not matter.  A new checkpoint
    over an old target reads the log again and leaves what is there: pairs that both know count once.
    """
    spark = stream.sparkSession
    lines = stream.filter(F.col("status").isin(PICK_START, PICK_STOP))
    at = F.col("created_at").cast("timestamp_ntz").alias("created_at")
    if patience is None:
        lines, mode, wait = lines.select("order_no", "tracking_no", at, "status"), "None", None
    else:
        clock = F.col("created_at").cast("timestamp").alias("clock")
        lines = lines.select("order_no", "tracking_no", at, "status", clock).withWatermark("clock", "0 seconds")
        wait = spark.range(1).select((F.unix_timestamp(F.expr(f"timestamp'1970-01-02' + interval {patience}")) - F.unix_timestamp(F.expr("timestamp'1970-01-02'"))) * 1000).first()[0]
        mode = "EventTime"
    with state.keyed_state(spark):
        pairs = lines.groupBy("order_no").transformWithState(OpenStarts(wait), PAIR, "Append", mode)
        return state.write_batches(pairs, target, checkpoint)


def picking_pairs(spark, target: str) -> DataFrame:
    """All starts so far, with the stop where one was seen."""
    rows = state.written_rows(spark, target, PAIR)
    return rows.groupBy("order_no", "tracking_no").agg(F.min("created_at").alias("started_at"), F.min("stopped_at").alias("stopped_at"))


def compact_pairs(spark, target: str, pieces: int = 1) -> int:
    """Puts the folders of finished batches together; returns how many."""
    return state.compact(spark, target, PAIR, pieces)
