"""Streaming queries, run to the end of the available log and compared with batch SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillroll.catalogue.registry import query
from tillroll.sources.mart import Mart
from tillroll.sources.scratch import scratch_path
from tillroll.streaming.live import LiveMart
from tillroll.streaming.orders import append_new_orders, loaded_orders
from tillroll.streaming.picking import picking_pairs, write_pairs


@query("t01_stream_new_orders", """
    SELECT order_no, tracking_no, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, status, picker FROM (
        SELECT *, row_number() OVER (PARTITION BY order_no ORDER BY tracking_no) AS rn FROM order_event) WHERE rn = 1""")
def _(m: Mart) -> DataFrame:
    base = scratch_path(m.spark)
    live = LiveMart(m.spark, m.directory)
    append_new_orders(live.order_events, f"{base}/orders", f"{base}/state").awaitTermination()
    return loaded_orders(m.spark, f"{base}/orders")


@query("t02_stream_picking_pairs", """
    SELECT order_no, tracking_no, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS started_at, strftime(stopped, '%Y-%m-%d %H:%M:%S') AS stopped_at FROM (
        SELECT *, (SELECT min_by(p.created_at, p.tracking_no) FROM order_event p WHERE p.order_no = s.order_no AND p.status = 50
                   AND p.tracking_no > s.tracking_no) AS stopped FROM order_event s WHERE status = 40)""")
def _(m: Mart) -> DataFrame:
    base = scratch_path(m.spark)
    live = LiveMart(m.spark, m.directory)
    write_pairs(live.order_events, f"{base}/pairs", f"{base}/state").awaitTermination()
    return picking_pairs(m.spark, f"{base}/pairs")
