"""Order picking reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillroll.functions.text import hhmmss
from tillroll.operators import filters as flt
from tillroll.operators.aggregates import subtotals
from tillroll.operators.joins import next_event
from tillroll.operators.reshape import union_rows
from tillroll.plans.calendar import Bounds, within

# Order and line states.
PICK_START, PICK_STOP, LINE_CONFIRMED = 40, 50, 60
ORDER_OPEN = (10, 20)
LINE_OPEN, LINES_PICKED = 10, (60, 70, 80)


def start_stop_pairs(events: DataFrame, piece_size: int = 1_000_000) -> DataFrame:
    """Every picking start with the next stop and the next confirmed line of the same order.  The
    log number sets the order, so equal times do not matter."""
    status = F.col("status")
    stops = {"stopped_at": status == PICK_STOP, "confirmed_at": status == LINE_CONFIRMED}
    return next_event(events, "order_no", "tracking_no", status == PICK_START, stops, "created_at", ("picker",), piece_size)


def pick_times(events: DataFrame) -> DataFrame:
    """Start, stop and seconds per order and picker, with a subtotal row per order.

    A start without a stop falls back on the next confirmed line of the order, if that lies before the
    order's last start; a start with neither counts no time.
    """
    status, order = F.col("status"), "tracking_no"
    stamped = events.withColumn("at", F.struct(order, "created_at"))
    stops = {"stopped": status == PICK_STOP, "confirmed": status == LINE_CONFIRMED}
    pairs = next_event(stamped, "order_no", order, status == PICK_START, stops, "at", ("picker",), 1_000_000)
    last = events.filter(status == PICK_START).groupBy("order_no").agg(F.max(order).alias("last_start"))
    confirmed = F.when(F.col(f"confirmed.{order}") < F.col("last_start"), F.col("confirmed.created_at"))
    stop = F.coalesce(F.col("stopped.created_at"), confirmed)
    timed = pairs.join(last, "order_no").select("order_no", "picker", F.col("at.created_at").alias("created_at"), stop.alias("stop"))
    timed = timed.withColumn("seconds", F.unix_timestamp("stop") - F.unix_timestamp("created_at"))
    rows = subtotals(
        timed, "order_no", "picker",
        [F.min("created_at").alias("started"), F.max("stop").alias("stopped"), F.sum("seconds").alias("seconds_used")],
    )
    return rows.select(
        "order_no", "picker", "started", F.coalesce("stopped", "started").alias("stopped"),
        F.coalesce("seconds_used", F.lit(0)).alias("seconds_used"),
        hhmmss(F.coalesce("seconds_used", F.lit(0))).alias("time_used"),
    )


def pick_time_report(events: DataFrame) -> DataFrame:
    """Picking times with the confirmed lines and amount of each order."""
    delivered = events.filter(F.col("status") == LINE_CONFIRMED).groupBy("order_no").agg(
        F.count("*").alias("delivered_lines"), F.sum("amount").alias("delivered_amount")
    )
    return pick_times(events).join(delivered, "order_no")


def still_to_pick(orders: DataFrame, lines: DataFrame, articles: DataFrame, *, bounds: Bounds | None = None) -> DataFrame:
    """Ordered quantity of open lines per store and article."""
    waiting = orders if bounds is None else orders.filter(within("collect_date", bounds))
    waiting = waiting.filter(F.col("status").isin(*ORDER_OPEN)).select("order_no", "store_idx")
    open_lines = lines.filter(F.col("line_status") == LINE_OPEN)
    per_key = open_lines.join(waiting, "order_no").groupBy("store_idx", "article_idx").agg(F.sum("ordered_qty").alias("ordered_qty"))
    dim = articles.select("article_idx", "article_id", "article_name", "gtin", "unit_name")
    return per_key.join(dim, "article_idx").drop("article_idx")


def orders_of_article(orders: DataFrame, lines: DataFrame, *, article_idx: int | None = None) -> DataFrame:
    """Open lines per article, or of one article, with the number of substitutes linked to each."""
    open_lines = flt.when_set(lines.filter(F.col("line_status") == LINE_OPEN), "article_idx", article_idx)
    substitutes = lines.filter("is_substitute").groupBy("order_no", "link_no").agg(F.count("*").alias("substitutes"))
    heads = orders.select("order_no", "store_idx", "cashier_name", "collect_date")
    return (
        open_lines.select("order_no", "line_no", "link_no", "article_idx", "ordered_qty").join(substitutes, ["order_no", "link_no"], "left")
        .drop("link_no").join(heads, "order_no").fillna(0, ["substitutes"])
    )


def picking_differences(orders: DataFrame, lines: DataFrame, *, bounds: Bounds | None = None) -> DataFrame:
    """Quantity differences of picked lines, and price differences of the substitute linked to a line."""
    heads = orders if bounds is None else orders.filter(within("collect_date", bounds))
    heads = heads.select("order_no", "store_idx", "cashier_name", "collect_date")
    picked = lines.filter(F.col("line_status").isin(*LINES_PICKED))
    gap = F.col("received_qty") - F.col("ordered_qty")
    zero = F.lit(0).cast("decimal(13,2)")
    quantity = picked.filter(gap != 0).select(
        "order_no", "line_no", gap.cast("decimal(13,2)").alias("qty_diff"), zero.alias("price_diff"),
        (gap * F.col("line_price")).cast("decimal(26,4)").alias("result"),
    )
    new_line = lines.filter("is_substitute").select("order_no", "link_no", F.col("line_price").alias("new_price"))
    rise = F.col("new_price") - F.col("line_price")
    price = picked.filter(~F.col("is_substitute")).join(new_line, ["order_no", "link_no"]).filter(rise > 0).select(
        "order_no", "line_no", zero.alias("qty_diff"), rise.cast("decimal(13,2)").alias("price_diff"),
        (F.col("received_qty") * rise).cast("decimal(26,4)").alias("result"),
    )
    return union_rows(quantity, price).join(heads, "order_no")


def pick_list(orders: DataFrame, lines: DataFrame, articles: DataFrame, *, bounds: Bounds | None = None) -> DataFrame:
    """Open, unsubstituted lines by department and collection slot."""
    waiting = orders if bounds is None else orders.filter(within("collect_date", bounds))
    waiting = waiting.filter(F.col("status").isin(*ORDER_OPEN)).select("order_no", "store_idx", "collect_start")
    todo = lines.filter((F.col("line_status") == LINE_OPEN) & ~F.col("is_substitute"))
    dim = articles.select("article_idx", "article_id", "article_name", "unit_name", F.col("lev2_name").alias("department"))
    slot = F.concat_ws("-", F.date_format("collect_start", "HH:mm"), F.date_format(F.expr("collect_start + interval 1 hour"), "HH:mm"))
    return todo.join(waiting, "order_no").join(dim, "article_idx", "left").groupBy(
        "order_no", "store_idx", "department", slot.alias("slot"), "article_id", "article_name", "unit_name", "ordered_qty"
    ).agg(F.count("*").alias("line_count"))


def not_picked(orders: DataFrame, lines: DataFrame, articles: DataFrame, *, order_status: int) -> DataFrame:
    """Lines left open on orders in a given state."""
    heads = orders.filter(F.col("status") == order_status).select("order_no", "store_idx")
    left = lines.filter(F.col("line_status") == LINE_OPEN).join(heads, "order_no")
    per_key = left.groupBy("store_idx", "order_no", "article_idx").agg(F.sum("ordered_qty").alias("ordered_qty"))
    return per_key.join(articles.select("article_idx", "article_id", "article_name", "unit_name"), "article_idx").drop("article_idx")


def order_overview(orders: DataFrame, lines: DataFrame, *, order_status: int) -> DataFrame:
    """Ordered quantity and line count per order in a given state."""
    heads = orders.filter(F.col("status") == order_status).select("order_no", "store_idx", "cashier_name", "collect_date")
    per_order = lines.join(heads.select("order_no"), "order_no", "left_semi").groupBy("order_no").agg(
        F.sum("ordered_qty").alias("ordered_qty"), F.count("*").alias("line_count")
    )
    return heads.join(per_order, "order_no")


def pickup_by_flight(orders: DataFrame, *, flights, low: int = 50, high: int = 59) -> DataFrame:
    """Orders ready for pickup on the listed flights."""
    ready = orders.filter(F.col("status").between(low, high))
    return flt.in_list(ready, "flight_no", flights).select(
        "store_idx", "order_no", "cashier_name", "flight_no", "collect_date", F.date_format("collect_start", "HH:mm").alias("collect_time")
    )
