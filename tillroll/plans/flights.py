"""Reports on sales linked to flights, and sales split by channel (all, collected, other)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tillroll.functions.labels import FLIGHT_TYPE, TRAVEL_TYPE, label_of
from tillroll.functions.money import net_amount_sum, net_qty_sum, whole_amounts
from tillroll.functions.text import split_list
from tillroll.operators import filters as flt
from tillroll.operators.joins import difference, latest_before
from tillroll.operators.ranking import top_then_sort
from tillroll.operators.reshape import union_rows
from tillroll.plans.calendar import Bounds, within

# Which sales a report covers.
ALL_SALES, COLLECTED_SALES, OTHER_SALES = 0, 1, 2


def flight_filter(rows: DataFrame, *, direction: int = 0, flights=None, airports=None) -> DataFrame:
    """Direction, flight numbers and airports (local or connected)."""
    kept = flt.in_list(flt.in_direction(rows, direction), "flight_no", flights)
    codes = split_list(airports)
    if codes is not None:
        kept = kept.filter(F.col("local_airport").isin(codes) | F.col("connected_airport").isin(codes))
    return kept


def flight_revenue(rows: DataFrame, articles: DataFrame, *, by_flight: bool, direction: int = 0, flights=None, airports=None) -> DataFrame:
    """Quantity, revenue and customers per article, and per flight where asked for."""
    whole, amounts = whole_amounts(rows)
    kept = flight_filter(whole, direction=direction, flights=flights, airports=airports)
    shown = F.concat(F.col("flight_no"), F.lit(" - "), F.col("connected_airport"))
    directed = F.trim("origin_code").isin("D", "A")
    flight = F.when(directed, shown).otherwise(F.col("flight_no"))
    kind = label_of("origin_code", FLIGHT_TYPE, "")
    none = F.lit(None).cast("string")
    per_key = kept.groupBy(
        (flight if by_flight else none).alias("flight_no"), (kind if by_flight else none).alias("flight_type"), "article_idx"
    ).agg(
        net_qty_sum().alias("sold"), net_amount_sum("sales_excl_vat", "return_excl_vat").alias("revenue"),
        F.count_if(F.col("line_no") == 1).alias("customers"),
    )
    per_key = amounts(per_key, "sold", "revenue")
    names = articles.select("article_idx", "article_name")
    return per_key.join(names, "article_idx").groupBy("flight_no", "flight_type", "article_name").agg(
        F.sum("sold").alias("sold"), F.sum("revenue").alias("revenue"), F.sum("customers").alias("customers")
    )


def group_quantities(rows: DataFrame, articles: DataFrame, *, direction: int = 0) -> DataFrame:
    """Quantity, units and revenue per second-level group of flight receipts."""
    whole, amounts = whole_amounts(rows)
    kept = flt.in_direction(whole, direction)
    per_article = amounts(kept.groupBy("article_idx").agg(
        net_qty_sum().alias("sold"), net_amount_sum("sales_excl_vat", "return_excl_vat").alias("revenue"),
        net_amount_sum().alias("revenue_incl_vat"),
    ), "sold", "revenue", "revenue_incl_vat")
    return _by_group(per_article, articles).filter(F.col("revenue_incl_vat") != 0)


def _by_group(per_article: DataFrame, articles: DataFrame) -> DataFrame:
    dim = articles.select(
        "article_idx", "unit_amount",
        flt.upper_level("num_levels", "lev1_id", "lev2_id", "Unknown").alias("group_id"),
        flt.upper_level("num_levels", "lev1_name", "lev2_name", "Unknown").alias("group_name"),
    )
    return per_article.join(dim, "article_idx").groupBy("group_id", "group_name").agg(
        F.sum("sold").alias("sold"), F.sum(F.col("sold") * F.col("unit_amount")).alias("units"),
        F.sum("revenue").alias("revenue"), F.sum("revenue_incl_vat").alias("revenue_incl_vat"),
    )


def collected_lines(orders: DataFrame, lines: DataFrame, *, direction: int = 0, bounds: Bounds | None = None) -> DataFrame:
    """Delivered lines of collected orders."""
    paid = orders if bounds is None else orders.filter(within("collect_date", bounds))
    paid = flt.in_direction(paid, direction, "flight_direction").select("order_no", "store_idx", "collect_date")
    return lines.filter(F.col("delivered_amount") != 0).join(paid, "order_no")


def channel_quantities(
    rows: DataFrame, orders: DataFrame, lines: DataFrame, articles: DataFrame, *, channel: int, direction: int = 0
) -> DataFrame:
    """Group quantities for all sales, for collected orders, or for the rest."""
    everything = group_quantities(rows, articles, direction=direction)
    if channel == ALL_SALES:
        return everything
    per_article = collected_lines(orders, lines, direction=direction).groupBy("article_idx").agg(
        F.sum("received_qty").alias("sold"), F.sum("delivered_amount").alias("revenue"),
        F.sum("delivered_amount").alias("revenue_incl_vat"),
    )
    collected = _by_group(per_article, articles)
    if channel == COLLECTED_SALES:
        return collected.filter(F.col("revenue") != 0)
    return difference(everything, collected, ["group_id"], ["sold", "units", "revenue", "revenue_incl_vat"]).select(
        "group_id", "group_name", "sold", "units", "revenue", "revenue_incl_vat"
    )


# -- revenue with last-sold date --------------------------------------------------------------


def last_sold(articles: DataFrame, sales: DataFrame) -> DataFrame:
    """Every article with its last day of sale; NULL where it never sold."""
    last = sales.groupBy("article_idx").agg(F.max("sale_date").alias("last_sold"))
    return articles.join(last, "article_idx", "left").select("article_idx", "article_id", "article_name", "lev2_name", "last_sold")


def article_revenue(rows: DataFrame) -> DataFrame:
    whole, amounts = whole_amounts(rows)
    return amounts(whole.groupBy("article_idx").agg(
        net_qty_sum().alias("sold"), net_amount_sum().alias("revenue"),
        (net_amount_sum() - F.sum("cost_amount")).alias("gross_profit"),
    ).filter(F.col("revenue") != 0), "sold", "revenue", "gross_profit")


def collected_revenue(orders: DataFrame, lines: DataFrame, sales: DataFrame, *, direction: int = 0, bounds: Bounds | None = None) -> DataFrame:
    """Collected revenue per article, costed at the latest purchase price of each article: that of its
    last sold row of the period.  A returned row carries its cost back and is no purchase price."""
    bought = sales.filter(F.col("qty_sold") > 0)
    bought = bought if bounds is None else bought.filter(within("sale_date", bounds))
    cost = latest_before(bought, ["article_idx"], ["sale_date", "receipt_idx"], ["cost_amount"], ["last_cost"])
    per_article = collected_lines(orders, lines, direction=direction, bounds=bounds).groupBy("article_idx").agg(
        F.sum("received_qty").alias("sold"), F.sum("delivered_amount").alias("revenue"), F.count("*").alias("lines")
    )
    return per_article.join(cost, "article_idx", "left").select(
        "article_idx", "sold", "revenue", (F.col("revenue") - F.col("last_cost") * F.col("lines")).alias("gross_profit")
    )


def revenue_with_last_sold(
    revenue: DataFrame, articles: DataFrame, sales: DataFrame, *, as_of: dt.date, zero_sale: bool = False, n: int | None = 50,
    article_ids=None,
) -> DataFrame:
    """Articles by revenue with the days since their last sale; or, in zero-sale mode, the articles
    without revenue in the period."""
    known = flt.in_list(last_sold(articles, sales), "article_id", article_ids)
    if zero_sale:
        listed = known.join(revenue, "article_idx", "left_anti").select(
            "*", *[F.lit(None).cast("decimal(28,4)").alias(c) for c in ("sold", "revenue", "gross_profit")]
        )
    else:
        listed = known.join(revenue, "article_idx")
    out = listed.withColumn("days_since", F.datediff(F.lit(as_of), "last_sold")).select(
        "article_name", "article_id", "lev2_name", "sold", "revenue", "gross_profit", "last_sold", "days_since"
    )
    return out if n is None else top_then_sort(out, "revenue", n, ["article_id"], ["lev2_name", "article_name"])


def channel_revenue(
    rows: DataFrame, orders: DataFrame, lines: DataFrame, sales: DataFrame, *, channel: int, direction: int = 0,
    bounds: Bounds | None = None,
) -> DataFrame:
    """Revenue per article for all sales, collected orders, or the rest (articles with a remaining
    quantity)."""
    kept = rows if bounds is None else rows.filter(within("sale_date", bounds))
    everything = article_revenue(flt.in_direction(kept, direction))
    if channel == ALL_SALES:
        return everything
    collected = collected_revenue(orders, lines, sales, direction=direction, bounds=bounds)
    if channel == COLLECTED_SALES:
        return collected
    rest = difference(everything, collected, ["article_idx"], ["sold", "revenue", "gross_profit"])
    return rest.filter(F.col("sold") != 0)


# -- flight sales export ----------------------------------------------------------------------


def flight_sales_export(rows: DataFrame, articles: DataFrame, stores: DataFrame) -> DataFrame:
    """Quantity and revenue per store, day, flight and first-level group, with a customer-count line
    per flight."""
    departure = F.col("origin_code") == "D"
    arrival = F.col("origin_code") == "A"
    local, connected = F.col("local_airport"), F.col("connected_airport")
    flight = [
        "store_idx", "sale_date", "flight_no",
        F.when(arrival, connected).otherwise(local).alias("origin"),
        F.when(departure, connected).otherwise(local).alias("destination"),
        label_of("origin_code", FLIGHT_TYPE, "Extra").alias("flight_type"),
        label_of("origin_code", TRAVEL_TYPE, "EXT").alias("travel_type"),
    ]
    keys = ["store_idx", "sale_date", "flight_no", "origin", "destination", "flight_type", "travel_type"]
    groups = rows.join(articles.select("article_idx", "lev1_id", "lev1_name"), "article_idx").groupBy(
        *flight, F.col("lev1_id").alias("group_id"), F.col("lev1_name").alias("group_name")
    ).agg(net_qty_sum().alias("sold"), net_amount_sum("sales_excl_vat", "return_excl_vat").alias("revenue"))
    customers = rows.filter(F.col("line_no") == 1).groupBy(*flight).agg(F.count("*").cast("decimal(28,4)").alias("revenue")).select(
        *keys, F.lit("9999").alias("group_id"), F.lit("**No of customers**").alias("group_name"),
        F.lit(0).cast("decimal(28,4)").alias("sold"), "revenue",
    )
    both = union_rows(groups, customers)
    return both.join(stores.select("store_idx", "store_name", "airport"), "store_idx").drop("store_idx")
