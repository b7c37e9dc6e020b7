"""Stock adjustments, counts and end-of-day stock."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.functions.money import safe_div, signed, sum_if
from tillroll.operators import filters as flt
from tillroll.operators.aggregates import dealt, pieces_of
from tillroll.plans.calendar import Bounds, within

# Stock adjustment types.
TYPE_SALE, TYPE_LOSS, TYPE_COUNT, TYPE_DIFFERENCE = 1, 2, 51, 52

# Fixed values of the mapping: count line state "closed".
LINE_CLOSED = 80


def signed_qty() -> Column:
    return signed("qty", "sign")


def signed_cost() -> Column:
    return signed("cost_amount", "sign")


def destruction_by_reason(moves: DataFrame, articles: DataFrame, *, reasons, bounds: Bounds | None = None) -> DataFrame:
    """Quantities written off per article, cost and reason."""
    rows = moves if bounds is None else moves.filter(within("adj_date", bounds))
    rows = flt.in_list(rows.filter(F.col("type_no") == TYPE_LOSS), "reason_no", reasons)
    per_key = rows.groupBy("article_idx", "reason_no").agg(F.sum("qty").alias("qty"), F.sum("cost_amount").alias("cost_amount"))
    dim = articles.select("article_idx", "article_id", "article_name", "unit_name")
    return per_key.join(dim, "article_idx").drop("article_idx")


def shrinkage(moves: DataFrame, articles: DataFrame, *, report_type: int = 0, bounds: Bounds | None = None) -> DataFrame:
    """Counted quantity on the last count day, book quantity on the first, and the difference.

    First and last day per article come from the same pass: quantities are reduced per article and
    day, and the extremes are taken over those day rows.
    """
    rows = moves if bounds is None else moves.filter(within("adj_date", bounds))
    rows = rows.filter(F.col("type_no").isin(TYPE_COUNT, TYPE_DIFFERENCE))
    days = rows.groupBy("article_idx", "adj_date").agg(
        sum_if(F.col("type_no") == TYPE_COUNT, signed_qty()).alias("counted"),
        sum_if(F.col("type_no") == TYPE_DIFFERENCE, signed_qty()).alias("difference"),
    )
    last = F.max(F.struct("adj_date", "counted"))
    first = F.min(F.struct("adj_date", (F.col("counted") - F.col("difference")).alias("book")))
    per_article = days.groupBy("article_idx").agg(
        last["counted"].alias("counted_qty"), first["book"].alias("in_stock_qty"), F.sum("difference").alias("difference_qty")
    )
    if report_type == 1:
        per_article = per_article.filter(F.col("difference_qty") < 0)
    elif report_type == 2:
        per_article = per_article.filter(F.col("difference_qty") > 0)
    dim = articles.select(
        "article_idx", "article_id", "article_name", F.coalesce("lev2_id", "lev1_id").alias("group_id"),
        F.coalesce("lev2_name", "lev1_name").alias("group_name"), "unit_name",
    )
    return per_article.join(dim, "article_idx").drop("article_idx")


def end_of_day_stock(moves: DataFrame, stores: DataFrame, articles: DataFrame, *, store_ids=None, bounds: Bounds | None = None) -> DataFrame:
    """Net stock change per store, article and day."""
    rows = moves if bounds is None else moves.filter(within("adj_date", bounds))
    shops = flt.in_list(stores, "store_id", store_ids).select("store_idx", "store_id", "store_name")
    per_key = rows.groupBy("store_idx", "article_idx", "adj_date").agg(F.sum(signed_qty()).alias("qty"))
    return (
        per_key.join(shops, "store_idx").join(articles.select("article_idx", "article_id", "gtin"), "article_idx")
        .select("store_id", "store_name", "article_id", "gtin", "qty", F.col("adj_date").alias("status_date"))
    )


def stock_movements(moves: DataFrame, stores: DataFrame, articles: DataFrame, suppliers: DataFrame, *, bounds: Bounds | None = None) -> DataFrame:
    """Daily movement per store, article, supplier, type and reason with cost per unit; dimensions
    that are unknown stay in the list without a name."""
    rows = moves if bounds is None else moves.filter(within("adj_date", bounds))
    per_key = rows.groupBy("store_idx", "article_idx", "supplier_idx", "adj_date", "type_no", "reason_no").agg(
        F.sum(signed_qty()).alias("qty"), F.sum(signed_cost()).alias("cost")
    )
    shops = flt.known_members(stores, "store_idx").select("store_idx", "store_name")
    goods = flt.known_members(articles, "article_idx").select("article_idx", "article_id", "article_name", "gtin")
    makers = flt.known_members(suppliers, "supplier_idx").select("supplier_idx", "supplier_name")
    return (
        per_key.join(shops, "store_idx", "left").join(goods, "article_idx", "left").join(makers, "supplier_idx", "left")
        .withColumn("unit_cost", safe_div(F.col("cost"), F.col("qty"), "one"))
        .select("store_name", "article_id", "article_name", "gtin", "supplier_name", "adj_date", "type_no", "reason_no", "qty", "unit_cost")
    )


def wastage_extract(moves: DataFrame, articles: DataFrame, *, loss_reasons: Sequence[int], bounds: Bounds | None = None) -> DataFrame:
    """Losses beside sales per day and article, for articles that had a loss in the period."""
    rows = moves if bounds is None else moves.filter(within("adj_date", bounds))
    rows = rows.filter(F.col("reason_no").isin(list(loss_reasons)))
    loss = F.col("type_no").isin(TYPE_LOSS, TYPE_DIFFERENCE)
    sale = F.col("type_no") == TYPE_SALE

    def total(cond: Column, value: Column, name: str) -> Column:
        return sum_if(cond, value).alias(name)

    sold_value, sold_cost = -signed("sales_value", "sign"), -signed_cost()
    days = rows.groupBy("adj_date", "article_idx").agg(
        total(F.col("type_no") == TYPE_LOSS, signed_cost(), "registered_loss_cost"),
        total(F.col("type_no") == TYPE_DIFFERENCE, signed_cost(), "unregistered_loss_cost"),
        total(loss, signed_qty(), "loss_qty"),
        total(loss, signed_cost(), "loss_cost"),
        total(sale, -signed_qty(), "sold_qty"),
        total(sale, sold_value, "sold_value"),
        total(sale, sold_cost, "sold_cost"),
    )
    lossy = rows.filter(loss & (signed_qty() != 0)).select("article_idx").distinct()
    dim = articles.select("article_idx", "article_id", "article_name", "gtin", "lev2_id", "lev2_name")
    return (
        days.join(lossy, "article_idx", "left_semi").join(dim, "article_idx")
        .withColumns(
            {
                "gross_profit": F.col("sold_value") - F.col("sold_cost"),
                "gross_realized": F.col("sold_value") - F.col("sold_cost") + F.col("loss_cost"),
            }
        )
        .drop("article_idx")
    )


# -- stock counts -----------------------------------------------------------------------------


def resolve_links(lines: DataFrame, links: DataFrame) -> DataFrame:
    """Lines of a pack counted as its linked article times the link quantity."""
    return lines.join(links, lines["article_idx"] == links["master_idx"], "left").select(
        *[c for c in lines.columns if c != "article_idx"],
        F.coalesce("linked_idx", "article_idx").alias("article_idx"),
        F.coalesce("link_qty", F.lit(1)).alias("link_qty"),
    )


def counted_as(links: DataFrame, articles: DataFrame) -> DataFrame:
    """The article that a line of ``article_idx`` counts as, and how many times: the linked one for a pack, else itself."""
    one = F.lit(1)
    packs = links.select(
        F.col("master_idx").alias("article_idx"), F.coalesce("linked_idx", "master_idx").alias("_as"), F.coalesce("link_qty", one).alias("link_qty")
    )
    linked = packs.join(articles.withColumnRenamed("article_idx", "_as"), "_as").drop("_as")
    return articles.join(packs, "article_idx", "left_anti").withColumn("link_qty", one).unionByName(linked)


def count_against_book(
    lines: DataFrame, links: DataFrame, articles: DataFrame, *, by_group: bool = False, only_changed: bool = False
) -> DataFrame:
    """Counted against book quantity and value per count, by article or by group.

    Packs are resolved among the articles, so the sums by count and article meet one table and are grouped once more.
    """
    closed = lines.filter(F.col("line_status") == LINE_CLOSED)
    pieces = pieces_of(closed, "count_no", "article_idx")
    per_line = dealt(closed, pieces, "count_no", "article_idx").groupBy("count_no", "article_idx").agg(
        F.sum("in_stock_qty").alias("in_stock"), F.sum("counted_qty").alias("counted")
    )
    names = ([] if by_group else ["article_id", "article_name"]) + ["lev3_id", "lev3_name"]
    named = per_line.join(counted_as(links, articles.select("article_idx", *names, "retail_price")), "article_idx").select(
        "count_no", *names, "retail_price",
        (F.col("in_stock") * F.col("link_qty")).alias("in_stock_qty"), (F.col("counted") * F.col("link_qty")).alias("counted_qty"),
    ).withColumns(
        {
            "in_stock_value": F.col("in_stock_qty") * F.col("retail_price"),
            "counted_value": F.col("counted_qty") * F.col("retail_price"),
        }
    )
    keys = ["count_no", "lev3_id", "lev3_name"] + ([] if by_group else ["article_id", "article_name"])
    sums = ("in_stock_qty", "counted_qty", "in_stock_value", "counted_value")
    # Groups are few, articles of a count about as many as the sums before.
    named = named if by_group else dealt(named, pieces, *keys)
    out = named.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], F.max("retail_price").alias("unit_cost"))
    if only_changed:
        out = out.filter(F.col("in_stock_qty") != F.col("counted_qty"))
    return out.withColumns(
        {
            "diff_qty": F.col("counted_qty") - F.col("in_stock_qty"),
            "diff_value": F.col("counted_value") - F.col("in_stock_value"),
        }
    )


def against_previous_count(lines: DataFrame, articles: DataFrame, *, count_no: int, level: str = "article_id") -> DataFrame:
    """Counted quantity and value of one count and their ratio to the count before it.

    The previous count number is a scalar over the lines before this count; both counts are then
    summed in one pass.
    """
    previous = lines.filter(F.col("count_no") < count_no).agg(F.max("count_no")).scalar()
    counted = lines.filter((F.col("counted_qty") != 0) & (F.col("count_no") <= count_no))
    here, before = F.col("count_no") == count_no, F.col("count_no") == previous
    per_article = counted.filter(here | before).groupBy("article_idx").agg(
        sum_if(here, F.col("counted_qty")).alias("now"),
        sum_if(before, F.col("counted_qty")).alias("then"),
        F.count_if(here).alias("lines"),
    )
    dim = articles.select("article_idx", F.col(level).alias("level_id"), "unit_name", "retail_price")
    grouped = per_article.join(dim, "article_idx").groupBy("level_id", "unit_name").agg(
        F.sum("now").alias("counted_qty"), F.sum("then").alias("previous_qty"),
        F.sum(F.col("now") * F.col("retail_price")).alias("counted_value"),
        F.sum(F.col("then") * F.col("retail_price")).alias("previous_value"),
        F.sum("lines").alias("lines"),
    )
    return grouped.filter(F.col("lines") > 0).select(
        "level_id", "unit_name", "counted_qty", "counted_value",
        safe_div(F.col("counted_qty"), F.col("previous_qty")).alias("qty_ratio"),
        safe_div(F.col("counted_value"), F.col("previous_value")).alias("value_ratio"),
    )


def sold_not_counted(moves: DataFrame, lines: DataFrame, articles: DataFrame, *, count_no: int, bounds: Bounds) -> DataFrame:
    """Articles sold in the period that a count does not contain."""
    sold = moves.filter((F.col("type_no") == TYPE_SALE) & within("adj_date", bounds)).groupBy("article_idx").agg(
        F.max("adj_date").alias("last_sold")
    )
    counted = lines.filter(F.col("count_no") == count_no).select("article_idx")
    dim = articles.select("article_idx", "article_id", "article_name", "gtin")
    return sold.join(counted, "article_idx", "left_anti").join(dim, "article_idx").select(
        "article_id", "article_name", "gtin", F.lit(0).alias("in_stock_qty"), "last_sold"
    )


def outside_assortment(moves: DataFrame, sales: DataFrame, articles: DataFrame, *, since) -> DataFrame:
    """Articles with stock that are not in the assortment (not sold since a day)."""
    stock = moves.groupBy("article_idx").agg(F.sum(signed_qty()).alias("stock_qty")).filter(F.col("stock_qty") > 0)
    assortment = sales.filter(F.col("sale_date") >= F.lit(since)).select("article_idx")
    return stock.join(assortment, "article_idx", "left_anti").join(articles, "article_idx").select(
        "article_id", F.translate("article_name", ",", "|").alias("article_name"), "stock_qty"
    ).distinct()
