"""Price lists, attributes and article listings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tillroll.operators import filters as flt
from tillroll.operators.aggregates import attributes_wide, distinct_text
from tillroll.plans.compare import CAMPAIGN_COLUMNS
from tillroll.plans.stock import signed_qty


def hierarchy_nodes(articles: DataFrame) -> DataFrame:
    """First- and second-level groups as (node, name, parent); a second-level node is identified
    together with its parent."""
    upper = articles.select(
        F.col("lev1_id").alias("node_id"), F.col("lev1_name").alias("node_name"), F.lit(None).cast("string").alias("parent_id")
    ).distinct()
    lower = articles.filter(F.col("lev2_id").isNotNull()).select(
        F.col("lev2_id").alias("node_id"), F.col("lev2_name").alias("node_name"), F.col("lev1_id").alias("parent_id")
    ).distinct()
    return upper.unionByName(lower)


def branch_price_list(articles: DataFrame, text: str) -> DataFrame:
    """Articles one level below the groups whose name contains a text, with their prices."""
    members = flt.branch_members(hierarchy_nodes(articles), text).select(
        F.col("node_id").alias("lev2_id"), F.col("parent_id").alias("lev1_id")
    )
    return articles.join(members, ["lev1_id", "lev2_id"], "left_semi").select(
        "article_id", "article_name", "lev2_name", F.coalesce(F.nullif("retail_price", F.lit(0).cast("decimal(12,2)")), F.lit(0)).alias("sales_price")
    )


def store_attributes(stores: DataFrame, attributes: DataFrame, names: Sequence[str]) -> DataFrame:
    """Stores with their key/value attributes as columns."""
    wide = attributes_wide(attributes, ["store_idx"], "key", "value", names)
    return stores.join(wide, "store_idx").select("store_id", "store_name", "lev1_region_name", *names)


def supplier_attributes(suppliers: DataFrame, attributes: DataFrame, stores: DataFrame, names: Sequence[str]) -> DataFrame:
    """Suppliers with attributes as columns and the name of their home store."""
    wide = attributes_wide(attributes, ["supplier_idx"], "key", "value", names)
    home = stores.select(F.col("store_idx").alias("supplier_store_idx"), F.col("store_name").alias("home_store"))
    return suppliers.join(home, "supplier_store_idx", "left").join(wide, "supplier_idx", "left").select(
        "supplier_id", "supplier_name", "home_store", *names
    )


def article_list(
    articles: DataFrame, sales: DataFrame, moves: DataFrame, *, as_of: dt.date, since: dt.date
) -> DataFrame:
    """Articles with price, assortment dates, stock on hand and the campaigns running now.

    Campaigns are listed per article after de-duplication, so the string is bounded by the number of
    campaigns.
    """
    campaign = F.coalesce(*CAMPAIGN_COLUMNS)
    running = sales.filter(campaign.isNotNull()).groupBy(campaign.alias("campaign_no")).agg(
        F.min("sale_date").alias("valid_from"), F.max("sale_date").alias("valid_to")
    ).filter(flt.active_on(as_of)).select("campaign_no")
    pairs = sales.filter(campaign.isNotNull() & (F.col("sale_date") >= F.lit(since))).select("article_idx", campaign.alias("campaign_no")).distinct()
    campaigns = pairs.join(running, "campaign_no", "left_semi").groupBy("article_idx").agg(
        distinct_text(F.lpad(F.col("campaign_no").cast("string"), 2, "0"), "| ").alias("campaigns")
    )
    assortment = sales.groupBy("article_idx").agg(F.min("sale_date").alias("assortment_from"), F.max("sale_date").alias("assortment_to"))
    stock = moves.groupBy("article_idx").agg(F.sum(signed_qty()).alias("in_stock_qty"))
    return (
        articles.join(assortment, "article_idx", "left").join(stock, "article_idx", "left").join(campaigns, "article_idx", "left")
        .select(
            "article_id", F.translate("article_name", ",", "|").alias("article_name"), "gtin", F.col("retail_price").alias("sales_price"),
            "assortment_from", "assortment_to", F.coalesce("in_stock_qty", F.lit(0)).alias("in_stock_qty"), F.coalesce("campaigns", F.lit("")).alias("campaigns"),
        )
    )
