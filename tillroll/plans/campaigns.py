"""Campaign reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tillroll.functions.money import net_qty_sum, sum_if, unit_value
from tillroll.operators import filters as flt
from tillroll.operators.aggregates import distinct_text
from tillroll.operators.joins import either_key
from tillroll.operators.reshape import missing_categories, union_rows
from tillroll.plans.calendar import Bounds, within
from tillroll.plans.compare import CAMPAIGN_COLUMNS

# Which campaign kinds the profitability report covers.
DISCOUNTS_ONLY, PRICE_CUTS_ONLY, ALL_KINDS = 0, 1, 2


def campaign_profitability(
    rows: DataFrame, stores: DataFrame, articles: DataFrame, *, kinds: int = ALL_KINDS, campaigns=None, bounds: Bounds | None = None
) -> DataFrame:
    """Sales of campaign articles by kind, with sales and purchase price per item.  An article with
    single sales gets an empty mix-match row and the other way round."""
    kept = rows if bounds is None else rows.filter(within("sale_date", bounds))
    kept = flt.in_campaigns(kept, campaigns, CAMPAIGN_COLUMNS)
    priced = kept.withColumns(
        {
            "unit_price": unit_value(F.col("sales_amount"), F.col("qty_sold")),
            "unit_cost": unit_value(F.col("cost_amount"), F.col("qty_sold")),
        }
    )
    keys = ["store_idx", "article_idx", "unit_price", "unit_cost", "campaign_kind"]
    wanted = []
    if kinds in (DISCOUNTS_ONLY, ALL_KINDS):
        wanted.append(F.when(F.col("price_type") == 0, F.lit("Single")).when(F.col("combination_id").isNotNull(), F.lit("MixMatch")))
    if kinds in (PRICE_CUTS_ONLY, ALL_KINDS):
        wanted.append(F.when(F.col("reduction_id").isNotNull(), F.lit("PriceCut")))
    # A sale may count as a discount and as a price cut: one pass gives it to each kind it has.
    tagged = priced.withColumn("campaign_kind", F.explode(F.array_compact(F.array(*wanted))))
    found = tagged.groupBy(*keys).agg(F.sum("sales_amount").alias("sales_amount"), F.sum("qty_sold").alias("sold"))
    named = found.join(stores.select("store_idx", "store_name"), "store_idx").join(
        articles.select("article_idx", "article_id", "article_name"), "article_idx"
    ).drop("store_idx", "article_idx")
    if kinds == PRICE_CUTS_ONLY:
        return named
    pair = ["Single", "MixMatch"]
    having = named.filter(F.col("campaign_kind").isin(pair))
    return union_rows(named, missing_categories(having, ["store_name", "article_id", "article_name"], "campaign_kind", pair, named))


def campaign_quantities(
    rows: DataFrame, stores: DataFrame, articles: DataFrame, *, store_columns: Sequence[str], campaigns=None, direction: int = 0
) -> DataFrame:
    """Quantity per article and campaign, one column per listed store and their total."""
    kept = flt.in_campaigns(flt.in_direction(rows, direction), campaigns, CAMPAIGN_COLUMNS)
    campaign = F.coalesce(*CAMPAIGN_COLUMNS)
    per_key = kept.groupBy("article_idx", "store_idx", campaign.alias("campaign_no")).agg(
        net_qty_sum().alias("qty"), F.sum("qty_sold").alias("sold")
    )
    named = per_key.join(stores.select("store_idx", "store_id"), "store_idx").join(
        articles.select("article_idx", "article_name"), "article_idx"
    )
    listed = F.col("store_id").isin(list(store_columns))
    wide = [sum_if(F.col("store_id") == s, F.col("qty")).alias(f"store_{s}") for s in store_columns]
    return named.groupBy("article_name", "campaign_no").agg(
        *wide, sum_if(listed, F.col("qty")).alias("total"), F.sum("sold").alias("sold")
    ).filter(F.col("sold") > 0).drop("sold")


def campaign_listing(rows: DataFrame, stores: DataFrame, articles: DataFrame, *, bounds: Bounds) -> DataFrame:
    """Campaigns that started in the period: discount campaigns with every article they cover (by
    article or by group) and price cuts with their prices, each with its regions as one string."""
    number = F.coalesce(*CAMPAIGN_COLUMNS).alias("campaign_no")
    sold = rows.filter(F.coalesce(*CAMPAIGN_COLUMNS).isNotNull())
    spans = sold.groupBy(number).agg(F.min("sale_date").alias("valid_from"), F.max("sale_date").alias("valid_to")).filter(
        within("valid_from", bounds)
    )
    regions = (
        sold.select(number, "store_idx").distinct()
        .join(stores.select("store_idx", "lev1_region_name"), "store_idx")
        .groupBy("campaign_no").agg(distinct_text("lev1_region_name").alias("selected_regions"))
    )
    covered = sold.filter(F.col("combination_id").isNotNull()).select(number, F.col("article_idx").alias("item_idx")).distinct()
    groups = covered.join(articles.select(F.col("article_idx").alias("item_idx"), F.col("lev2_id").alias("item_group")), "item_idx")
    # An article and a group are rows of their own: each row then meets the articles by one key.
    discount = union_rows(
        covered.withColumn("item_group", F.lit(None).cast("string")),
        groups.filter(F.col("item_group").isNotNull()).select("campaign_no", F.lit(None).cast("bigint").alias("item_idx"), "item_group").distinct(),
    )
    dim = articles.select("article_idx", "article_id", "article_name", "brand_id", "lev1_name", "lev2_id", "lev2_name", "retail_price")
    by_discount = either_key(discount, dim, ("item_idx", "article_idx"), ("item_group", "lev2_id")).select(
        "campaign_no", F.lit("No").alias("promotion_price"), "article_id", "article_name", "brand_id",
        F.col("lev1_name").alias("category"), F.col("lev2_name").alias("sub_category"),
        F.col("retail_price").alias("ordinary_price"), F.lit(None).cast("decimal(18,4)").alias("campaign_price"),
    ).distinct()
    cuts = sold.filter(F.col("reduction_id").isNotNull() & (F.col("qty_sold") > 0)).groupBy(number, "article_idx").agg(
        F.max(F.col("sales_amount")).alias("campaign_price")
    )
    by_price = cuts.join(dim, "article_idx").select(
        "campaign_no", F.lit("Yes").alias("promotion_price"), "article_id", "article_name", "brand_id",
        F.col("lev1_name").alias("category"), F.col("lev2_name").alias("sub_category"),
        F.col("retail_price").alias("ordinary_price"), F.col("campaign_price").cast("decimal(18,4)").alias("campaign_price"),
    )
    listing = union_rows(by_discount, by_price)
    return listing.join(spans, "campaign_no").join(regions, "campaign_no", "left")
