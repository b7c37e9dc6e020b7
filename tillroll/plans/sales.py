"""Sales and margin reports.

The fact is reduced to its surrogate keys before it meets a dimension: whatever the size of the
article or store table, the shuffle carries one row per key and map task instead of every sale.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.functions.money import net_amount_sum, net_qty, net_qty_sum, safe_div, sum_if, whole_amounts
from tillroll.functions.text import blank_to_null
from tillroll.functions.weeks import iso_week, weekday_no
from tillroll.operators import filters as flt
from tillroll.operators.ranking import top_by_name, top_n
from tillroll.plans.calendar import Bounds, Period, within

def measures() -> dict[str, Column]:
    """Additive measures of the sales fact, as sums."""
    revenue = net_amount_sum("sales_excl_vat", "return_excl_vat")
    return {
        "quantity": net_qty_sum(),
        "revenue_incl_vat": net_amount_sum(),
        "revenue": revenue,
        "gross_profit": revenue - F.sum("cost_amount"),
        "price": net_amount_sum("list_amount", "return_amount"),
        "cost_of_goods": F.sum("cost_amount"),
        "revenue_vat": net_amount_sum("sales_vat", "return_vat"),
    }


def reduce_to(fact: DataFrame, *keys: str | Column) -> DataFrame:
    """First step: all measures per surrogate key, with the price-source flags."""
    derived, used = (F.col("line_status") == "F").cast("int"), (F.col("price_type") == 0).cast("int")
    whole, amounts = whole_amounts(fact)
    return amounts(
        whole.groupBy(*keys).agg(
            *[total.alias(n) for n, total in measures().items()],
            F.min(derived).alias("use_derived"),
            F.min(used).alias("min_derived_used"),
            F.max(used).alias("max_derived_used"),
        ),
        *measures(),
    )


def regroup(reduced: DataFrame, *keys: str | Column) -> DataFrame:
    """Second step: the same measures per report group."""
    return reduced.groupBy(*keys).agg(
        *[F.sum(n).alias(n) for n in measures()],
        F.min("use_derived").alias("use_derived"),
        F.min("min_derived_used").alias("min_derived_used"),
        F.max("max_derived_used").alias("max_derived_used"),
    )


def price_source_sum() -> Column:
    """Indicator whether derived prices were used for none, some or all rows."""
    return F.col("use_derived") + F.col("min_derived_used") + F.col("max_derived_used")


def price_source_product() -> Column:
    return F.col("use_derived") + F.col("use_derived") * (F.col("min_derived_used") + F.col("max_derived_used"))


def in_group(articles: DataFrame, group: str | None) -> DataFrame:
    """Articles under a group on any level."""
    if group is None or group == "-1":
        return articles
    levels = F.array("lev1_id", "lev2_id", "lev3_id")
    return articles.filter(F.array_contains(F.filter(levels, lambda x: x.isNotNull()), group))


# -- top and bottom sellers -------------------------------------------------------------------


def top_articles(
    sales: DataFrame, articles: DataFrame, *, bounds: Bounds | None = None, supplier_idx: int | None = None,
    group: str | None = None, order_by: str = "TopNetSales", n: int = 50,
) -> DataFrame:
    """Best or worst articles by one measure, third-party articles left out."""
    rows = sales if bounds is None else sales.filter(within("sale_date", bounds))
    rows = flt.when_set(rows, "supplier_idx", supplier_idx)
    own = in_group(articles.filter(~F.col("is_third_party")), group).select("article_idx", "article_name", "gtin")
    per_article = reduce_to(rows, "article_idx").join(own, "article_idx")
    totals = per_article.groupBy("article_name", "gtin").agg(
        F.sum("quantity").alias("sold_qty"), F.sum("revenue").alias("net_sales"), F.sum("gross_profit").alias("gross_profit")
    )
    return top_by_name(totals, order_by, n, ["article_name", "gtin"])


def top_articles_by_store(
    rows: DataFrame, stores: DataFrame, articles: DataFrame, *, direction: int = 0, group: str | None = None,
    order_by: str = "TopNetSales", n: int = 50,
) -> DataFrame:
    """Best articles per chosen store and flight direction.  The stores are chosen among the receipts,
    before these meet their rows."""
    kept = flt.in_stores(flt.in_direction(rows, direction), stores)
    own = in_group(articles.filter(~F.col("is_third_party")), group).select("article_idx", "article_name", "gtin")
    named = stores.select("store_idx", "store_id", "store_name")
    per_key = reduce_to(kept, "store_idx", "article_idx").join(named, "store_idx").join(own, "article_idx")
    totals = per_key.groupBy("store_id", "store_name", "article_name").agg(
        F.max("gtin").alias("gtin"), F.sum("quantity").alias("sold_qty"), F.sum("revenue").alias("net_sales"),
        F.sum("gross_profit").alias("gross_profit"),
    )
    return top_by_name(totals, order_by, n, ["store_id", "article_name"])


# -- grouping by a chosen dimension -----------------------------------------------------------


def _article_groups() -> dict[str, tuple[Column, Column]]:
    leaf_id = flt.leaf_level("num_levels", ("lev1_id", "lev2_id", "lev3_id"), "None")
    leaf_name = flt.leaf_level("num_levels", ("lev1_name", "lev2_name", "lev3_name"), "None")
    manufacturer = F.coalesce(blank_to_null("brand_id"), F.lit("-1"))
    return {
        "Article": (F.col("article_id"), F.col("article_name")),
        "Lev1ArticleHierarchy": (F.col("lev1_id"), F.col("lev1_name")),
        "Lev2ArticleHierarchy": (F.col("lev2_id"), F.col("lev2_name")),
        "Lev3ArticleHierarchy": (F.col("lev3_id"), F.col("lev3_name")),
        "LeafArticleHierarchy": (leaf_id, leaf_name),
        "Manufacturer": (manufacturer, F.concat(manufacturer, F.lit(" - maker"))),
    }


def sales_by_choice(
    sales: DataFrame, articles: DataFrame, group_by: str, *, bounds: Bounds | None = None,
    weekdays: Sequence[bool] = (True,) * 7, article_label: str | None = None, stores: DataFrame | None = None,
) -> DataFrame:
    """Sales, margin and cost by one caller-chosen dimension; groups without revenue and quantity
    are left out."""
    rows = sales if bounds is None else sales.filter(within("sale_date", bounds))
    rows = flt.on_weekdays(rows, "sale_date", weekdays)
    choices = _article_groups()
    if group_by == "StoreGroup":
        if stores is None:
            raise ValueError("grouping by store group needs the store frame")
        named = stores.select("store_idx", F.col("store_id").alias("id"), F.col("lev1_region_name").alias("name"))
        grouped = regroup(reduce_to(rows, "store_idx").join(named, "store_idx"), "id", "name")
    elif group_by == "WeekDay":
        grouped = reduce_to(
            rows, F.date_format("sale_date", "EEEE").alias("id"), F.date_format("sale_date", "EEEE").alias("name")
        )
    elif group_by in choices:
        ident, name = choices[group_by]
        kept = articles.filter(F.col("article_idx") != -1)
        if article_label is not None:
            pairs = [("lev1_id", "lev1_name"), ("lev2_id", "lev2_name"), ("lev3_id", "lev3_name"), ("article_id", "article_name")]
            kept = kept.filter(flt.matches_label(pairs, article_label))
        dim = kept.select("article_idx", ident.alias("id"), name.alias("name"))
        grouped = regroup(reduce_to(rows, "article_idx").join(dim, "article_idx"), "id", "name")
    else:
        raise ValueError(f"unknown grouping: {group_by}")
    return (
        grouped.filter((F.col("revenue_incl_vat") != 0) | (F.col("quantity") != 0))
        .withColumn("config", price_source_product())
        .drop("use_derived", "min_derived_used", "max_derived_used")
    )


def hierarchy_links(articles: DataFrame) -> DataFrame:
    """The article tree as links from node to parent: article, its levels as deep as they go, department.  Nodes are named by
    their kind and the path above them, so that equal ids under different groups stay apart."""
    def path(kind: str, *levels: str) -> Column:
        return F.concat(F.lit(f"{kind}|"), *[c for level in levels for c in (F.col(level), F.lit("|"))][:-1])

    chain = F.array_compact(F.array(
        F.concat(F.lit("article|"), F.col("article_idx").cast("string")), path("3", "lev1_id", "lev2_id", "lev3_id"), path("2", "lev1_id", "lev2_id"), path("1", "lev1_id"),
        F.concat(F.lit("department|"), F.substring("lev1_id", 1, 1)),
    ))
    steps = F.transform(F.sequence(F.lit(1), F.size("chain") - 1), lambda k: F.struct(F.element_at("chain", k).alias("node"), F.element_at("chain", k + 1).alias("parent")))
    return articles.select(chain.alias("chain")).select(F.inline(steps)).distinct()


def sales_by_any_level(sales: DataFrame, closure: DataFrame, *, bounds: Bounds | None = None) -> DataFrame:
    """Quantity and revenue of every node of the article tree, whatever its depth, from one grouping: sales are summed by article and
    each article counts once for each node above it."""
    rows = sales if bounds is None else sales.filter(within("sale_date", bounds))
    node = F.concat(F.lit("article|"), F.col("article_idx").cast("string"))
    per_article = reduce_to(rows, "article_idx").select(node.alias("node"), "quantity", "revenue_incl_vat")
    above = closure.filter(F.col("steps") > 0).select("node", "ancestor")
    return per_article.join(above, "node").groupBy("ancestor").agg(F.sum("quantity").alias("quantity"), F.sum("revenue_incl_vat").alias("revenue_incl_vat"))


def sales_across_chains(aggregate: DataFrame, articles: DataFrame, group_by: str) -> DataFrame:
    """Sales by article, first level or leaf over the rows of a stored rollup."""
    ident, name = _article_groups()[group_by]
    dim = articles.filter(F.col("article_idx") != -1).select("article_idx", ident.alias("id"), name.alias("name"))
    reduced = regroup(aggregate, "article_idx")
    return regroup(reduced.join(dim, "article_idx"), "id", "name").withColumn("config", price_source_product()).drop(
        "use_derived", "min_derived_used", "max_derived_used"
    )


def revenue_figures(
    sales: DataFrame, articles: DataFrame, suppliers: DataFrame, group_by: str, *, period: Period, as_of: dt.date,
    weekdays: Sequence[bool] = (True,) * 7, no_third_party: bool = False, no_deposit: bool = False,
    article_id: tuple = (None, None), gtin: tuple = (None, None), brand: tuple = (None, None), level1: tuple = (None, None),
) -> DataFrame:
    """Revenue figures by article, day, weekday, supplier, first level, month or week, with the full
    filter set."""
    rows = flt.on_weekdays(flt.in_period(sales, "sale_date", period, as_of), "sale_date", weekdays)
    kept = articles
    if no_third_party:
        kept = kept.filter(~F.coalesce("is_third_party", F.lit(False)))
    if no_deposit:
        kept = flt.exclude(kept, "article_type_id", DEPOSIT_TYPES)
    kept = flt.id_between(kept, "article_id", *article_id)
    if gtin != (None, None):
        kept = flt.id_between(kept, "gtin", *gtin)
    kept = flt.value_between(kept, "brand_id", *brand)
    kept = flt.value_between(kept, "lev1_id", *level1)
    day = F.col("sale_date")
    if group_by in ("Article", "ArticleHierarchy"):
        names = kept.select("article_idx", "article_name", "gtin", "lev1_name")
        per_article = reduce_to(rows, "article_idx").join(names, "article_idx")
        if group_by == "Article":
            out = regroup(per_article, F.col("article_name").alias("grouped_by"), "gtin")
        else:
            out = regroup(per_article, F.col("lev1_name").alias("grouped_by")).withColumn("gtin", F.lit(""))
    else:
        rows = rows.join(kept, "article_idx", "left_semi")
        keys = {
            "WeekDay": F.date_format(day, "yyyy-MM-dd"),
            "Day": F.concat(weekday_no(day).cast("string"), F.lit(" "), F.date_format(day, "EEEE")),
            "Month": (F.year(day) * 100 + F.month(day)).cast("string"),
            "Week": (F.extract(F.lit("YEAROFWEEK"), day) * 100 + iso_week(day)).cast("string"),
        }
        if group_by == "Supplier":
            named = suppliers.select("supplier_idx", "supplier_name")
            per = reduce_to(rows, "supplier_idx").join(named, "supplier_idx")
            out = regroup(per, F.col("supplier_name").alias("grouped_by"))
        elif group_by in keys:
            out = reduce_to(rows, keys[group_by].alias("grouped_by"))
        else:
            raise ValueError(f"unknown grouping: {group_by}")
        out = out.withColumn("gtin", F.lit(""))
    return out.withColumn("config", price_source_sum())


# Article types that are bottle deposits.
DEPOSIT_TYPES = (-98, -99, 130, 132, 133)


def revenue_drill_down(
    sales: DataFrame, articles: DataFrame, suppliers: DataFrame, group_by: str, filter_by: str, *, bounds: Bounds
) -> DataFrame:
    """Articles behind one row of the revenue figures."""
    rows = sales.filter(within("sale_date", bounds))
    kept = articles
    day = F.col("sale_date")
    if group_by == "ArticleHierarchy":
        kept = kept.filter(F.col("lev1_name") == filter_by)
    elif group_by == "Article":
        kept = kept.filter((F.col("article_name") == filter_by) | (F.col("article_id") == filter_by))
    elif group_by == "Supplier":
        rows = rows.join(suppliers.filter(F.col("supplier_name") == filter_by), "supplier_idx", "left_semi")
    elif group_by == "Month":
        rows = rows.filter(F.year(day) * 100 + F.month(day) == int(filter_by))
    elif group_by == "WeekDay":
        rows = rows.filter(day == dt.date.fromisoformat(filter_by))
    else:
        raise ValueError(f"unknown grouping: {group_by}")
    names = kept.select("article_idx", "article_name", "gtin")
    out = regroup(reduce_to(rows, "article_idx").join(names, "article_idx"), "article_name", "gtin")
    return out.withColumn("config", price_source_sum()).drop("use_derived", "min_derived_used", "max_derived_used")


# -- discounts --------------------------------------------------------------------------------


def price_overrides(rows: DataFrame, articles: DataFrame, *, price_types: Sequence[int]) -> DataFrame:
    """Sold rows whose price was overridden, with the discount given."""
    kept = flt.known_members(rows.filter(F.col("price_type").isin(list(price_types))), "article_idx")
    dim = articles.select("article_idx", "article_id", "article_name", "gtin", "lev3_id", "lev3_name")
    return kept.join(dim, "article_idx").select(
        "store_idx", "till_id", "date_key", "article_id", "gtin", "article_name",
        F.col("lev3_id").alias("group_no"), F.col("lev3_name").alias("group_name"),
        F.col("qty_sold").alias("qty"), F.col("list_amount").alias("normal_amount"), "sales_amount",
        (F.col("list_amount") - F.col("sales_amount")).alias("discount_amount"), "price_type", "cashier_name",
    )


# Fixed values of the mapping: discount kind by price type.
DISCOUNT_KINDS = {
    "line_discount": (1, 2),
    "mix_match": (5, 6, 7),
    "down_pricing": (8, 9),
    "campaign": (3, 4),
    "receipt_discount": (10,),
}


def discount_by_kind(sales: DataFrame, articles: DataFrame, *, bounds: Bounds | None = None, cap: int | None = None) -> DataFrame:
    """Discount amounts per month and article group, one column per kind of discount."""
    rows = sales if bounds is None else sales.filter(within("sale_date", bounds))
    rows = rows.filter((F.col("discount_amount") > 0) & (F.col("list_amount") > 0) & (net_qty() != 0))
    kinds = [
        sum_if(F.col("price_type").isin(*types), F.col("discount_amount")).alias(name)
        for name, types in DISCOUNT_KINDS.items()
    ]
    month = F.date_format("sale_date", "MMMM").alias("month_name")
    per_article = rows.groupBy(month, "article_idx").agg(*kinds)
    dim = articles.select("article_idx", "lev2_name")
    out = per_article.join(dim, "article_idx", "left").groupBy("month_name", "lev2_name").agg(
        *[F.sum(n).alias(n) for n in DISCOUNT_KINDS]
    )
    return out if cap is None else out.orderBy("month_name", F.asc_nulls_first("lev2_name")).limit(cap)


def discount_detail(rows: DataFrame, articles: DataFrame, stores: DataFrame, *, cap: int | None = None) -> DataFrame:
    """Discounts per month, store and article with the discount percent of each sale summed."""
    kept = rows.filter((F.col("discount_amount") > 0) & (F.col("list_amount") > 0) & (net_qty() != 0))
    percent = safe_div(F.col("list_amount") - F.col("sales_amount"), F.col("list_amount"), "null") * 100
    per_key = kept.groupBy(F.date_format("sale_date", "MMMM").alias("month_name"), "store_idx", "article_idx").agg(
        F.sum("qty_sold").alias("sold"), F.sum("list_amount").alias("normal_amount"),
        F.sum("sales_amount").alias("sales_amount"), F.sum("discount_amount").alias("discount_amount"),
        F.sum(percent.cast("decimal(18,6)")).alias("discount_percent"),
    )
    named = per_key.join(stores.select("store_idx", "store_name"), "store_idx").join(
        articles.select("article_idx", "article_name", "gtin"), "article_idx"
    )
    sums = ("sold", "normal_amount", "sales_amount", "discount_amount", "discount_percent")
    grouped = named.groupBy("month_name", "store_name", "gtin", "article_name").agg(*[F.sum(c).alias(c) for c in sums])
    return grouped if cap is None else grouped.orderBy("month_name", "store_name", "article_name", "gtin").limit(cap)


# -- listings and extracts --------------------------------------------------------------------


def daily_sales(sales: DataFrame, *, bounds: Bounds | None = None) -> DataFrame:
    """Daily quantities, amounts and average price."""
    rows = sales if bounds is None else sales.filter(within("sale_date", bounds))
    return rows.groupBy("sale_date").agg(
        F.sum("qty_sold").alias("sold"), F.sum("qty_return").alias("returned"),
        net_qty_sum(mode="moved").alias("movement"),
        F.sum("sales_excl_vat").alias("sales_excl_vat"), F.sum("return_excl_vat").alias("return_excl_vat"),
        safe_div(net_amount_sum("list_amount", "return_amount"), net_qty_sum()).alias("price"),
    )


def space_planning(rows: DataFrame, *, as_of: dt.date, weeks: int = 13) -> DataFrame:
    """Price, cost, movement, VAT rate and mark-down per store and article over the last full
    weeks."""
    period = Period("R", unit="W", start=-weeks, duration=weeks)
    kept = flt.in_period(rows, "sale_date", period, as_of)
    moved = net_qty_sum(mode="moved")
    sold_markdown = F.sum(F.col("list_amount") - F.col("sales_amount"))
    return kept.groupBy("store_idx", "article_idx", "vat_group").agg(
        safe_div(net_amount_sum("list_amount", "return_amount"), moved).alias("price"),
        safe_div(F.sum("cost_amount"), moved).alias("cost"),
        moved.alias("movement"),
        safe_div(sold_markdown, moved).alias("marked_down_value"),
    )


def sales_extract(sales: DataFrame, articles: DataFrame, *, bounds: Bounds | None = None, clearance: Sequence[int] = (8, 9)) -> DataFrame:
    """All sales and reduced-to-clear sales per day and article; only groups in which every measure
    is positive."""
    rows = sales if bounds is None else sales.filter(within("sale_date", bounds))
    dim = articles.select("article_idx", "article_id", "article_name", "gtin", "lev2_id", "lev2_name", "lev3_id", "lev3_name")

    # One scan: sums by whether a sale is a clearance, of which each counts as a sale and may count as clearance.
    flag = F.col("price_type").isin(list(clearance))
    parts = reduce_to(rows.withColumn("is_clearance", flag), "sale_date", "article_idx", "is_clearance")
    kinds = F.when(F.col("is_clearance"), F.array(F.lit("Sales"), F.lit("RTC"))).otherwise(F.array(F.lit("Sales")))
    both = parts.withColumn("description", F.explode(kinds)).groupBy("description", "sale_date", "article_idx").agg(
        *[F.sum(c).alias(c) for c in measures()]
    ).withColumn("unit_price", safe_div(F.col("price"), F.col("quantity")))
    for test in [F.col(c) > 0 for c in measures()] + [F.col("unit_price") > 0]:
        both = both.filter(test)
    return both.join(dim, "article_idx").drop("article_idx")


def bottom_groups(sales: DataFrame, articles: DataFrame, n: int) -> DataFrame:
    grouped = reduce_to(sales, "article_idx").join(articles.select("article_idx", "lev2_id"), "article_idx")
    totals = grouped.groupBy("lev2_id").agg(F.sum("revenue").alias("revenue"))
    return top_n(totals, "revenue", n, ["lev2_id"], descending=False)
