"""Frames shaped for exported files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillroll.functions.money import net_amount_sum, net_qty_sum, signed, whole_amounts
from tillroll.functions.text import format_date, format_decimal, sql_len
from tillroll.functions.weeks import week_end, week_stamp
from tillroll.operators import filters as flt
from tillroll.plans.calendar import Bounds, within
from tillroll.plans.stock import signed_cost, signed_qty

# Report codes and the first line of the weekly sales file.
NORMAL_LINE, OFFER_LINE = "OVUN", "OVUT"
FILE_HEADER = "RIGAL95,6.0"


def down_pricing_export(rows: DataFrame, articles: DataFrame, stores: DataFrame, *, group, columns, bounds: Bounds | None = None, price_types=(8, 9)) -> DataFrame:
    """Down-priced sales of a store group per day and article, in the locale of the receiver."""
    kept = rows if bounds is None else rows.filter(within("sale_date", bounds))
    kept = kept.filter(F.col("price_type").isin(list(price_types)) & (F.col("qty_sold") != 0))
    chosen = flt.store_group(stores, group, columns).select("store_idx", "store_id")
    per_key = flt.in_stores(kept, chosen).groupBy("sale_date", "store_idx", "article_idx").agg(
        F.sum("cost_amount").alias("cost"), F.sum("qty_sold").alias("qty"), F.sum("discount_amount").alias("discount"),
        F.sum("sales_excl_vat").alias("net"), F.sum("sales_vat").alias("vat"),
    )
    named = per_key.join(chosen, "store_idx").join(articles.select("article_idx", "article_name", "gtin"), "article_idx")
    return named.select(
        format_date("sale_date").alias("sale_date"), "gtin", "article_name", *[format_decimal(c).alias(c) for c in ("cost", "qty", "discount", "net", "vat")], "store_id"
    )


def week_sales_lines(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """Weekly accumulated sales per store and article, normal and offer sales apart.

    Rows are exchanged once, by article, which serves the sums and the join with the articles; an article with very many
    rows takes one task longer, but no more memory than its lines.  Articles that are listed several times under the same
    names are put together before the join, so that each line comes once.
    """
    offer = F.coalesce(F.col("list_amount") != F.col("sales_amount"), F.lit(False)).alias("offer")
    whole, amounts = whole_amounts(rows)
    # Narrow keys and whole numbers until the articles are joined: stamp, code and amounts are made of them afterwards.
    per_key = whole.repartition("article_idx").groupBy("store_idx", week_end("sale_date").alias("sunday"), offer, "article_idx", "supplier_idx").agg(
        net_amount_sum("sales_excl_vat", "return_excl_vat").alias("net"), F.sum("cost_amount").alias("cost"),
        net_qty_sum().alias("qty"), F.count_if(F.col("line_no") == 1).alias("customers"),
        net_amount_sum("sales_vat", "return_vat").alias("vat"),
    )
    unit = F.when(F.col("unit_name") == "L", F.col("unit_amount")).otherwise(1)
    dim = articles.groupBy("article_idx", "gtin", "article_name", F.col("lev1_id").alias("group_id")).agg(F.count("*").alias("copies"), F.sum(unit).alias("units"))
    joined = amounts(per_key.join(dim, "article_idx"), "net", "cost", "qty", "vat")

    def times(name: str, factor: str) -> Column:
        return (F.col(name) * F.col(factor)).alias(name)

    return joined.select(
        F.when(F.col("offer"), F.lit(OFFER_LINE)).otherwise(F.lit(NORMAL_LINE)).alias("report_code"), "store_idx", week_stamp("sunday").alias("week"),
        F.when(sql_len("gtin") > 6, F.lit("E")).otherwise(F.lit("P")).alias("id_kind"), "gtin", times("net", "copies"), times("cost", "copies"),
        times("qty", "units"), times("customers", "copies"), times("vat", "copies"), "supplier_idx", "group_id", "article_name", "article_idx",
    )


def report_lines(lines: DataFrame) -> DataFrame:
    """Text lines of the weekly file per store: header, details and a SUM line, in file order.  Each line is
    written as it is, and the sums share the exchanges below the lines."""
    def text(*cols: Column) -> Column:
        return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])

    numbers = ("net", "cost", "qty", "customers", "vat")
    totals = lines.groupBy("store_idx", "week").agg(*[F.sum(c).alias(c) for c in numbers])
    money, vat = [F.col(c).cast("decimal(28,2)") for c in ("net", "cost", "qty")], F.col("vat").cast("decimal(28,2)")
    detail = text(F.col("report_code"), F.col("store_idx"), F.col("week"), F.col("id_kind"), F.col("gtin"), *money, F.col("customers"), vat,
                  F.col("supplier_idx"), F.col("group_id"), F.col("article_name"))
    total = text(F.lit("OTU"), F.col("store_idx"), F.col("week"), F.lit("SUM"), *money, F.col("customers"), vat)

    def part(number: int, line: Column) -> Column:
        return F.struct(F.lit(number).alias("part"), line.alias("line"))

    framed = totals.select("store_idx", "week", F.inline(F.array(part(1, F.lit(FILE_HEADER)), part(3, total))))
    return lines.select("store_idx", "week", F.lit(2).alias("part"), detail.alias("line")).unionByName(framed)


# Reason written for a transfer between stores.
REASON_SAME_GROUP, REASON_OTHER_GROUP = 23, 19


def wastage_export(moves: DataFrame, articles: DataFrame, stores: DataFrame, *, bounds: Bounds | None = None) -> DataFrame:
    """Losses and transfers with signs, reasons and locale formats.

    A transfer names the receiving store; its reason says whether the store belongs to the same
    legal group.
    """
    rows = moves if bounds is None else moves.filter(within("adj_date", bounds))
    rows = rows.filter(F.col("type_no").isin(2, 52) & (F.col("reason_no") > 0))
    home = stores.select("store_idx", "store_id", F.col("lev1_legal_no").alias("legal_no"))
    target = stores.select(F.col("store_idx").alias("target_idx"), F.col("store_id").alias("to_store"), F.col("lev1_legal_no").alias("to_legal_no"))
    is_transfer = F.col("type_no") == 52
    per_key = rows.groupBy("store_idx", "article_idx", "adj_date", "type_no", "reason_no").agg(
        F.sum(signed_cost()).alias("cost"), F.sum(signed_qty()).alias("qty"), F.sum(signed("sales_value", "sign")).alias("value")
    )
    routed = per_key.withColumn("target_idx", F.when(is_transfer, F.col("reason_no")))
    joined = routed.join(home, "store_idx").join(target, "target_idx", "left").join(articles.select("article_idx", "gtin"), "article_idx")
    reason = F.when(
        F.col("to_store").isNotNull(),
        F.when(F.col("legal_no") == F.col("to_legal_no"), REASON_SAME_GROUP).otherwise(REASON_OTHER_GROUP),
    ).otherwise(F.col("reason_no"))
    return joined.select(
        "gtin", format_date("adj_date").alias("adj_date"), format_decimal("cost").alias("cost"), format_decimal("qty").alias("qty"),
        reason.alias("reason"), "to_store", format_decimal("value").alias("value"), F.col("store_id").alias("from_store"),
    )


def financial_figures(rows: DataFrame, receipts: DataFrame) -> DataFrame:
    """Revenue, VAT, cost and payments per store and week, for the financial export."""
    week = week_stamp("sale_date").alias("week")
    sales = rows.groupBy("store_idx", week).agg(
        net_amount_sum("sales_excl_vat", "return_excl_vat").alias("net"), net_amount_sum("sales_vat", "return_vat").alias("vat"),
        F.sum("cost_amount").alias("cost"),
    )
    paid = receipts.groupBy("store_idx", week).agg(F.sum("amount").alias("paid"), F.count("*").alias("receipts"))
    return sales.join(paid, ["store_idx", "week"])
